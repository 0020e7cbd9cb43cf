"""Run the shuffling jobs on skewed data and show how even their tasks are.

    python tools/skew_trial.py <scratch folder> [rows] [job ...]

A third of the feed are copies of one row and another third share its article; half of the
assertions belong to one repository and a third are copies of one key; a third of each bridge
points to one organisation or one assertion; a third of the events belong to one article.  Per
stage the longest task is set against the median one.
"""

from __future__ import annotations

import collections
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.corpus import Corpus
from linkloom.operators.dedup import dedup_latest
from linkloom.operators.integrity import cascade
from linkloom.operators.numbering import number_rows
from linkloom.operators.updates import add_dataset_publication
from linkloom.plans import compare, ingest, papers
from linkloom.plans.curate import curate
from linkloom.plans.details import assertion_details_formatted
from linkloom.session import local_session
from linkloom.sources.files import conform


def text(prefix: str, value) -> F.Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def tables(spark: SparkSession, folder: str, rows: int) -> dict[str, DataFrame]:
    def numbers(n: int) -> DataFrame:
        return spark.range(0, n, 1, 32)

    row = F.col("id")
    third = row % 3
    spread = F.xxhash64("id")
    assertion = F.md5((row % (rows // 2)).cast("string"))
    copy, hot = third == 0, F.md5(F.lit("5"))
    made = {
        "feed": numbers(rows).select(
            F.when(copy, "geo").otherwise("pdb").alias("repo_code"),
            F.when(copy, "GSE1").otherwise(text("ACC", spread)).alias("accession"),
            F.when(third < 2, "PMC1").otherwise(text("PMC", row % (rows // 4))).alias("pmcid"),
        ),
        "crosswalk": numbers(rows // 4).select(text("PMC", row).alias("pmcid"), text("10.1029/p", row).alias("doi")),
        "assertions": numbers(rows // 2).select(
            F.md5(row.cast("string")).alias("id"),
            F.timestamp_seconds(row % 1_000_003).alias("updated"),
            F.when(row % 2 == 0, "repo-hot").otherwise(text("repo-", row % 1000)).alias("repository_id"),
            F.when(copy, "p").otherwise(text("p", row % 777)).alias("publisher_id"),
            F.when(third != 1, "j").alias("journal_id"),
            F.when(copy, "o").otherwise(text("10.1/", spread)).alias("obj_id"),
            F.when(copy, "s").otherwise(text("10.2/", spread)).alias("subj_id"),
        ),
        "affiliations": numbers(1_500_000).select(text("aff", row).alias("id"), text("Org ", row).alias("title")),
        "assertions_affiliations": numbers(rows).select(
            text("b", row).alias("id"),
            assertion.alias("assertion_id"),
            F.when(copy, "aff1").otherwise(text("aff", row % 1_600_000)).alias("affiliation_id"),
        ),
        "assertions_funders": numbers(rows).select(
            F.when(copy, hot).otherwise(assertion).alias("assertion_id"), text("fun", row % 60_000).alias("funder_id")
        ),
        "events": numbers(rows).select(
            F.when(copy, "10.9/hot").otherwise(text("10.9/a", row % 500_000)).alias("subj_id"),
            text("https://doi.org/10.1/d", row).alias("obj_id"),
            F.lit("cites").alias("relation_type_id"),
        ),
        "report": numbers(rows // 8).select(
            F.when(copy, "10.9/copy").otherwise(text("10.9/a", row % 500_000)).alias("article_doi"),
            F.when(copy, F.array(F.lit("10.1/d1")))
            .otherwise(F.array(text("10.1/d", row), text("10.1/x", row)))
            .alias("cited"),
        ),
        "papers": numbers(rows // 2).select(
            text("10.1/", spread).alias("doi"),
            *[F.lit("x").alias(c) for c in ("journal", "publisher", "published_date")],
        ),
    }
    for name, table in made.items():
        if not os.path.exists(f"{folder}/{name}"):
            table.write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in made}


def corpus_from(spark: SparkSession, t: dict[str, DataFrame]) -> Corpus:
    empty = {n: spark.createDataFrame([], s) for n, s in schemas.CORPUS.items() if n not in t}
    given = {n: conform(t[n], s) for n, s in schemas.CORPUS.items() if n in t}
    corpus = Corpus(**empty, **given)
    return corpus.with_tables(assertions=add_dataset_publication(corpus.assertions))


def stage_times(log_dir: str) -> list[str]:
    job_of, times = {}, collections.defaultdict(list)
    for file in os.listdir(log_dir):
        with open(f"{log_dir}/{file}") as lines:
            for event in map(json.loads, lines):
                if event["Event"] == "SparkListenerJobStart":
                    name = (event.get("Properties") or {}).get("spark.job.description")
                    job_of.update({stage: name for stage in event["Stage IDs"]})
                elif event["Event"] == "SparkListenerTaskEnd":
                    info = event["Task Info"]
                    times[event["Stage ID"]].append((info["Finish Time"] - info["Launch Time"]) / 1000)
    out = []
    for stage, seconds in sorted(times.items()):
        seconds.sort()
        if seconds[-1] > 0.8:
            median = seconds[len(seconds) // 2]
            out.append(f"{job_of.get(stage)}: {len(seconds)} tasks, median {median:.2f} s, longest {seconds[-1]:.2f} s")
    return out


def main() -> None:
    folder = sys.argv[1]
    rows = int(sys.argv[2]) if len(sys.argv) > 2 else 8_000_000
    log_dir = f"{folder}/log-{int(time.time())}"
    os.makedirs(log_dir)
    spark = local_session(
        os.cpu_count(),
        **{
            "spark.sql.shuffle.partitions": "64",
            "spark.driver.memory": "16g",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            # the data is small, so the sizes at which Spark acts are scaled down with it
            "spark.sql.autoBroadcastJoinThreshold": "1MB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16MB",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    t = tables(spark, folder, rows)
    corpus = corpus_from(spark, t)
    cache = spark.createDataFrame([], schemas.LOOKUP_CACHE)
    jobs = {
        "resolve": lambda: ingest.resolve_publications(t["feed"], t["crosswalk"], cache),
        "dedup": lambda: dedup_latest(corpus.assertions),
        "cascade": lambda: cascade(corpus, corpus.assertions.filter("publisher_id <> 'p'")).assertions_funders,
        "curate": lambda: curate(corpus).corpus.affiliations,
        # without the bridge that gives one assertion a third of all funders: that is one long record
        "details": lambda: assertion_details_formatted(
            corpus.with_tables(assertions_funders=corpus.assertions_funders.limit(0))
        ),
        "enrich": lambda: papers.enrich_papers(corpus.assertions.select("id", "obj_id"), t["papers"], on="obj_id"),
        "missing": lambda: compare.missing_citations(t["report"], t["events"]),
        "differences": lambda: compare.citation_differences(t["report"], t["events"]),
        "number": lambda: number_rows(corpus.assertions, "id", 100_000).rows,
    }
    for name in sys.argv[3:] or jobs:
        spark.sparkContext.setJobDescription(name)
        start = time.time()
        jobs[name]().write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.time() - start:.1f} s", flush=True)
    spark.stop()
    print("\n".join(stage_times(log_dir)))


if __name__ == "__main__":
    main()
