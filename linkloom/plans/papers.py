"""Bibliographic records: load, upsert, look up, search, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.papers import journal_name, once, or_empty, publication_date
from linkloom.operators.dedup import pick_by_key
from linkloom.operators.joins import drop_keys, lookup_join
from linkloom.schemas import PAPER_RECORD

TOP_PUBLISHERS = 10


def parse_papers(lines: DataFrame, compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """Papers from JSON lines in column ``value``, and the lines that are no JSON object.

    Fields of an odd type do not spoil their record.  Records without a DOI are dropped: they would
    all share one key.  Bad lines keep the further columns of ``lines``, such as their file.
    """
    schema = T.StructType([*PAPER_RECORD.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}

    def fields(r: Column) -> Column:
        is_bad = r.isNull() | r["_bad"].isNotNull() | ~F.ltrim("value").startswith("{")
        return F.struct(
            is_bad.alias("bad"),
            r["DOI"].alias("doi"),
            journal_name(r["container-title"]).alias("journal"),
            or_empty(r["publisher"]).alias("publisher"),
            publication_date(r["published"], compat).alias("published_date"),
        )

    # made by a generator, since Spark would parse again for a filter that it pushes through a projection
    record = once(F.from_json("value", schema, options), fields)
    parsed = lines.select("*", F.explode_outer(F.array(record)).alias("r"))
    bad = parsed.filter("r.bad").drop("r")
    papers = parsed.filter("not r.bad").select(*[F.col(f"r.{c}") for c in ("doi", "journal", "publisher", "published_date")])
    return papers.filter(F.col("doi") != ""), bad


def count_bad_lines(bad: DataFrame) -> DataFrame:
    """``(file, bad_lines)`` of the bad lines that ``read_papers_jsonl`` found."""
    return bad.groupBy("file").agg(F.count(F.lit(1)).alias("bad_lines"))


def one_per_doi(papers: DataFrame) -> DataFrame:
    """Records of the same DOI reduced to one: latest date, then greatest journal and publisher."""
    return pick_by_key(papers, ["doi"], [F.col("published_date"), F.col("journal"), F.col("publisher")])


def load_papers(lines: DataFrame, compat: bool = False) -> DataFrame:
    papers, _ = parse_papers(lines, compat)
    return one_per_doi(papers)


def upsert_papers(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old papers replaced by new ones of the same DOI, other new ones added."""
    new = one_per_doi(new)
    return drop_keys(old, "doi", new.select("doi")).unionByName(new)


def enrich_papers(df: DataFrame, papers: DataFrame, on: str = "doi") -> DataFrame:
    """Add journal, publisher and publication date by DOI; null where the DOI is unknown.

    The columns are prefixed with ``paper_`` to stay clear of those already there.  A DOI that
    occurs more than once counts with its latest record, so no row is multiplied.
    """
    lookup = one_per_doi(papers.select("doi", "journal", "publisher", "published_date")).select(
        F.col("doi").alias(on),
        F.col("journal").alias("paper_journal"),
        F.col("publisher").alias("paper_publisher"),
        F.col("published_date").alias("paper_published_date"),
    )
    return lookup_join(df, lookup, on)


def paper_stats(papers: DataFrame, top: int = TOP_PUBLISHERS) -> DataFrame:
    """The publishers with most papers; the number of all papers stands in every row."""
    counts = papers.groupBy("publisher").agg(F.count(F.lit(1)).alias("papers"))
    # one row with the total and one per publisher: few rows, aggregated before they meet
    total = counts.agg(F.coalesce(F.sum("papers"), F.lit(0)).alias("total_papers"))
    ranked = counts.filter(F.col("publisher") != "").orderBy(F.desc("papers"), "publisher").limit(top)
    return ranked.withColumn("total_papers", total.scalar())


def search_papers(
    papers: DataFrame,
    doi: str | None = None,
    journal: str | None = None,
    publisher: str | None = None,
    year: int | None = None,
) -> DataFrame:
    """Papers that meet all given conditions; plain comparisons, so they reach the scan."""
    for column, wanted in (("doi", doi), ("journal", journal), ("publisher", publisher)):
        if wanted is not None:
            papers = papers.filter(F.col(column) == wanted)
    if year is not None:
        papers = papers.filter(F.col("published_date").startswith(f"{year:04d}"))
    return papers
