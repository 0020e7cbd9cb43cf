"""Time the headline queries; prints one JSON line.

``queries`` builds the corpus tables inside each query, as the registered ones do; ``on_stored``
runs the same operators on corpus tables that were stored before, and ``build`` is the time
that building and storing them took.

    BENCH_SF_DIR   folder with the test tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     threads of the local session  (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.derive import StoredTables, needed
from catalog.queries import BUILDS, ORACLES, QUERIES
from linkloom.session import local_session

HEADLINES = [
    "details_formatted",
    "details_view",
    "export_csv_rows",
    "export_chunks",
    "dedup_latest",
    "curate_audit",
    "curate_assertions",
    "curate_bridges",
    "cascade_bridges",
    "drop_orphans",
    "normalize_dois",
    "clean_affiliations",
    "clean_funders",
    "scrub_emails_documents",
    "validate_accessions",
    "tag_subjects",
    "link_chosen_affiliations",
    "ingest_textmined",
    "load_papers",
    "enrich_papers",
    "paper_stats",
    "compare_citations",
    "missing_citations",
    "reconcile_orgs",
    "candidate_report",
]


def scale_factor(sf_dir: str) -> float | str:
    name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    scratch = tempfile.mkdtemp(prefix="linkloom-bench-")
    spark = local_session(
        cpus,
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": f"{scratch}/checkpoint",
            # one shuffle partition per thread is few already: keep all threads busy
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the session's threads and the first compilations outside the measurement
    QUERIES["details_formatted"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def timed(build) -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    names = sys.argv[1:] or HEADLINES
    seconds = {name: timed(lambda: QUERIES[name](spark, sf_dir)) for name in names}
    tables = StoredTables(spark, sf_dir, f"{scratch}/tables")
    start = time.perf_counter()
    for name in names:
        for table in needed(ORACLES.get(name, "")):
            getattr(tables, table)
    build = round(time.perf_counter() - start, 3)
    on_stored = {name: timed(lambda: BUILDS[name](tables)) for name in names}
    print(
        json.dumps(
            {
                "metric": "total wall-clock of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "build": build,
                "on_stored": on_stored,
                "sf": scale_factor(sf_dir),
            }
        )
    )


if __name__ == "__main__":
    main()
