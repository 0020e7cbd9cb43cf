"""The stored paper table and lookup cache, brought up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.plans.ingest import merge_lookup_cache
from linkloom.plans.papers import one_per_doi, upsert_papers
from linkloom.sinks.files import materialize
from linkloom.sinks.keyed_store import KeyedStore
from linkloom.sources.files import read_papers, read_papers_jsonl


def import_papers(spark: SparkSession, source: str, old: str, new: str) -> tuple[DataFrame, DataFrame]:
    """Upsert the records under ``source`` into the table at ``old``, written to ``new``.

    Returns the new table and the lines that could not be read.  The table is laid out by DOI, so
    a lookup of a few DOIs skips all row groups but those that can hold them.
    """
    papers, bad = read_papers_jsonl(spark, source)
    merged = upsert_papers(read_papers(spark, old), papers)
    by_doi = merged.repartitionByRange("doi").sortWithinPartitions("doi")
    return materialize(by_doi, new), bad


def create_paper_store(papers: DataFrame, path: str, buckets: int) -> KeyedStore:
    """Papers in buckets by DOI; of records with the same one the latest is kept."""
    return KeyedStore.create(one_per_doi(papers), path, "doi", buckets)


def upsert_into_store(store: KeyedStore, papers: DataFrame) -> KeyedStore:
    """The store with new records put over those of the same DOI; only their buckets are rewritten."""
    return store.upsert(papers.filter(F.col("doi").isNotNull()), upsert_papers)


def import_into_store(store: KeyedStore, source: str) -> tuple[KeyedStore, DataFrame]:
    """Upsert the records under ``source``; also gives the lines that could not be read."""
    papers, bad = read_papers_jsonl(store.spark, source)
    return upsert_into_store(store, papers), bad


def merge_into_cache(store: KeyedStore, fetched: DataFrame) -> KeyedStore:
    """The lookup cache, kept by ``pmcid``, with fetched entries put over old ones."""
    return store.upsert(fetched.filter(F.col("pmcid").isNotNull()), merge_lookup_cache)
