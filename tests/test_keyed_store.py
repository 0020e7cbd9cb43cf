"""A bucketed store: upserts equal the plain ones and touch only their buckets."""

import random

import pytest
from pyspark.sql import functions as F

from linkloom.plans import paper_store, papers
from linkloom.sinks.keyed_store import KeyedStore

SCHEMA = "doi string, journal string, publisher string, published_date string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def records(spark, ids, journal):
    return spark.createDataFrame([(f"10.1/{i}", journal, "P", "2020") for i in ids], SCHEMA)


def test_upserts_equal_the_plain_ones(spark, tmp_path):
    rng = random.Random(2)
    plain = records(spark, range(500), "old")
    store = paper_store.create_paper_store(plain, str(tmp_path / "s"), 60)
    for k in range(3):
        new = records(spark, [rng.randrange(700) for _ in range(15)], f"new {k}")
        plain = spark.createDataFrame(papers.upsert_papers(plain, new).collect(), SCHEMA)
        store = paper_store.upsert_into_store(store, new)
        assert store.rewritten <= 15
        assert rows(store.read()) == rows(plain) == rows(KeyedStore.open(spark, store.path).read())


def test_a_small_upsert_rewrites_few_buckets_and_files(spark, tmp_path):
    """0.1% of the keys touch about that share of the buckets; the others' files stay the same."""
    store = paper_store.create_paper_store(records(spark, range(5000), "old"), str(tmp_path / "s"), 1000)
    before = set(store.read().inputFiles())
    after = paper_store.upsert_into_store(store, records(spark, range(5), "new"))
    assert after.rewritten <= 5
    now = set(after.read().inputFiles())
    assert len(now - before) <= 5 and len(before - now) <= 5 and len(now) > 900
    assert after.read().filter("journal = 'new'").count() == 5 and after.read().count() == 5000
    # a lookup reads the keys' buckets only
    found = after.lookup(["10.1/3", "10.1/4000", "10.1/none"])
    assert len(found.inputFiles()) <= 3 and rows(found) == [("10.1/3", "new", "P", "2020"), ("10.1/4000", "old", "P", "2020")]
    # the version before is still whole, until it is vacuumed
    assert store.read().filter("journal = 'new'").isEmpty()
    assert after.vacuum() == 1 and after.read().count() == 5000


def test_a_failed_or_late_change_leaves_the_store(spark, tmp_path):
    store = paper_store.create_paper_store(records(spark, range(50), "old"), str(tmp_path / "s"), 8)
    broken = records(spark, range(3), "bad").withColumn("publisher", F.when(F.col("doi") == "10.1/2", F.raise_error(F.lit("lost"))).otherwise("P"))
    with pytest.raises(Exception, match="lost"):
        paper_store.upsert_into_store(store, broken)
    assert rows(KeyedStore.open(spark, store.path).read()) == rows(records(spark, range(50), "old"))
    first = paper_store.upsert_into_store(store, records(spark, [1], "first"))
    with pytest.raises(RuntimeError, match="version 2"):
        paper_store.upsert_into_store(store, records(spark, [2], "second"))
    assert rows(KeyedStore.open(spark, store.path).read()) == rows(first.read())


def test_empty_stores_and_changes_that_empty_buckets(spark, tmp_path):
    store = paper_store.create_paper_store(records(spark, [], "x"), str(tmp_path / "e"), 4)
    assert store.read().isEmpty() and KeyedStore.open(spark, store.path).read().isEmpty()
    store = paper_store.upsert_into_store(store, records(spark, range(9), "y"))
    assert paper_store.upsert_into_store(store, records(spark, [], "z")).version == store.version
    gone = store.upsert(records(spark, range(9), "y"), lambda old, new: old.join(new, "doi", "left_anti"))
    assert gone.read().isEmpty() and KeyedStore.open(spark, store.path).read().isEmpty()
    cache = KeyedStore.create(spark.createDataFrame([("PMC1", "a"), ("PMC2", "b")], "pmcid string, doi_url string"), str(tmp_path / "c"), "pmcid", 3)
    cache = paper_store.merge_into_cache(cache, spark.createDataFrame([("PMC2", "c"), ("PMC3", "d"), (None, "e")], "pmcid string, doi_url string"))
    assert rows(cache.read()) == [("PMC1", "a"), ("PMC2", "c"), ("PMC3", "d")]
