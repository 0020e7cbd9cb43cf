"""Refreshed summaries equal those counted anew, and a refresh touches only the changed values."""

import random

import pytest

from linkloom.plans import live_summaries, summaries
from linkloom.sinks.keyed_store import KeyedStore

LINKS = "id long, published_date string, created timestamp, repository_id string, publisher_id string, journal_id string, source_id string"
BRIDGE = "assertion_id long, subject_id string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def links(spark, held):
    from datetime import datetime

    made = []
    for i, k in held:
        created = None if k % 7 == 0 else datetime(2020, 1, 1 + k % 5, 12)
        made.append((i, [None, "1995", "1990-02", "x", "2001-01-01"][k % 5], created, ["", None, "r"][k % 3], f"p{k % 40}", None, "s"))
    return spark.createDataFrame(made, LINKS)


def check(spark, store, held):
    whole = links(spark, held)
    assert rows(live_summaries.assertions_last_10_years(store, 1999)) == rows(summaries.assertions_last_10_years(whole, 1999))
    assert rows(live_summaries.growth_per_day(store)) == rows(summaries.growth_per_day(whole))
    got = dict(rows(live_summaries.facet_unique_counts(store)))
    for facet in live_summaries.FACETS:
        assert got[facet] == whole.select(f"{facet}_id").distinct().dropna().count()


def test_refresh_equals_recomputation(spark, tmp_path):
    rng = random.Random(4)
    held = [(i, rng.randrange(60)) for i in range(300)]
    store = live_summaries.create_summary_store({"assertions": links(spark, held)}, str(tmp_path / "s"), 8)
    check(spark, store, held)
    for step in range(2):
        gone = rng.sample(held, 120)
        new = [(1000 * step + i, rng.randrange(60)) for i in range(40)]
        store = live_summaries.refresh_summaries(store, {"assertions": links(spark, new)}, {"assertions": links(spark, gone)})
        held = [x for x in held if x not in set(gone)] + new
        check(spark, store, held)
    store = live_summaries.refresh_summaries(store, {}, {"assertions": links(spark, held)})
    assert store.read().isEmpty() and dict(rows(live_summaries.facet_unique_counts(store)))["publisher"] == 0


def test_a_refresh_reads_and_rewrites_the_buckets_of_its_values(spark, tmp_path):
    many = spark.createDataFrame([(i, f"s{i}") for i in range(3000)], BRIDGE)
    store = live_summaries.create_summary_store({"assertions_subjects": many}, str(tmp_path / "s"), 500)
    before = set(store.read().inputFiles())
    two = spark.createDataFrame([(1, "s1"), (2, "new")], BRIDGE)
    after = live_summaries.refresh_summaries(store, {"assertions_subjects": two})
    assert after.rewritten == 2 and len(before & set(after.read().inputFiles())) >= len(before) - 2
    assert dict(rows(live_summaries.facet_unique_counts(after)))["subjects"] == 3001


def test_withdrawing_too_much_changes_nothing(spark, tmp_path):
    one = spark.createDataFrame([(1, "a"), (2, "b")], BRIDGE)
    store = live_summaries.create_summary_store({"assertions_subjects": one}, str(tmp_path / "s"), 4)
    with pytest.raises(Exception, match="more withdrawn than there is: subjects=c"):
        live_summaries.refresh_summaries(store, {}, {"assertions_subjects": spark.createDataFrame([(1, "c")], BRIDGE)})
    assert rows(KeyedStore.open(spark, store.path).read()) == rows(store.read())
    with pytest.raises(ValueError, match="not counted"):
        live_summaries.refresh_summaries(store, {"papers": one})
