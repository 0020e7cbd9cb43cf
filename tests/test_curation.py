"""Properties of the removal pipeline."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog.queries import TRIALS, corpus_of
from linkloom import rules
from linkloom.corpus import BRIDGES
from linkloom.operators.dedup import assert_unique, dedup_latest, pick_by_key
from linkloom.operators.filters import drop_self_citations, unless
from linkloom.operators.integrity import cascade, drop_orphans
from linkloom.operators.updates import clear_invalid_ids, ensure_columns, fix_separators
from linkloom.plans.curate import curate, curate_stepwise
from linkloom.plans.ingest import merge_lookup_cache


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.fixture(scope="module")
def corpus(tables):
    return corpus_of(tables)


def test_one_pass_equals_the_literal_steps(corpus):
    one_pass = curate(corpus, trial_repositories=TRIALS, checkpoint=True).corpus.tables()
    stepwise = curate_stepwise(corpus, trial_repositories=TRIALS).tables()
    for name in one_pass:
        assert one_pass[name].columns == stepwise[name].columns
        assert rows(one_pass[name]) == rows(stepwise[name]), name


def test_one_pass_equals_the_literal_steps_with_options(corpus):
    options = {
        "trial_repositories": TRIALS,
        "source_relation": ("crossref", "is-referenced-by"),
        "excluded_repositories": ["repo-3"],
    }
    one_pass, stepwise = curate(corpus, **options).corpus, curate_stepwise(corpus, **options)
    assert rows(one_pass.assertions, "id") == rows(stepwise.assertions, "id")
    assert rows(one_pass.funders, "id") == rows(stepwise.funders, "id")


def test_curation_is_idempotent(corpus):
    once = curate(corpus, trial_repositories=TRIALS).corpus
    twice = curate(once, trial_repositories=TRIALS).corpus
    assert rows(once.assertions) == rows(twice.assertions)
    for bridge in BRIDGES:
        assert rows(once.tables()[bridge]) == rows(twice.tables()[bridge])


def test_audit_adds_up(corpus):
    done = curate(corpus, trial_repositories=TRIALS)
    facts = [r for r in done.audit.collect() if r["table"] == "assertions"]
    left = corpus.assertions.count()
    for step in facts:
        left -= step["removed"]
        assert step["remaining"] == left
    assert left == done.corpus.assertions.count()


def test_no_dangling_bridge_rows(corpus):
    kept = cascade(corpus, corpus.assertions.filter("id > 'a-000000700'"))
    for bridge in BRIDGES:
        dangling = kept.tables()[bridge].join(kept.assertions, F.col("assertion_id") == kept.assertions["id"], "left_anti")
        assert dangling.isEmpty()


def test_dedup_leaves_unique_keys(corpus):
    kept = dedup_latest(corpus.assertions)
    repeated = kept.groupBy(*rules.DEDUP_KEYS).count().filter("count > 1")
    assert repeated.isEmpty()


def test_dedup_takes_null_dates_first_and_breaks_ties_by_id(spark):
    day = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", "k", day), ("b", "k", None), ("c", "l", day), ("d", "l", day), ("e", None, day), ("f", None, day)],
        "id string, k string, updated timestamp",
    )
    assert rows(dedup_latest(df, ["k"]), "id") == [("b",), ("c",), ("e",)]


def test_self_citations_and_nulls(spark):
    df = spark.createDataFrame([("a", "x", "x"), ("b", "x", None), ("c", "x", "y")], "id string, subj_id string, obj_id string")
    assert rows(drop_self_citations(df), "id") == [("c",)]
    assert rows(drop_self_citations(df, keep_nulls=True), "id") == [("b",), ("c",)]


def test_unless_keeps_unknown(spark):
    df = spark.createDataFrame([("x",), (None,), ("y",)], "v string")
    assert rows(df.filter(unless(F.col("v") == "x"))) == [("y",), (None,)] or rows(
        df.filter(unless(F.col("v") == "x"))
    ) == [(None,), ("y",)]


def test_orphans_with_a_null_key_in_the_bridge(spark):
    dim = spark.createDataFrame([("a",), ("b",)], "id string")
    bridge = spark.createDataFrame([("a",), (None,)], "fk string")
    assert rows(drop_orphans(dim, bridge, "fk")) == [("a",)]
    assert rows(drop_orphans(dim, bridge, "fk", compat=True)) == [("a",), ("b",)]


def test_pick_by_key(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("l", 1, "c")], "k string, o int, v string")
    assert rows(pick_by_key(df, ["k"], [F.col("o")])) == [("k", 2, "b"), ("l", 1, "c")]
    assert rows(pick_by_key(df, ["k"], [F.col("o")], last=False)) == [("k", 1, "a"), ("l", 1, "c")]


def test_assert_unique(spark):
    ok = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "title string")
    assert assert_unique(ok, "title") is ok
    with pytest.raises(ValueError):
        assert_unique(spark.createDataFrame([("a",), ("a",)], "title string"), "title")


def test_invalid_ids_and_missing_columns(spark):
    df = spark.createDataFrame([(" N/A ",), ("x",), (None,)], "external_id string")
    assert rows(clear_invalid_ids(df, ["N/A"])) == rows(spark.createDataFrame([(None,), ("x",), (None,)], "external_id string"))
    assert clear_invalid_ids(df, []) is df
    assert ensure_columns(df, ["external_id", "ror_id"]).columns == ["external_id", "ror_id"]


def test_separators_compat_needs_affiliations(spark):
    df = spark.createDataFrame([("", "A ;B"), ("x ;y", "A ;B")], "affiliations string, funders string")
    assert rows(fix_separators(df)) == [("", "A;B"), ("x;y", "A;B")]
    assert rows(fix_separators(df, compat=True)) == [("", "A ;B"), ("x;y", "A;B")]


def test_cache_merge_prefers_new(spark):
    schema = "pmcid string, doi_url string"
    old = spark.createDataFrame([("1", "z"), ("2", "b")], schema)
    new = spark.createDataFrame([("1", "a")], schema)
    assert rows(merge_lookup_cache(old, new)) == [("1", "a"), ("2", "b")]


def test_rows_are_deduplicated_once_for_all_outputs_and_the_copy_goes(corpus):
    from tests.test_plans import plan

    done = curate(corpus, trial_repositories=TRIALS)
    for output in (done.audit, *done.corpus.tables().values()):
        assert "WindowGroupLimit" not in plan(output) and "row_number" not in plan(output)
    assert done.corpus.assertions.count() > 0
    done.release()
    with pytest.raises(Exception, match="table-"):
        done.corpus.assertions.count()


def test_stored_marks_are_read_by_column(corpus):
    from tests.test_plans import plan

    done = curate(corpus, trial_repositories=TRIALS, checkpoint=True)
    text = plan(done.corpus.assertions_funders, "formatted")
    assert "ReadSchema: struct<id:string,_removed_by:string>" in text
    assert "Window" not in text
