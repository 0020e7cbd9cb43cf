"""The physical plans hold up at scale: no cross joins, no Python, no single-task sorts."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from catalog.queries import QUERIES, corpus_of
from linkloom.operators.dedup import dedup_latest
from linkloom.operators.integrity import cascade
from linkloom.operators.joins import broadcast_if_small, broadcastable, lookup_join
from linkloom.plans.details import assertion_details_formatted
from linkloom.sinks.files import save_bucketed
from linkloom.sources.files import load_corpus

SF_DIR = "/root/testdata/sf0.001"


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def ran_plan(df):
    """The plan AQE ended up with."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert node not in text
    # the only single-partition window is the running total over days
    if name != "growth_per_day":
        assert not re.search(r"Exchange SinglePartition[^\n]*\n[^\n]*Scan", text)


def test_dedup_limits_groups_before_the_shuffle(tables):
    text = plan(dedup_latest(tables.assertions))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(
        QUERIES["load_papers"](spark, SF_DIR), "formatted"
    )
    schema = re.search(r"ReadSchema: (struct<[^\n]*)", text).group(1)
    assert "o_totalprice" not in schema and "o_orderdate" in schema
    corpus = spark.read.parquet(f"{SF_DIR}/supplier.parquet").filter(F.col("s_name").isin("a", "b"))
    assert "PushedFilters: [In(s_name" in plan(corpus, "formatted")


def test_details_shuffle_the_fact_once(spark, tables, conf, tmp_path):
    from linkloom.sinks.files import save_corpus

    save_corpus(corpus_of(tables, named_ends=True), str(tmp_path))
    corpus = load_corpus(spark, str(tmp_path))
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    text = plan(assertion_details_formatted(corpus))
    # one exchange for the assertions and one per bridge; the dimensions are broadcast
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 4
    assert text.count("BroadcastExchange") == 7
    assert text.count("SortMergeJoin") == 3


def test_bucketed_cascade_needs_no_shuffle(spark, tables, conf):
    save_bucketed(corpus_of(tables), 4)
    corpus = load_corpus(spark, reader=spark.table)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    kept = cascade(corpus, corpus.assertions.filter("doi is not null"))
    text = plan(kept.assertions_affiliations)
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_hot_key_is_split(spark, conf):
    """A key with a third of all rows is spread over several tasks by AQE."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    facts = spark.range(0, 300_000, numPartitions=8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    lookup = facts.select("k").distinct().withColumn("name", F.concat(F.lit("n-"), "k"))
    joined = lookup_join(facts, lookup, "k")
    text = ran_plan(joined)
    assert "skew=true" in text
    assert joined.filter("name = 'n-hot'").count() == 100_000


def test_null_keys_are_spread(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    facts = spark.range(100_000).select(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("k"), F.col("id") % 100)).alias("k"), F.col("id").alias("v")
    )
    lookup = spark.range(0, 100, 2).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("found").alias("name"))
    joined = lookup_join(facts, lookup, "k")
    assert joined.columns == ["k", "v", "name"]
    assert joined.filter("k is null and name is null").count() == 50_000
    assert joined.filter("name = 'found'").count() == 50_000
    sizes = [r["n"] for r in joined.filter("k is null").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 12_000


def test_lookup_join_agrees_with_the_broadcast_form(spark):
    facts = spark.createDataFrame([("a", 1), (None, 2), ("", 3), ("z", 4), ("a", 5)], "k string, v int")
    lookup = spark.createDataFrame([("a", "A"), ("", "empty"), (None, "never")], "k string, name string")
    shuffled = lookup_join(facts, lookup, "k")
    broadcast = lookup_join(facts, lookup, "k", small=True)
    assert shuffled.columns == broadcast.columns
    key = lambda r: r["v"]
    assert sorted(shuffled.collect(), key=key) == sorted(broadcast.collect(), key=key)


def test_lookup_join_of_a_single_column_and_of_null_keys(spark):
    facts = spark.createDataFrame([("a",), (None,), ("z",)], "k string")
    lookup = spark.createDataFrame([("a", "A"), (None, "never")], "k string, name string")
    assert sorted(map(tuple, lookup_join(facts, lookup, "k").collect()), key=repr) == [("a", "A"), ("z", None), (None, None)]
    for how in ("inner", "left_semi"):
        joined = lookup_join(facts, lookup, "k", how)
        assert joined.count() == 1
        assert "xxhash64" not in plan(joined) and "coalesce" not in plan(joined)


def test_hot_pair_of_missing_citations_is_split(spark, conf):
    """Report lines that differ, a third of them citing one dataset in one article."""
    from linkloom.plans.compare import missing_citations

    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    hot = F.col("id") % 3 == 0
    report = spark.range(0, 60_000, numPartitions=8).select(
        F.when(hot, "10.1/hot").otherwise(F.concat(F.lit("10.1/"), F.col("id") % 5000)).alias("article_doi"),
        F.array(F.when(hot, "10.2/hot").otherwise(F.concat(F.lit("10.2/"), F.col("id") % 7)), F.concat(F.lit("10.3/"), "id")).alias("cited"),
    )
    events = report.select(
        F.concat(F.lit("https://doi.org/"), "article_doi").alias("subj_id"), F.col("cited")[0].alias("obj_id"), F.lit("cites").alias("relation_type_id")
    ).distinct()
    missing = missing_citations(report, events)
    assert "skew=true" in ran_plan(missing)
    assert missing.agg(F.sum("missing_count"), F.sum("found_count")).first() == (60_000, 60_000)


def test_broadcast_only_what_was_measured_small(spark):
    tables = {
        "small": spark.range(10).select(F.col("id").cast("string").alias("k")),
        "many": spark.range(2000).select(F.col("id").cast("string").alias("k")),
        "wide": spark.range(10).select(F.repeat(F.lit("x"), 100_000).alias("k")),
    }
    assert broadcastable(tables, max_rows=1000, max_bytes=500_000) == {"small"}
    assert set(broadcast_if_small(tables)) == set(tables)


def test_results_do_not_depend_on_the_broadcast_bound(spark, tables, monkeypatch):
    from linkloom.operators import joins
    from linkloom.plans import details

    def collected():
        done = assertion_details_formatted(corpus_of(tables, named_ends=True))
        return sorted(done.collect(), key=lambda r: r["id"])

    expected = collected()
    monkeypatch.setattr(details, "broadcastable", lambda tables: set())
    monkeypatch.setattr(joins, "broadcastable", lambda tables: set())
    assert collected() == expected


def test_partitioned_csv_splits_only_the_hot_value(spark, conf, tmp_path):
    from linkloom.sinks.files import write_partitioned_csv

    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="256KB")
    rows = spark.range(0, 120_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 5)).alias("repo"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    write_partitioned_csv(rows, str(tmp_path / "o"), "repo")
    files = {d.name: len(list(d.glob("*.csv"))) for d in (tmp_path / "o").iterdir() if d.is_dir()}
    assert files["repo=hot"] > 1
    assert spark.read.csv(str(tmp_path / "o"), header=True).count() == 120_000


def test_paper_lines_are_parsed_once(spark):
    """One parse of the record, one of the title, three of the nested date, however often they are used."""
    from linkloom.plans import papers

    lines = spark.createDataFrame([('{"DOI": "10.1/a"}', "f")], "value string, file string")
    for df in (papers.load_papers(lines), papers.parse_papers(lines)[1]):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert 1 <= plan.count("from_json") <= 5


def test_links_of_one_key_are_made_by_all_tasks(spark, conf):
    """A hundred matches and two thousand assertions of one dataset; nulls and keys of one side give nothing."""
    from linkloom.operators import joins
    from linkloom.plans.review import build_org_links

    chosen = spark.range(102).selectExpr(
        "case id when 100 then 'k2' when 101 then null else 'k' end as dataset_key", "cast(id as string) as ror_id", "concat('t', id % 3) as title"
    )
    by_title = spark.range(3).selectExpr("concat('t', id) as title", "cast(id as string) as affiliation_id")
    by_key = spark.range(2002).selectExpr(
        "case id when 2000 then 'k3' when 2001 then null else 'k' end as dataset_key", "cast(id div 2 as string) as assertion_id"
    )
    before, joins.BLOCK_ROWS = joins.BLOCK_ROWS, 50
    try:
        links = build_org_links(chosen, by_key, by_title)
    finally:
        joins.BLOCK_ROWS = before
    per_task = [r["count"] for r in links.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 200_000 and max(per_task) < 100_000
    assert links.distinct().count() == 100_000


def compared_tables(spark):
    report = spark.range(40_000).selectExpr("concat('10.1/a', id) as article_doi", "array(concat('10.2/d', id % 30)) as cited")
    events = report.selectExpr("article_doi as subj_id", "cited[0] as obj_id", "'references' as relation_type_id")
    return report, events


def test_links_that_compress_well_are_not_merged_into_few_tasks(spark, conf):
    from linkloom.plans import compare

    conf(spark__sql__adaptive__coalescePartitions__parallelismFirst="false")
    report, events = compared_tables(spark)
    links = compare.citation_links(events.unionByName(events))
    assert links.rdd.getNumPartitions() == 8 and links.count() == 40_000


def test_in_events_does_not_reduce_the_links_first(spark):
    from linkloom.plans import compare

    report, events = compared_tables(spark)
    pairs = report.selectExpr("article_doi", "cited[0] as dataset_doi")
    found = compare.in_events(pairs, events.unionByName(events))
    assert found.count() == 40_000 and "Aggregate" not in plan(found)


def test_equal_lines_meet_without_an_aggregate_of_whole_entries(spark):
    from linkloom.plans import compare

    report, events = compared_tables(spark)
    missing = compare.missing_citations(report.unionByName(report), events)
    # equal lines meet in the set of the line's entries, without an aggregate of whole entries
    assert "keys=[line#" in ran_plan(missing) and "pos#" not in "".join(re.findall(r"keys=\[[^]]*\]", ran_plan(missing)))
    assert missing.agg(F.count("*"), F.sum("found_count")).first() == (40_000, 40_000)


def test_compared_lists_are_built_once(spark):
    from linkloom.plans import compare

    report, events = compared_tables(spark)
    done = compare.compare_citations(report, events)
    assert "collect_set" not in plan(done)
    assert done.filter("same").count() == 40_000


def test_bridges_are_parted_once(spark, tables):
    from catalog import queries
    from linkloom.plans import live_summaries

    seen = []
    real = live_summaries.signed_counts

    def watched(*parts):
        seen.extend(table for part in parts if part for name, table in part.items() if name != "assertions")
        return real(*parts)

    live_summaries.signed_counts = watched
    try:
        queries._summary_store(tables)
    finally:
        live_summaries.signed_counts = real
    assert len(seen) == 6 and not any("Join" in plan(table) or "Aggregate" in plan(table) for table in seen)


def test_a_record_is_written_by_two_calls(spark, tables):
    """The fields before and after the three objects, and those."""
    from linkloom.operators.numbering import number_rows
    from linkloom.plans import export
    from linkloom.sinks.files import json_lines

    corpus = corpus_of(tables, named_ends=True)
    numbered = number_rows(corpus.assertions, "id", 400)
    lines = json_lines(export.with_chunks(assertion_details_formatted(corpus), numbered), numbered, 400)
    assert plan(lines).count("StructsToJsonEvaluator") == 5
