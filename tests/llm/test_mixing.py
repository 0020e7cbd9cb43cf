from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from linkloom.llm import mixing
from tests.llm import brute


def by_source(rows):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    return sizes, taken, target


def test_targets_equal_resharing(spark, docs):
    rows = mixing.mix(docs).taken().collect()
    sizes, taken, target = by_source(rows)
    names = sorted(sizes)
    want = brute.targets([sizes[n] for n in names], (3, 1, 2), 1.5, 2)
    for name, t in zip(names, want):
        assert target[name] == pytest.approx(t)
        assert abs(taken[name] - t) <= 2 * mixing.BLOCK
    assert {r.doc_id: r["size"] for r in rows} == {r.doc_id: len(brute.WORD.findall(r.text or "")) for r in docs.collect()}


@pytest.mark.parametrize("sizes", [[5, 100, 7, 3000], [10, 10, 10], [1, 0, 0, 900, 2]])
def test_targets_of_uneven_sources(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = [r.target for r in mixing.mixing_targets(df, (3, 1, 2), 1.5, 2).orderBy("sid").collect()]
    assert got == pytest.approx(brute.targets(sizes, (3, 1, 2), 1.5, 2))


def test_every_round_takes_each_block_once(docs):
    made = mixing.mix(docs, block=64, slots=32)
    assert made.chosen.groupBy("sid", "epoch", "block").count().filter("count > 1").isEmpty()
    quotas = {r.sid: r.quota for r in made.sources.collect()}
    assert {r.sid: r["count"] for r in made.chosen.groupBy("sid").count().collect()} == {k: v for k, v in quotas.items() if v}
    per_shard = made.chosen.groupBy("shard").count().collect()
    assert all(r["count"] == 32 or r.shard == len(per_shard) - 1 for r in per_shard)


@pytest.mark.parametrize(
    "sizes", [{"a": [100], "b": [20]}, {"a": [100], "b": [100], "c": [100]}, {"a": [150, 50], "b": [129], "c": [3]}, {"a": [5000, 700], "b": [900], "c": [1]}]
)
def test_small_sources_come_near_their_targets(spark, sizes):
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate((s, n) for s, all_ in sizes.items() for n in all_)]
    made = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    got = made.taken().collect()
    totals, taken, target = by_source(got)
    want = brute.targets([totals[s] for s in sorted(totals)], (3, 1, 2), 1.5, 2)
    for source, t in zip(sorted(totals), want):
        assert target[source] == pytest.approx(t)
        assert abs(taken[source] - t) <= 0.5 + (totals[source] % 128 and totals[source] // 128)
    out = mixing.mixed_documents(spark.createDataFrame(rows, "doc_id long, source string, text string"), made)
    assert out.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(taken.values())


def test_no_array_holds_the_blocks_of_a_source(spark):
    """The blocks of one source of 4e11 words are a range of numbers dealt to many tasks."""
    sources = spark.createDataFrame([(0, 3_200_000_000), (1, 10)], "sid int, n long")
    dealt = mixing._dealt(sources, "n", 2)
    assert dealt.rdd.getNumPartitions() >= 3200
    few = mixing._dealt(spark.createDataFrame([(0, 3), (1, 0), (2, 2)], "sid int, n long"), "n", 3)
    assert sorted((r.sid, r._at, r._u) for r in few.collect()) == [(0, 0, 0), (0, 1, 1), (0, 2, 2), (2, 0, 3), (2, 1, 4)]


def test_draws_are_multinomial(spark):
    """Counts per shard scatter about the odds as independent draws do."""
    sources = spark.createDataFrame([(0, 60_000), (1, 30_000), (2, 10_000)], "sid int, quota long")
    counts = mixing._drawn(sources, 100_000, 1000, 3).groupBy("sid").agg(F.mean("n").alias("mean"), F.variance("n").alias("var"))
    for r in counts.collect():
        p = (0.6, 0.3, 0.1)[r.sid]
        assert r.mean == pytest.approx(1000 * p, rel=0.05) and 0.5 < r["var"] / (1000 * p * (1 - p)) < 2


def test_reruns_agree(docs):
    first = sorted(map(tuple, mixing.mix(docs).taken().collect()))
    assert first == sorted(map(tuple, mixing.mix(docs.repartition(7)).taken().collect()))


def test_documents_hold_the_words_taken(docs):
    made = mixing.mix(docs)
    out = mixing.mixed_documents(docs, made)
    assert out.columns == docs.columns
    got = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert got == {r.doc_id: r.taken for r in made.taken().filter("taken > 0").collect()}


def test_edge_cases(edge):
    rows = mixing.mix(edge, block=8).taken().collect()
    assert len(rows) == edge.count()
    sizes, taken, target = by_source(rows)
    assert set(sizes) == {"a", "b", "c", None}
    out = mixing.mixed_documents(edge, mixing.mix(edge, block=8))
    assert out.columns == edge.columns
    words = out.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words == sum(taken.values())
    empty = mixing.mix(edge.limit(0))
    assert empty.taken().count() == 0 and mixing.mixed_documents(edge.limit(0), empty).count() == 0
