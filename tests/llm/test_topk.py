import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import topk
from tests.llm import brute


@pytest.mark.parametrize("shard,dense", [(2048, 4), (64, 4), (64, 1)])
def test_equals_brute_force(spark, monkeypatch, shard, dense):
    """Also as sparse postings, with ties and whole-number weights of either sign."""
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "_DENSE", dense)
    dice = np.random.default_rng(1)
    values = dice.normal(size=(400, 12)) * (dice.random((400, 12)) < 0.4)
    values[::9] = values[0]
    values[100:150] = np.abs(values[100:150])
    rows = [(i, v) for i, v in enumerate(values.tolist())]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    df = df.select("id", topk.whole_weights(F.col("v")).alias("weights"))
    got = topk.top_k(df.filter("id % 7 = 0"), df).collect()
    assert sorted(map(tuple, got)) == brute.top_k(rows, 7, 5)


@pytest.mark.parametrize("group", [1, 2, 5])
def test_groups_of_shards_and_blocks(spark, monkeypatch, group):
    """Blocks held in a task while shards stream past them, with thresholds carried along."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    monkeypatch.setattr(topk, "GROUP_BLOCKS", group)
    monkeypatch.setattr(topk, "GROUP_SHARDS", group)
    dice = np.random.default_rng(3)
    values = np.round(dice.normal(size=(300, 8)), 1) * (dice.random((300, 8)) < 0.6)
    rows = list(enumerate(values.tolist()))
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(2)
    df = df.select("id", topk.whole_weights(F.col("v")).alias("weights"))
    got = topk.top_k(df.filter("id % 3 = 0"), df).collect()
    assert sorted(map(tuple, got)) == brute.top_k(rows, 3, 5)


def test_a_shard_is_built_once_for_the_blocks_of_a_task(monkeypatch):
    """The stream of a group: two query blocks, then three shards."""
    import pyarrow as pa

    built, probed = [], []
    dice = np.random.default_rng(4)

    def packed(first, n):
        weights = dice.integers(1, 100, size=(n, 6))
        content = [np.arange(first, first + n), np.arange(n + 1) * 6, np.tile(np.arange(6), n).astype(np.int32), weights.reshape(-1)]
        return {name: x.tobytes() for name, x in zip(topk._KINDS, content)}

    class Counted(topk.Shard):
        def __init__(self, *content):
            built.append(1)
            super().__init__(*content)

        def best(self, own, terms, weights, k, threshold=topk._NONE):
            probed.append(threshold)
            return super().best(own, terms, weights, k, threshold)

    monkeypatch.setattr(topk, "Shard", Counted)
    group = [{"shards": 0, "blocks": 0, "is_shard": False, **packed(1000 * n, 4)} for n in (1, 2)]
    group += [{"shards": 0, "blocks": 0, "is_shard": True, **packed(100 * n, 50)} for n in (1, 2, 3)]
    told = list(topk._searcher(5)(iter([pa.RecordBatch.from_pylist(group)])))
    assert len(built) == 3 and sum(map(len, told)) == 8 * 5
    assert probed[:8] == [topk._NONE] * 8 and all(t > 0 for t in probed[8:])
    assert all(late >= early for early, late in zip(probed[8:16], probed[16:]))


def test_edge_cases(spark):
    nan = float("nan")
    rows = [(0, [1.0, -1.0]), (1, None), (2, [nan, 1.0]), (3, [1.0, None]), (4, [-1.0, 1.0]), (5, [0.0, 0.0]), (6, [1.0]), (7, [])]
    df = spark.createDataFrame(rows, "id long, v array<double>").select("id", topk.whole_weights(F.col("v")).alias("weights"))
    df = df.filter("weights is not null")
    got = topk.top_k(df.filter("id = 0"), df).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 6, 65536), (2, 5, 0), (3, 7, 0), (4, 4, -131072)]
    assert topk.top_k(df.limit(0), df).count() == topk.top_k(df, df.limit(0)).count() == 0
    twice = topk.top_k(df.filter("id = 0"), df.unionByName(df)).collect()
    assert [r.vec_id for r in sorted(twice, key=lambda r: r["rank"])] == [6, 6, 5, 5, 7]
