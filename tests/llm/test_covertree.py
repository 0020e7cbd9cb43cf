import numpy as np
import pyarrow as pa
import pytest

from linkloom.llm import covertree
from tests.llm import brute

SCHEMA = "vec_id long, label int, embedding array<double>"


def vectors():
    dice = np.random.default_rng(2)
    rows = []
    for k in range(12):  # clusters from tight to loose
        center = dice.normal(size=16)
        for _ in range(40):
            rows.append((center + dice.normal(size=16) * 0.03 * (k + 1)).tolist())
    rows += dice.normal(size=(300, 16)).tolist() + [rows[0]] * 5 + [[2 * x for x in rows[0]]]
    return [(i, i % 2 if i < 480 else 0, v) for i, v in enumerate(rows)]


def result(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in rows)
    return {r.vec_id: (r.n_links, r.component_id) for r in rows}


@pytest.mark.parametrize("block,leaf", [(2048, 64), (50, 8)])
def test_equals_brute_force(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(covertree, "BLOCK", block)
    monkeypatch.setattr(covertree, "LEAF", leaf)
    monkeypatch.setattr(covertree, "SLICE", 100)
    rows = vectors()
    got = result(covertree.linked_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert got == brute.linked_vectors(rows)


def test_trees_of_one_process_equal_products(monkeypatch):
    """Leaves of few vectors, so that nodes are pruned, opened and taken whole."""
    monkeypatch.setattr(covertree, "LEAF", 3)
    rows = np.array([v for _, _, v in vectors()])
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    ones = np.ones(len(unit), dtype=np.int64)
    linked = unit @ unit.T >= 0.93
    tree = covertree.block_tree(unit, 0.93)
    assert len(tree.children) > 1
    assert (covertree.link_blocks(unit, unit, ones, ones, tree, tree, True, 0.93).count_a == linked.sum(1) - 1).all()
    parts = unit[:300], unit[300:]
    trees = [covertree.block_tree(u, 0.93) for u in parts]
    half = covertree.link_blocks(*parts, ones[:300], ones[300:], *trees, False, 0.93)
    assert (half.count_a == linked[:300, 300:].sum(1)).all() and (half.count_b == linked[:300, 300:].sum(0)).all()


@pytest.mark.parametrize("leaf", [1, 3, 1000])
def test_a_stored_tree_is_the_tree(monkeypatch, leaf):
    monkeypatch.setattr(covertree, "LEAF", leaf)
    rows = np.array([v for _, _, v in vectors()])
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    built = covertree.block_tree(unit, 0.93)
    todo, nodes = [(built, covertree.tree_from(covertree.tree_bytes(built), unit))], 0
    while todo:
        x, y = todo.pop()
        nodes += 1
        assert x.row == y.row and (x.center == y.center).all() and x.radius == y.radius
        assert sorted(x.members.tolist()) == sorted(y.members.tolist()) and len(x.children) == len(y.children)
        todo += zip(x.children, y.children)
    assert nodes == 1 if leaf == 1000 else nodes > 50


def test_comparing_blocks_builds_no_tree(monkeypatch):
    """The work of a pair of blocks holds both trees."""
    unit = [covertree._unit(pa.table({"v": [v for _, _, v in vectors()][n : n + 60]})) for n in (0, 60)]
    row = {"same": False}
    for s, u, first in zip("ab", unit, (0, 100)):
        ids, tree = np.arange(first, first + 60), covertree.tree_bytes(covertree.block_tree(u, 0.93))
        row |= {f"{s}_rep": ids.tobytes(), f"{s}_copies": np.ones(60, np.int64).tobytes(), f"{s}_unit": u.tobytes(), f"{s}_tree": tree}
    monkeypatch.setattr(covertree.Tree, "__init__", lambda *a: pytest.fail("a tree was built"))
    told = list(covertree._traverse(0.93)(iter([pa.RecordBatch.from_pylist([row])])))
    linked = unit[0] @ unit[1].T >= 0.93
    assert sum(told[0].column("links").to_pylist()) == 2 * linked.sum()


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [1.0, 0.0]), (2, 0, [1.0, 0.0]), (2, 0, [1.0, 0.0]), (3, None, [1.0, 0.0]), (4, 0, None), (5, 0, [0.0, 0.0]), (6, 0, [nan, 1.0])]
    rows += [(7, 0, [inf, 1.0]), (8, 0, [1.0, None]), (9, 0, []), (10, 0, [1.0]), (11, 0, [2e300, 1e297]), (12, 1, [1.0, 0.0]), (None, 0, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", rep string, dim string")
    got = covertree.linked_vectors(df).collect()
    assert len(got) == len(rows)
    by_id = {r.vec_id: (r.n_links, r.component_id) for r in got}
    assert by_id[1] == (3, 1) and by_id[2] == (3, 1) and by_id[11] == (3, 1)
    assert all(by_id[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10, 12)) and by_id[None] == (0, None)
    assert covertree.linked_vectors(df.limit(0)).count() == 0
