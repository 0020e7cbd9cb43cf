"""Exact embedding near-dedup with cover trees and dual traversal.

Vectors are compared by cosine within their label; on the unit sphere a cosine of at least t is a
distance of at most sqrt(2 - 2t).  The tree has its upper level in Spark: vectors of a large label
go to the nearest of a few centers, cells are cut into blocks, and pairs of blocks whose balls are
farther apart than the distance are left out.  Below, each block has a tree of nested levels with
halving radii.  Two trees are traversed together:

* two nodes farther apart than their covering radii and the distance: no pair links, cut off;
* two nodes closer than the distance even at their far ends: all pairs link, counted at once;
* otherwise the larger node is opened; two leaves are compared by their products.

A node whose next level would be mostly single points has nothing left to prune with and stays a
leaf.  A block's tree is built once and stored with its vectors; the tasks that compare the block
with others read it.  They return link counts and ties linear in their vectors, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.llm.common import components, table
from linkloom.session import stored

THRESHOLD = 0.93
BLOCK = 2048
LEAF = 64
#: Centers are chosen among at most so many vectors of a label, by the order of a hash.
SAMPLE = 2048
MAX_CENTERS = 256
SLICE = 20_000
_SLACK = 1e-7  # bounds decide only where rounding, of some 2e-8 in a distance near 0, cannot matter


# -- the tree of a block ----------------------------------------------------------------------------------


class Tree:
    """Node: center and its row, covering radius, members, children.  Members are row numbers of ``unit``."""

    __slots__ = ("row", "center", "radius", "members", "children")

    def __init__(self, unit: np.ndarray, members: np.ndarray, center: int, scale: float, floor: float):
        self.row, self.center, self.members = int(center), unit[center], members
        far = _distance(unit[members], self.center)
        self.radius = float(far.max())
        self.children: list[Tree] = []
        if len(members) <= LEAF or self.radius <= floor:
            return
        while scale >= self.radius:
            scale /= 2
        owner, centers = np.full(len(members), -1), []
        gap = np.full(len(members), np.inf)
        here = int(np.argmin(far))
        while True:  # a net of the next level: the farthest vector becomes a center while any is out of reach
            away = _distance(unit[members], unit[members[here]])
            owner = np.where(away < gap, len(centers), owner)
            gap = np.minimum(gap, away)
            centers.append(members[here])
            here = int(np.argmax(gap))
            if gap[here] <= scale:
                break
            if len(centers) * 4 > len(members):
                return
        self.children = [Tree(unit, members[owner == k], c, scale / 2, floor) for k, c in enumerate(centers)]


def _distance(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (rows @ one)))


def block_tree(unit: np.ndarray, threshold: float) -> Tree:
    """The tree of a block; nodes whose members all link need no children."""
    return Tree(unit, np.arange(len(unit)), 0, 2.0, _reach(threshold) / 2)


def _reach(threshold: float) -> float:
    """The distance of unit vectors whose cosine is ``threshold``."""
    return math.sqrt(max(0.0, 2.0 - 2.0 * threshold))


def tree_bytes(tree: Tree) -> bytes:
    """The nodes from the top, each before its children: center, radius, children; members of leaves."""
    nodes, members, todo = [], [], [tree]
    while todo:
        node = todo.pop()
        todo += reversed(node.children)
        nodes.append((node.row, node.radius, len(node.children), 0 if node.children else len(node.members)))
        if not node.children:
            members.append(node.members)
    rows, radii, below, held = zip(*nodes)
    head = np.array([len(nodes), *rows, *below, *held], dtype=np.int64)
    return head.tobytes() + np.array(radii).tobytes() + np.concatenate(members).astype(np.int64).tobytes()


def tree_from(data: bytes, unit: np.ndarray) -> Tree:
    """The tree that ``tree_bytes`` wrote, over the same vectors."""
    n = int(np.frombuffer(data, np.int64, 1)[0])
    rows, below, held = (x.tolist() for x in np.frombuffer(data, np.int64, 3 * n, 8).reshape(3, n))
    radii = np.frombuffer(data, np.float64, n, 8 + 24 * n).tolist()
    members = np.frombuffer(data, np.int64, offset=8 + 32 * n)
    end = len(members)
    done: list[Tree] = []  # finished subtrees, those of a node's children on top
    for i in range(n - 1, -1, -1):
        node = Tree.__new__(Tree)
        node.row, node.center, node.radius = rows[i], unit[rows[i]], radii[i]
        if below[i]:
            node.children = done[: -below[i] - 1 : -1]
            del done[-below[i] :]
            node.members = np.concatenate([c.members for c in node.children])
        else:
            node.children, node.members = [], members[end - held[i] : end]
            end -= held[i]
        done.append(node)
    return done[0]


class Links:
    """Counts of links and least ties between the rows of two blocks (or one)."""

    def __init__(self, a: np.ndarray, b: np.ndarray, copies_a: np.ndarray, copies_b: np.ndarray, same: bool, threshold: float):
        self.a, self.b, self.copies_a, self.copies_b, self.same, self.threshold = a, b, copies_a, copies_b, same, threshold
        self.reach = _reach(threshold)
        self.count_a, self.count_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        self.shift = 0 if same else len(a)  # rows of b are numbered after those of a
        self.left, self.right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]  # ties

    def traverse(self, x: Tree, y: Tree) -> None:
        todo = [(x, y)]
        while todo:
            x, y = todo.pop()
            inside = self.same and x is y
            apart = 0.0 if inside else float(_distance(x.center[None, :], y.center)[0])
            if apart > x.radius + y.radius + self.reach + _SLACK:
                continue
            if apart + x.radius + y.radius < self.reach - _SLACK:
                self._all(x.members, y.members, inside)
            elif not x.children and not y.children:
                self._compare(x.members, y.members, inside)
            elif inside:
                todo += [(c, d) for k, c in enumerate(x.children) for d in x.children[k:]]
            elif y.children and (not x.children or y.radius > x.radius):
                todo += [(x, d) for d in y.children]
            else:
                todo += [(c, y) for c in x.children]

    def _all(self, rows: np.ndarray, cols: np.ndarray, inside: bool) -> None:
        if inside:
            self.count_a[rows] += self.copies_a[rows].sum() - self.copies_a[rows]
            self._tie(rows, rows[0])
            return
        self.count_a[rows] += self.copies_b[cols].sum()
        (self.count_a if self.same else self.count_b)[cols] += self.copies_a[rows].sum()
        self._tie(rows, cols[0] + self.shift)
        self._tie(cols + self.shift, rows[0])

    def _compare(self, rows: np.ndarray, cols: np.ndarray, inside: bool) -> None:
        linked = self.a[rows] @ self.b[cols].T >= self.threshold
        if inside:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return
        self.count_a[rows] += linked @ self.copies_b[cols]
        if not inside:
            (self.count_a if self.same else self.count_b)[cols] += linked.T @ self.copies_a[rows]
        # ties: each row and column to the smallest mark it can reach, until nothing changes
        marks_r, marks_c = np.arange(len(rows)), np.full(len(cols), len(rows))
        while True:
            down = np.where(linked, marks_r[:, None], len(rows)).min(axis=0)
            down = np.minimum(down, marks_c)
            up = np.minimum(np.where(linked, down[None, :], len(rows)).min(axis=1), marks_r)
            if (down == marks_c).all() and (up == marks_r).all():
                break
            marks_r, marks_c = up, down
        hit = marks_c < len(rows)
        self._tie(rows, rows[marks_r])
        self._tie(cols[hit] + self.shift, rows[marks_c[hit]])

    def _tie(self, some: np.ndarray, to: np.ndarray) -> None:
        to = np.broadcast_to(to, some.shape)
        self.left.append(some[some != to])
        self.right.append(to[some != to])


def link_blocks(
    a: np.ndarray, b: np.ndarray, copies_a: np.ndarray, copies_b: np.ndarray, tree_a: Tree, tree_b: Tree, same: bool, threshold: float
) -> Links:
    """Links within a block of unit vectors (``same``) or between two."""
    links = Links(a, b, copies_a, copies_b, same, threshold)
    links.traverse(tree_a, tree_a if same else tree_b)
    return links


# -- the upper level ------------------------------------------------------------------------------------------


def _unit(rows: pa.Table, name: str = "v") -> np.ndarray:
    lists = rows.column(name).combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


_KEY = "label int, dim int"


def _centers(rows: pa.Table) -> pa.Table:
    """Farthest-first centers of a sample of one label."""
    rows = rows.sort_by("rep")
    unit, wanted = _unit(rows), min(rows.column("centers")[0].as_py(), len(rows))
    chosen, gap = [0], _distance(unit, unit[0])
    while len(chosen) < wanted and gap.max() > 0:
        chosen.append(int(np.argmax(gap)))
        gap = np.minimum(gap, _distance(unit, unit[chosen[-1]]))
    head = {n: pa.array([rows.column(n)[0].as_py()], pa.int32()) for n in ("label", "dim")}
    return pa.table({**head, "found": pa.array([unit[chosen].tobytes()], pa.binary())})


def _to_cells(rows: pa.Table, centers: pa.Table) -> pa.Table:
    out = rows.select(["label", "dim", "rep", "copies", "v"])
    if not len(rows):
        return out.append_column("cell", pa.array([], pa.int32()))
    if not len(centers):
        cell = np.zeros(len(rows), np.int32)
    else:
        unit = _unit(rows)
        cell = (unit @ np.frombuffer(centers.column("found")[0].as_py()).reshape(-1, unit.shape[1]).T).argmax(axis=1).astype(np.int32)
    return out.append_column("cell", pa.array(cell))


def _to_block(threshold: float):
    def made(rows: pa.Table) -> pa.Table:
        """One row for a block: unit vectors in one piece, their tree, mean direction and covering radius."""
        rows = rows.sort_by("rep")
        unit = _unit(rows)
        middle = unit.mean(axis=0)
        length = np.linalg.norm(middle)
        middle = middle / length if length > 0 else unit[0]
        head = {n: pa.array([rows.column(n)[0].as_py()], pa.int32()) for n in ("label", "dim", "cell", "part")}
        body = {n: rows.column(n).to_numpy().astype(np.int64).tobytes() for n in ("rep", "copies")}
        body |= {"unit": unit.tobytes(), "tree": tree_bytes(block_tree(unit, threshold))}
        ball = {"middle": pa.array([middle.tolist()], pa.list_(pa.float64())), "radius": pa.array([float(_distance(unit, middle).max())])}
        return pa.table({**head, **ball, **{n: pa.array([x], pa.binary()) for n, x in body.items()}})

    return made


def _traverse(threshold: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(len(batch)):
                row = batch.slice(place, 1).to_pylist()[0]
                reps, copies, units = ([np.frombuffer(row[f"{s}_{n}"], dtype=t) for s in "ab"] for n, t in (("rep", np.int64), ("copies", np.int64), ("unit", np.float64)))
                units = [u.reshape(len(r), -1) for u, r in zip(units, reps)]
                trees = [tree_from(row[f"{s}_tree"], u) for s, u in zip("ab", units)]
                links = link_blocks(*units, *copies, *trees, row["same"], threshold)
                names = reps[0] if links.same else np.r_[reps[0], reps[1]]
                counts = links.count_a if links.same else np.r_[links.count_a, links.count_b]
                left, right = names[np.concatenate(links.left)], names[np.concatenate(links.right)]
                some = counts > 0
                node, other = np.r_[names[some], left], np.r_[names[some], right]
                count = np.r_[counts[some], np.zeros(len(left), np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (node, count, other)], names=["rep", "links", "other"])

    return work


def comparable(vector: Column) -> Column:
    """Whether all components are finite and not all are 0."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def linked_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each row of ``rows`` (vec_id, label, embedding).

    Links are pairs of the same label and length with a cosine of at least ``threshold``.  A null
    label, a null, zero or empty vector, or one with a null or non-finite component has none.
    Equal vectors of a label are one node; each of them counts as a link.  A null vec_id takes no
    part; its component is null and it is kept.
    """
    known = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding").alias("v"))
    valid = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & comparable(F.col("v"))
    known = known.withColumn("dim", F.when(valid, F.size("v")))
    nodes = known.filter("dim is not null").groupBy("label", "dim", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(nodes)

    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("size"))
    # many small cells share blocks badly: two centers a block, none for a label of one block
    centers = F.when(F.col("size") > BLOCK, F.least(F.lit(MAX_CENTERS), F.ceil(F.col("size") / BLOCK) * 2)).otherwise(F.lit(0)).cast("int")
    sizes = stored(sizes.withColumn("centers", centers).withColumn("slices", F.ceil(F.col("size") / SLICE).cast("int")))
    key = ["label", "dim"]
    sample = nodes.join(sizes.filter("centers > 0"), key)
    by_hash = Window.partitionBy(*key).orderBy(F.xxhash64("rep"), "rep")
    sample = sample.withColumn("_n", F.row_number().over(by_hash)).filter(F.col("_n") <= SAMPLE).select(*key, "rep", "v", "centers")
    found = stored(sample.groupBy(*key).applyInArrow(_centers, f"{_KEY}, found binary"))
    sliced = nodes.join(sizes, key).withColumn("slice", F.pmod(F.xxhash64("rep"), F.col("slices")).cast("int"))
    copied = found.join(sizes, key).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    keys = [*key, "slice"]
    v_type = nodes.schema["v"].dataType.simpleString()
    cells = sliced.select(*keys, "rep", "copies", "v").groupBy(*keys).cogroup(copied.select(*keys, "found").groupBy(*keys))
    cells = stored(cells.applyInArrow(_to_cells, f"{_KEY}, rep long, copies long, v {v_type}, cell int"))
    parts = cells.groupBy(*key, "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    dealt = cells.join(stored(parts), [*key, "cell"]).withColumn("part", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("parts")).cast("int"))
    blocks = dealt.drop("parts").groupBy(*key, "cell", "part")
    kinds = "middle array<double>, radius double, rep binary, copies binary, unit binary, tree binary"
    blocks = blocks.applyInArrow(_to_block(threshold), f"{_KEY}, cell int, part int, {kinds}")
    blocks = stored(blocks.withColumn("block", F.struct("cell", "part")).drop("cell", "part"))

    work = _block_pairs(blocks, threshold)
    told = stored(work.mapInArrow(_traverse(threshold), "rep long, links long, other long"))
    counts = told.groupBy("rep").agg(F.sum("links").alias("links"))
    ties = components(told.filter("rep <> other").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    # a vec_id that occurs with several vectors ties them together
    grouped = known.filter("dim is not null").join(nodes, [*key, "v"]).select("vec_id", *key, "v", "rep", "copies")
    of_rep = counts.join(ties, counts["rep"] == ties["node"], "full_outer").select(
        F.coalesce("rep", "node").alias("_rep"), F.coalesce("links", F.lit(0)).alias("_links"), "component"
    )
    done = grouped.join(of_rep, F.col("rep") == F.col("_rep"), "left").select(
        "vec_id", (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    alone = known.filter("dim is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = done.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _block_pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """Work for each pair of blocks of a label whose balls come close enough, a block with itself included."""
    reach = _reach(threshold) + _SLACK
    key = ["label", "dim"]
    balls = blocks.select(*key, "block", "middle", "radius")
    a, b = (balls.select(*key, *[F.col(c).alias(f"{s}_{c}") for c in ("block", "middle", "radius")]) for s in "ab")
    product = F.aggregate(F.zip_with("a_middle", "b_middle", lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    apart = F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * product))
    same = F.col("a_block") == F.col("b_block")
    near = a.join(b, key).filter("a_block <= b_block").filter(same | (apart <= F.col("a_radius") + F.col("b_radius") + reach))
    near = near.select(*key, "a_block", "b_block", same.alias("same"))
    content = ("rep", "copies", "unit", "tree")
    for s in "ab":
        side = blocks.select(*key, F.col("block").alias(f"{s}_block"), *[F.col(c).alias(f"{s}_{c}") for c in content])
        near = near.join(side, [*key, f"{s}_block"])
    return near.select("same", *[f"{s}_{c}" for s in "ab" for c in content])


def query(spark, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))


#: All pairs of a label; the reachable ids of linked vectors by recursion.
SQL = f"""
with recursive good as (
    select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
    where label is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), sized as (
    select *, sqrt(list_sum(list_transform(v, lambda x: x * x))) as norm from good
), edges as (
    select a.vec_id as a, b.vec_id as b from sized a join sized b on a.label = b.label and len(a.v) = len(b.v)
    where a.vec_id <> b.vec_id
      and list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) / (a.norm * b.norm) >= {THRESHOLD}
), counts as (
    select a, count(*) as n from edges group by a
), reach as (
    select a as node, a as root from edges
    union
    select e.b, r.root from reach r join edges e on e.a = r.node
), components as (
    select node, min(root) as component from reach group by node
)
select e.vec_id, cast(coalesce(c.n, 0) as bigint) as n_links, coalesce(p.component, e.vec_id) as component_id,
       coalesce(p.component, e.vec_id) = e.vec_id as kept
from embeddings e left join counts c on c.a = e.vec_id left join components p on p.node = e.vec_id
"""
