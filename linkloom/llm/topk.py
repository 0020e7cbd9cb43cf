"""Exact top-k inner products with MaxScore.

Dimensions are terms, rows documents, whole-number components the weights of postings.  The rows
are packed, where they are read, into index shards of at most ``SHARD_ROWS``; a shard has the
postings of each term and the term's smallest and largest weight.  Queries are packed likewise.
A few shards and a few query blocks are one group of work: a task holds the blocks and streams the
shards past them, building each shard's postings once.

Within a shard, a query's terms are ordered by the most they can add.  The terms that together
cannot lift a row to the k-th best score so far are non-essential.  Postings of the essential
terms are traversed and summed up; the others are probed term by term, largest bound first, and
only for rows that can still compete.  The k-th best score is carried from shard to shard, and
rises within one as soon as k rows are sure of more.  The best k of each group are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.llm.common import col, table
from linkloom.session import stored

K = 5
SCALE = 256
QUERY_STRIDE = 50
SHARD_ROWS = 2048
#: A small table gets smaller shards, so that it still makes about so many, but none below LEAST_ROWS.
SHARDS = 16
LEAST_ROWS = 64
QUERY_ROWS = 1024
#: Query blocks a task holds, and the most shards that it streams past them.
GROUP_BLOCKS = 8
GROUP_SHARDS = 8
MAX_TASKS = 20_000
_DENSE = 4  # a term that every fourth row has, at least, is kept as a whole column
_NONE = -(1 << 62)  # below any score
_PACKED = "part int, seq int, n long, ids binary, starts binary, terms binary, weights binary"


# -- packing ------------------------------------------------------------------------------------------


def _packer(rows_each: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def made(rows: pa.Table) -> pa.RecordBatch:
            nonlocal seq
            lists = rows.column("weights").combine_chunks()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            starts = np.r_[0, np.cumsum(lengths)]
            terms = np.arange(len(flat)) - np.repeat(starts[:-1], lengths)
            there = flat != 0  # a weight of 0 is no posting
            kept = np.r_[0, np.cumsum(there)][starts]
            columns = [rows.column("id").to_numpy().astype(np.int64), kept.astype(np.int64), terms[there].astype(np.int32), flat[there]]
            seq += 1
            head = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(rows)], pa.int64())]
            return pa.RecordBatch.from_arrays(head + [pa.array([c.tobytes()], pa.binary()) for c in columns], names=[f.split()[0] for f in _PACKED.split(", ")])

        for batch in batches:
            held.append(batch)
            size += len(batch)
            while size >= rows_each:
                rows = pa.Table.from_batches(held)
                yield made(rows.slice(0, rows_each))
                held = rows.slice(rows_each).combine_chunks().to_batches()
                size -= rows_each
        if size:
            yield made(pa.Table.from_batches(held))

    return pack


def packed(rows: DataFrame, rows_each: int, number: str) -> DataFrame:
    """Blocks of ``rows`` (id, weights array<long>), numbered from 0 in the column ``number``."""
    blocks = stored(rows.mapInArrow(_packer(rows_each), _PACKED))
    numbers = blocks.select("part", "seq").withColumn(number, F.row_number().over(Window.orderBy("part", "seq")) - 1)
    return blocks.join(numbers, ["part", "seq"]).drop("part", "seq")


class Shard:
    """Postings by term: the rows (or all of them, if many) and their weights, and the weights' bounds."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        self.ids, self.n = ids, len(ids)
        rows = np.repeat(np.arange(self.n), np.diff(starts))
        order = np.lexsort((rows, terms))
        terms, rows, weights = terms[order], rows[order], weights[order]
        names, begin = np.unique(terms, return_index=True)
        self.postings: dict[int, tuple[np.ndarray | None, np.ndarray]] = {}
        self.bounds: dict[int, tuple[int, int]] = {}
        for term, lo, hi in zip(names.tolist(), begin.tolist(), [*begin[1:].tolist(), len(terms)]):
            low, high = int(weights[lo:hi].min()), int(weights[lo:hi].max())
            if hi - lo < self.n:  # some rows have weight 0
                low, high = min(low, 0), max(high, 0)
            self.bounds[term] = low, high
            if (hi - lo) * _DENSE >= self.n:
                column = np.zeros(self.n, dtype=np.int64)
                column[rows[lo:hi]] = weights[lo:hi]
                self.postings[term] = None, column
            else:
                self.postings[term] = rows[lo:hi], weights[lo:hi]

    def of(self, term: int, rows: np.ndarray) -> np.ndarray:
        """Weights of ``rows`` (ascending) for a term."""
        where, weights = self.postings[term]
        if where is None:
            return weights[rows]
        at = np.minimum(np.searchsorted(where, rows), len(where) - 1)
        return np.where(where[at] == rows, weights[at], 0)

    def add(self, term: int, factor: int, total: np.ndarray) -> None:
        where, weights = self.postings[term]
        if where is None:
            total += factor * weights
        else:
            total[where] += factor * weights

    def best(self, own: int, terms: np.ndarray, weights: np.ndarray, k: int, threshold: int = _NONE) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best for one query, its own id left out; ties go to the smaller id.

        Rows below ``threshold``, a score that k rows are known to reach, are left out.
        """
        lists = []
        for term, weight in zip(terms.tolist(), weights.tolist()):
            if term in self.postings:
                least, most = sorted(weight * bound for bound in self.bounds[term])
                lists.append((most, term, weight, least))
        lists.sort()
        allowed = self.ids != own
        # the most and the least that the first i lists add together
        bounds = np.cumsum([0] + [x[0] for x in lists])
        floors = np.cumsum([0] + [x[3] for x in lists])
        if threshold == _NONE:
            threshold = self._seed(lists, allowed, k)
        # non-essential: the longest run of lists that cannot reach the threshold together
        essential = int(np.searchsorted(np.maximum.accumulate(bounds), threshold, side="left")) - 1 if threshold > 0 else 0
        essential = min(max(essential, 0), len(lists))
        total = np.zeros(self.n, dtype=np.int64)
        for _, term, weight, _ in lists[essential:]:
            self.add(term, weight, total)
        rows = np.flatnonzero(allowed)
        scores = total[rows]
        for i in range(essential, 0, -1):
            if len(rows) > k:  # k rows reach this, whatever the lists to come hold
                threshold = max(threshold, int(np.partition(scores, -k)[-k] + floors[i]))
            near = scores + bounds[i] >= threshold
            if not near.all():
                rows, scores = rows[near], scores[near]
            if not len(rows):
                break
            _, term, weight, _ = lists[i - 1]
            scores = scores + weight * self.of(term, rows)
        near = scores >= threshold
        rows, scores = rows[near], scores[near]
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[order], scores[order]

    def _seed(self, lists: list, allowed: np.ndarray, k: int) -> int:
        """A score that k rows reach: the k-th best of those that do best in the three strongest lists."""
        rough = np.zeros(self.n, dtype=np.int64)
        for _, term, weight, _ in lists[-3:]:
            self.add(term, weight, rough)
        rows = np.flatnonzero(allowed)
        if len(rows) <= k:
            return _NONE
        some = min(len(rows), 8 * k)
        rows = np.sort(rows[np.argpartition(-rough[rows], some - 1)[:some]])
        scores = np.zeros(len(rows), dtype=np.int64)
        for _, term, weight, _ in lists:
            scores += weight * self.of(term, rows)
        return int(np.sort(scores)[-k])


class Queries:
    """A block of queries and, for each, the best k of the shards it has met."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int):
        self.ids, self.starts, self.terms, self.weights, self.k = ids, starts, terms, weights, k
        nothing = np.empty(0, np.int64)
        self.found, self.scores = [nothing] * len(ids), [nothing] * len(ids)

    def meet(self, shard: Shard) -> None:
        for n, (own, lo, hi) in enumerate(zip(self.ids.tolist(), self.starts[:-1].tolist(), self.starts[1:].tolist())):
            threshold = int(self.scores[n][-1]) if len(self.scores[n]) == self.k else _NONE
            rows, values = shard.best(own, self.terms[lo:hi], self.weights[lo:hi], self.k, threshold)
            if len(rows):
                found, scores = np.r_[self.found[n], shard.ids[rows]], np.r_[self.scores[n], values]
                order = np.lexsort((found, -scores))[: self.k]
                self.found[n], self.scores[n] = found[order], scores[order]

    def told(self) -> pa.RecordBatch:
        queries = np.repeat(self.ids, [len(x) for x in self.found])
        columns = (queries, np.concatenate(self.found), np.concatenate(self.scores))
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=["query_id", "vec_id", "score"])


_FOUND = "query_id long, vec_id long, score long"
_KINDS = {"ids": np.int64, "starts": np.int64, "terms": np.int32, "weights": np.int64}


def _searcher(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come group by group, in each the query blocks before the shards."""
        group, held = None, []
        for batch in batches:
            for place in range(len(batch)):
                row = batch.slice(place, 1).to_pylist()[0]
                if (row["shards"], row["blocks"]) != group:
                    yield from (block.told() for block in held)
                    group, held = (row["shards"], row["blocks"]), []
                content = [np.frombuffer(row[name], dtype=kind) for name, kind in _KINDS.items()]
                if row["is_shard"]:
                    shard = Shard(*content)
                    for block in held:
                        block.meet(shard)
                else:
                    held.append(Queries(*content, k))
        yield from (block.told() for block in held)

    return search


# -- the operator -------------------------------------------------------------------------------------


def top_k(queries: DataFrame, rows: DataFrame, k: int = K, shard_rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product for each query.

    Both sides are (id long, weights array<long>); shorter vectors count as filled up with 0.
    Rows whose id is the query's are not its candidates.  Ties go to the smaller id; where there
    are fewer rows than k, all are told.  Repeated rows are rows of their own.  Nulls, in ids or
    in weights, are to be left out before.  A shard has ``shard_rows`` rows at most.
    """
    shards, blocks = packed(rows, shard_rows or SHARD_ROWS, "shard"), packed(queries, QUERY_ROWS, "block")
    n_shards, n_blocks = shards.count(), blocks.count()
    if not n_shards or not n_blocks:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    block_groups = math.ceil(n_blocks / GROUP_BLOCKS)
    # as many shards a group as leave work for every core
    a_group = min(GROUP_SHARDS, max(1, n_shards * block_groups // rows.sparkSession.sparkContext.defaultParallelism))
    shard_groups = math.ceil(n_shards / a_group)
    every_shards, every_blocks = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (shard_groups, block_groups))
    left = blocks.select(every_shards.alias("shards"), F.floor(F.col("block") / GROUP_BLOCKS).cast("int").alias("blocks"), F.lit(False).alias("is_shard"), *_KINDS)
    right = shards.select(F.floor(F.col("shard") / a_group).cast("int").alias("shards"), every_blocks.alias("blocks"), F.lit(True).alias("is_shard"), *_KINDS)
    work = left.unionByName(right).repartition(min(MAX_TASKS, shard_groups * block_groups), "shards", "blocks")
    found = work.sortWithinPartitions("shards", "blocks", "is_shard").mapInArrow(_searcher(k), _FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def whole_weights(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null where the vector or a component is null or not finite."""
    values = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(values, lambda x: F.floor(x * F.lit(float(scale)))))


def query(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    shard_rows = min(SHARD_ROWS, max(LEAST_ROWS, math.ceil(vectors.count() / SHARDS)))  # counted from the files' footers
    rows = vectors.select(F.col("vec_id").alias("id"), whole_weights(col("embedding")).alias("weights"))
    rows = rows.filter("id is not null and weights is not null")
    return top_k(rows.filter(F.col("id") % QUERY_STRIDE == 0), rows, shard_rows=shard_rows)


SQL = f"""
with whole as (
    select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as w
    from embeddings
    where embedding is not null and vec_id is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, d.vec_id, cast(list_sum(list_transform(range(1, len(d.w) + 1), lambda i: q.w[i] * d.w[i])) as bigint) as score
    from whole q join whole d on q.vec_id <> d.vec_id
    where q.vec_id % {QUERY_STRIDE} = 0
), ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= {K}
"""
