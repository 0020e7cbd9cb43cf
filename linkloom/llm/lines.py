"""Line dedup that can be taken back: sharded cuckoo filters over exact reference-count tables.

A line's key is a 128-bit digest of the line, stripped and with A-Z lowered.  The index holds

* ``refs``: one row for each (key, document) - the exact table that makes deletion possible;
* ``counts``: for each key the number of documents that hold it and the largest of their ids;
* ``filters``: for each shard of the keys a cuckoo filter of the keys that are *repeated*.

Documents are added and removed in batches.  A step looks only at the keys of its batch, but writes
the tables that it changes anew as a whole: ``counts`` on insertion, both on deletion.  A cuckoo
filter, unlike a Bloom filter, can drop a key again when its count falls.  To tell which lines go,
references meet the filter of their shard, and only those it lets through (the repeated ones and
a few false alarms) are joined with the exact counts.  No filter error reaches a result.

A key held by a third of all documents is one row of ``counts`` (combined before the shuffle); its
references are spread over slices, as many as the shard's measured size asks for.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import SPACES, col, fresh, table
from linkloom.session import stored

MIN_DOCS = 3
MIN_POINTS = 20
KEYS_PER_SHARD = 100_000
MAX_SHARDS = 65_536
ROWS_PER_SLICE = 250_000
SLOTS = 4
_LOAD = 0.8
_KICKS = 500


# -- the filter of one shard ----------------------------------------------------------------------


class Cuckoo:
    """Sixteen-bit fingerprints in buckets of four; a key may sit in two buckets."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1 << max(1, math.ceil(math.log2(max(1, keys) / (SLOTS * _LOAD))))
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def of(cls, k1: np.ndarray, k2: np.ndarray) -> Cuckoo:
        """A filter of these keys, larger if they do not fit."""
        made = cls.sized(len(k1))
        while not made.add(k1, k2):
            made = cls(np.zeros((2 * len(made.cells), SLOTS), dtype=np.uint16))
        return made

    @classmethod
    def read(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, dtype=np.uint16).reshape(-1, SLOTS).copy())

    def bytes(self) -> bytes:
        return self.cells.tobytes()

    def _places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.cells) - 1)
        prints = (k2.view(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        first = k1.view(np.uint64) & mask
        return prints, first.astype(np.int64), self._other(first, prints)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.cells) - 1)
        turn = (prints.astype(np.uint64) * np.uint64(0x5BD1E995)) & mask
        return (bucket.astype(np.uint64) ^ turn).astype(np.int64)

    def has(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(k1, k2)
        want = prints[:, None]
        return (self.cells[first] == want).any(axis=1) | (self.cells[second] == want).any(axis=1)

    def add(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """False if a key found no place; the filter is then to be made anew."""
        prints, first, second = self._places(k1, k2)
        left = np.arange(len(prints))
        for side in (first, second):
            left = self._settle(left, side, prints)
        dice = np.random.default_rng(0)
        for k in left:
            bucket, mark = int(second[k]), prints[k]
            for _ in range(_KICKS):
                free = np.flatnonzero(self.cells[bucket] == 0)
                if len(free):
                    self.cells[bucket, free[0]] = mark
                    break
                slot = dice.integers(SLOTS)
                mark, self.cells[bucket, slot] = self.cells[bucket, slot], mark
                bucket = int(self._other(np.array([bucket]), np.array([mark]))[0])
            else:
                return False
        return True

    def _settle(self, which: np.ndarray, side: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Put as many as fit into free cells of their bucket; the others are returned."""
        which = which[np.argsort(side[which], kind="stable")]
        buckets = side[which]
        new = np.r_[True, buckets[1:] != buckets[:-1]] if len(buckets) else np.empty(0, bool)
        starts = np.flatnonzero(new)
        rank = np.arange(len(buckets)) - np.repeat(starts, np.diff(np.r_[starts, len(buckets)]))
        cells = self.cells[buckets]
        fits = rank < (cells == 0).sum(axis=1)
        slot = np.argsort(cells != 0, axis=1, kind="stable")[fits, rank[fits]]
        self.cells[buckets[fits], slot] = prints[which[fits]]
        return which[~fits]

    def remove(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Only for keys that were added."""
        for mark, *both in zip(*self._places(k1, k2)):
            for bucket in both:
                at = np.flatnonzero(self.cells[bucket] == mark)
                if len(at):
                    self.cells[bucket, at[0]] = 0
                    break


# -- lines and keys -----------------------------------------------------------------------------------


def line_digest(line: str, min_points: int = MIN_POINTS) -> bytes | None:
    """Digest of the line's key; None if the key is shorter than ``min_points`` code points."""
    key = line.strip(SPACES)
    if len(key) < min_points:
        return None
    return hashlib.blake2b(key.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


_REFS = "doc_id long, k1 long, k2 long"


def references(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_points: int = MIN_POINTS) -> DataFrame:
    """(doc_id, k1, k2): each key of each document once."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, counts = batch.column(0), [], []
            for cell in batch.column(1):
                body = cell.as_py()
                digests = {line_digest(x, min_points) for x in body.split("\n")} if body else set()
                digests.discard(None)
                found.extend(sorted(digests))
                counts.append(len(digests))
            halves = np.frombuffer(b"".join(found), dtype=np.int64).reshape(-1, 2)
            repeated = ids.take(pa.array(np.repeat(np.arange(len(ids)), counts)))
            columns = [repeated, pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "k1", "k2"])

    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    return rows.mapInArrow(keys, _REFS)


# -- the index ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LineIndex:
    """A state of the index.  Each change gives a new one and leaves the old one readable."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    min_points: int = MIN_POINTS

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = MIN_DOCS, min_points: int = MIN_POINTS, text: str = "text") -> LineIndex:
        """Index of all ``docs``; the number of shards follows the number of keys.

        Rows that share a doc_id are one document; a null doc_id counts for none, as in SQL.
        """
        refs = stored(references(docs, text, min_points=min_points))
        counts = stored(_count(refs))
        shards = min(MAX_SHARDS, max(1, math.ceil(counts.count() / KEYS_PER_SHARD)))
        empty = refs.sparkSession.createDataFrame([], "shard int, cells binary")
        index = cls(refs, counts, empty, shards, min_docs, min_points)
        rising = counts.filter(F.col("n_docs") >= min_docs).select("k1", "k2", F.lit(True).alias("rises"))
        return replace(index, filters=stored(index._changed_filters(rising, fresh=True)))

    def insert(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """The index with these documents added."""
        new = stored(references(docs, text, min_points=self.min_points))
        known = self.refs.join(new.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
        added = new.join(known, ["k1", "k2", "doc_id"], "left_anti")
        delta = _count(added).select("k1", "k2", F.col("n_docs").alias("_n"), F.col("max_doc").alias("_max"))
        merged = self.counts.join(delta, ["k1", "k2"], "full_outer").select(
            "k1",
            "k2",
            (F.coalesce("n_docs", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n_docs"),
            F.greatest("max_doc", "_max").alias("max_doc"),
            F.coalesce("n_docs", F.lit(0)).alias("_was"),
        )
        merged = stored(merged)
        rises = merged.filter((F.col("n_docs") >= self.min_docs) & (F.col("_was") < self.min_docs))
        rises = rises.select("k1", "k2", F.lit(True).alias("rises"))
        after = replace(self, refs=self.refs.unionByName(new), counts=merged.drop("_was"))
        return replace(after, filters=stored(after._changed_filters(rises, base=self.filters)))

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents whose id is in the only column of ``doc_ids``."""
        ids = doc_ids.select(F.col(doc_ids.columns[0]).cast("long").alias("doc_id")).distinct()
        gone = stored(self.refs.join(ids, "doc_id", "left_semi"))
        refs = stored(self.refs.join(ids, "doc_id", "left_anti"))
        hit = stored(gone.select("k1", "k2").distinct())
        before = self.counts.join(hit, ["k1", "k2"], "left_semi")
        recounted = stored(_count(refs.join(hit, ["k1", "k2"], "left_semi")))
        counts = stored(self.counts.join(hit, ["k1", "k2"], "left_anti").unionByName(recounted))
        now = recounted.select("k1", "k2", F.col("n_docs").alias("_n"))
        falls = before.filter(F.col("n_docs") >= self.min_docs).join(now, ["k1", "k2"], "left")
        falls = falls.filter(F.coalesce("_n", F.lit(0)) < self.min_docs).select("k1", "k2", F.lit(False).alias("rises"))
        after = replace(self, refs=refs, counts=counts)
        return replace(after, filters=stored(after._changed_filters(falls, base=self.filters)))

    # the filters

    def _shard(self):
        return F.pmod(F.xxhash64("k1", "k2"), F.lit(self.shards)).cast("int")

    def repeated(self) -> DataFrame:
        return self.counts.filter(F.col("n_docs") >= self.min_docs)

    def _changed_filters(self, changes: DataFrame, base: DataFrame | None = None, fresh: bool = False) -> DataFrame:
        changes = changes.withColumn("shard", self._shard())
        if fresh:
            return _new_filters(changes)
        updated = changes.groupBy("shard").cogroup(base.groupBy("shard"))
        updated = stored(updated.applyInArrow(_update_filter, "shard int, cells binary"))
        full = updated.filter("cells is null").select("shard")  # these no longer fit: made anew from the exact table
        keys = self.repeated().withColumn("shard", self._shard()).join(full, "shard", "left_semi")
        return updated.filter("cells is not null").unionByName(_new_filters(keys))

    # what goes

    def suspects(self) -> DataFrame:
        """References that pass the filter of their shard.

        A shard's references are cut into slices of about ``ROWS_PER_SLICE``, each with its own
        copy of the filter; the slices a shard needs are measured, a table of at most
        ``MAX_SHARDS`` rows.
        """
        refs = self.refs.withColumn("shard", self._shard())
        sizes = refs.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_SLICE).cast("int").alias("slices"))
        sizes = F.broadcast(sizes)
        refs = refs.join(sizes, "shard").withColumn("slice", F.pmod(F.xxhash64("doc_id", "k1"), F.col("slices")).cast("int"))
        filters = self.filters.join(sizes, "shard").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        nothing = F.lit(None)
        refs = refs.select("shard", "slice", "doc_id", "k1", "k2", nothing.cast("binary").alias("cells"))
        filters = filters.select("shard", "slice", *[nothing.cast("long").alias(c) for c in ("doc_id", "k1", "k2")], "cells")
        # a slice's filter comes before its references, which then stream by
        work = refs.unionByName(filters).repartition("shard", "slice").sortWithinPartitions("shard", "slice", F.col("cells").isNull())
        return work.mapInArrow(_probe, _REFS)

    def dropped(self) -> DataFrame:
        """(doc_id, k1, k2): the keys whose lines each document loses, checked on the exact counts.

        The largest doc_id keeps its lines; a null doc_id is below all others.
        """
        exact = self.repeated().select("k1", "k2", "max_doc")
        return self.suspects().join(exact, ["k1", "k2"]).filter(~F.col("doc_id").eqNullSafe(F.col("max_doc"))).drop("max_doc")


def _count(refs: DataFrame) -> DataFrame:
    return refs.groupBy("k1", "k2").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("max_doc"))


def _key_arrays(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return rows.column("k1").to_numpy(), rows.column("k2").to_numpy()


def _filter_row(shard: int, cells: bytes | None) -> pa.Table:
    return pa.table({"shard": pa.array([shard], pa.int32()), "cells": pa.array([cells], pa.binary())})


def _stretches(*columns: np.ndarray) -> list[tuple[int, int]]:
    """From and to of the rows that are equal in all columns and stand together."""
    if not len(columns[0]):
        return []
    new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
    return list(zip([0, *new.tolist()], [*new.tolist(), len(columns[0])]))


def _new_filters(keys: DataFrame) -> DataFrame:
    """(shard, cells): a filter of the keys (shard, k1, k2) of each shard."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def made() -> list[pa.RecordBatch]:
            k1, k2 = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            return _filter_row(shard, Cuckoo.of(k1, k2).bytes()).to_batches()

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            k1, k2 = _key_arrays(batch)
            for lo, hi in _stretches(shards):
                if held and shards[lo] != shard:
                    yield from made()
                    held = []
                shard = int(shards[lo])
                held.append((k1[lo:hi], k2[lo:hi]))
        if held:
            yield from made()

    sorted_keys = keys.select("shard", "k1", "k2").repartition("shard").sortWithinPartitions("shard")
    return sorted_keys.mapInArrow(build, "shard int, cells binary")


def _update_filter(changes: pa.Table, base: pa.Table) -> pa.Table:
    if not len(changes):
        return base.select(["shard", "cells"])
    shard, rises = changes.column("shard")[0].as_py(), changes.column("rises").to_numpy(zero_copy_only=False)
    k1, k2 = _key_arrays(changes)
    if not len(base):
        return _filter_row(shard, Cuckoo.of(k1[rises], k2[rises]).bytes())
    cuckoo = Cuckoo.read(base.column("cells")[0].as_py())
    cuckoo.remove(k1[~rises], k2[~rises])
    return _filter_row(shard, cuckoo.bytes() if cuckoo.add(k1[rises], k2[rises]) else None)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """References that the filter in front of their slice lets through."""
    here, cuckoo = None, None
    for batch in batches:
        shards, slices, cells = batch.column("shard").to_numpy(), batch.column("slice").to_numpy(), batch.column("cells")
        refs = cells.is_null().to_numpy(zero_copy_only=False)
        for lo, hi in _stretches(shards, slices, refs):
            if not refs[lo]:
                here, cuckoo = (shards[lo], slices[lo]), Cuckoo.read(cells[lo].as_py())
            elif here == (shards[lo], slices[lo]):
                part = batch.slice(lo, hi - lo).select(["doc_id", "k1", "k2"])
                yield part.filter(pa.array(cuckoo.has(*_key_arrays(part))))


# -- texts without their repeated lines ------------------------------------------------------------------


def _clean(body: str | None, gone: set[bytes] | None, min_points: int) -> tuple[str, int, int]:
    lines = (body or "").split("\n")
    if not gone:
        return body or "", len(lines), 0
    kept = [x for x in lines if line_digest(x, min_points) not in gone]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def _with_gone(docs: DataFrame, index: LineIndex, name: str = "_gone") -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``name``: the keys to drop."""
    key = fresh(docs, "_id")
    gone = index.dropped().groupBy(F.col("doc_id").alias(key)).agg(F.collect_list(F.struct("k1", "k2")).alias(name))
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(gone[key]), "left").drop(key)


def _gone_keys(batch: pa.RecordBatch, name: str) -> list[set[bytes] | None]:
    return [
        None if keys is None else {k["k1"].to_bytes(8, "little", signed=True) + k["k2"].to_bytes(8, "little", signed=True) for k in keys}
        for keys in batch.column(name).to_pylist()
    ]


def cleaned(docs: DataFrame, index: LineIndex) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, kept_sha256) of each row of ``docs``; null text reads as empty."""
    min_points = index.min_points

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped, shas = [], [], [], []
            for body, gone in zip(batch.column("text"), _gone_keys(batch, "_gone")):
                kept, lines, dropped = _clean(body.as_py(), gone, min_points)
                texts.append(kept)
                n_lines.append(lines)
                n_dropped.append(dropped)
                shas.append(hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest())
            columns = [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_lines", "n_dropped", "kept_sha256"])

    rows = _with_gone(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), index)
    return rows.mapInArrow(strip, "doc_id long, text string, n_lines long, n_dropped long, kept_sha256 string")


def drop_repeated_lines(docs: DataFrame, index: LineIndex | None = None) -> DataFrame:
    """``docs`` without the lines the index drops, all columns kept; ``n_chars`` follows the text.

    A document that loses lines and has nothing left but white space goes; one that was empty
    before stays as it was.
    """
    index = index or LineIndex.build(docs)
    min_points, columns = index.min_points, docs.columns

    @F.pandas_udf("string")
    def strip(bodies, keys):
        import pandas as pd

        out = []
        for body, gone in zip(bodies, keys):
            if gone is None or not len(gone):
                out.append(body)
            else:
                found = {int(k["k1"]).to_bytes(8, "little", signed=True) + int(k["k2"]).to_bytes(8, "little", signed=True) for k in gone}
                out.append(_clean(body, found, min_points)[0])
        return pd.Series(out, dtype=object)

    gone = fresh(docs, "_gone")
    rows, whole = _with_gone(docs, index, gone), F.col(gone).isNull()
    # called non-deterministic so that the filter below does not run it a second time
    stripped = strip.asNondeterministic()("text", gone)
    rows = rows.withColumn("text", F.when(whole, F.col("text")).otherwise(stripped))
    rows = rows.filter(whole | (F.trim(F.translate("text", SPACES, " " * len(SPACES))) != ""))
    if "n_chars" in columns:
        kept = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(kept))
    return rows.select(*[col(c) for c in columns])


def query(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document, from an index of all of them."""
    docs = table(spark, sf_dir, "documents")
    return cleaned(docs, LineIndex.build(docs)).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


SQL = r"""
with lines as (
    select doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
          from documents)
), repeated as (
    select key, max(doc_id) as keeper from lines where length(key) >= 20
    group by key having count(distinct doc_id) >= 3
), marked as (
    select l.doc_id, l.pos, l.line, r.keeper is not null and r.keeper <> l.doc_id as gone
    from lines l left join repeated r on l.key = r.key
)
select doc_id, count(*) as n_lines, cast(sum(case when gone then 1 else 0 end) as bigint) as n_dropped,
       sha256(coalesce(string_agg(case when gone then null else line end, chr(10) order by pos), '')) as kept_sha256
from marked group by doc_id
"""
