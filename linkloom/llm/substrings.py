"""Substring dedup by relative Lempel-Ziv parsing of all documents against all of them.

The reference of the parse is the collection itself, in the order of (doc_id, start).  A stretch of
words may be copied from any place that starts earlier.  What makes this work without showing
every document to every part of the reference:

* Each window of ``window`` words has an anchor, the least of the hashes of its ``GRAM``-word
  grams (leftmost if tied).  Equal windows have equal anchors, wherever they stand.  The windows in
  a row that share an anchor's place are one *phrase*, so a document is a sequence of phrases, one
  for about seven words, and every window is in exactly one of them.
* The reference is indexed in blocks dealt by anchor.  A block holds each different phrase once,
  with its first place, however many copies there are (they are combined before the shuffle).
  Phrases whose anchor stands nowhere else have no source and go before that.
* A document is parsed greedily, left to right.  A phrase found in its block is copied from its
  first place.  A factor runs on as long as the next phrase is copied from where the last one
  ended; so one factor covers a copied passage of any length.
* At factor boundaries a phrase agrees with others of its block in part only.  There, and nowhere
  else, the windows are looked up one by one.

All words of a factor of ``window`` words or more are duplicate spans.  Keys are two hashes of 64
bits.  The work is that of aggregates and joins by hash; a passage that a third of the documents
share is one row of the index, and no group is ever gathered.

Rows are told apart by doc_id and text: rows with the same doc_id and different texts are parts of
one document that start at the same places, so none of two equal starts is the earlier one.  The
same row twice gives two equal results.  A null doc_id comes before all others.  Null, empty and
short texts have no windows and lose nothing.  Very long texts are cut like others: a document's
phrases are rows, and its text is held by one task at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import col, table
from linkloom.operators.joins import broadcast_if_small
from linkloom.session import discard, stored

WINDOW = 20
GRAM = 8
_BASE = 0x9E3779B97F4A7C15 | 1
_NO_ID = -(1 << 63)
#: Of a place: the digest that tells rows with one doc_id apart takes the low bits, the start the high ones.
_TEXT_BITS = 31


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of an odd number and of its inverse, as far as any text needed them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << n.bit_length()

            def powers(base: int) -> np.ndarray:
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                return np.multiply.accumulate(steps)

            self.up, self.down = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class Parsed:
    """The words of a text and hashes of any stretch of them."""

    def __init__(self, text: str | None):
        self.words = text.encode("utf-8", "surrogatepass").split() if text else []

    def __len__(self) -> int:
        return len(self.words)

    def hashed(self) -> None:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        up, self._down = _POWERS.to(len(hashes) + 1)
        self._sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(_mix(hashes) * up[:-1], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of the words from each start up to its end, the same wherever they stand."""
        return _mix((self._sums[ends] - self._sums[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))

    def phrases(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, numbers of windows, anchors and content hashes of the phrases."""
        at = np.arange(len(self) - GRAM + 1)
        grams = self.hashes(at, at + GRAM)
        places = at[: len(self) - window + 1] + np.lib.stride_tricks.sliding_window_view(grams, window - GRAM + 1).argmin(axis=1)
        starts = np.r_[0, np.flatnonzero(places[1:] != places[:-1]) + 1]
        counts = np.diff(np.r_[starts, len(places)])
        return starts, counts, grams[places[starts]], self.hashes(starts, starts + counts + window - 1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _scan(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for d, digest, text in zip(batch.column("d").to_pylist(), batch.column("t").to_pylist(), batch.column("text")):
            parsed = Parsed(text.as_py())
            if len(parsed) < window:
                continue
            parsed.hashed()
            starts, counts, anchors, contents = parsed.phrases(window)
            for held, found in zip(out, (np.full(len(starts), d), (starts << _TEXT_BITS) | digest, counts, anchors, contents)):
                held.append(found)
        if out[0]:
            d, at, n, h, c = (np.concatenate(held) for held in out)
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(at), pa.array(n.astype(np.int32)), _signed(h), _signed(c)], names=["d", "at", "n", "h", "c"])


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The windows of the phrases named in ``open``."""
    for batch in batches:
        out: list[list[np.ndarray]] = [[], [], [], []]
        rows = zip(batch.column("d").to_pylist(), batch.column("t").to_pylist(), batch.column("text"), batch.column("open"))
        for d, digest, text, wanted in rows:
            parsed = Parsed(text.as_py())
            parsed.hashed()
            starts, counts, anchors = (wanted.values.field(name).to_numpy() for name in ("start", "n", "h"))
            at = np.repeat(starts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            for held, found in zip(out, (np.full(len(at), d), (at << _TEXT_BITS) | digest, np.repeat(anchors, counts), parsed.hashes(at, at + window))):
                held.append(found)
        if out[0]:
            d, at, h, w = (np.concatenate(held) for held in out)
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(at), pa.array(h), _signed(w)], names=["d", "at", "h", "w"])


def _start(at):
    return F.shiftright(at, _TEXT_BITS)


def _place(doc: str, at: str):
    return F.struct(F.col(doc).alias("d"), F.col(at).alias("at"))


def _named(docs: DataFrame, text: str) -> DataFrame:
    digest = F.xxhash64(col(text)).bitwiseAND(F.lit((1 << _TEXT_BITS) - 1))
    return docs.select(F.coalesce(col("doc_id").cast("long"), F.lit(_NO_ID)).alias("d"), digest.alias("t"), col(text).alias("text"))


def _copies(rows: DataFrame, index: DataFrame, keys: list[str], n) -> DataFrame:
    """(d, t, span) of the rows that a place of the index is an earlier copy of."""
    mine, first = F.struct("d", _start(F.col("at"))), F.struct("first.d", _start(F.col("first.at")))
    found = rows.join(index.select(*keys, "first"), keys).filter(mine > first)
    source = F.col("first.d"), _start(F.col("first.at"))
    span = F.struct(_start(F.col("at")).alias("start"), n.cast("int").alias("n"), source[0].alias("source_doc"), source[1].alias("source_start"))
    return found.select("d", F.col("at").bitwiseAND(F.lit((1 << _TEXT_BITS) - 1)).alias("t"), span.alias("span"))


def copied_windows(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """(d, t, span): stretches of ``n`` windows from ``start`` that stand earlier at the source, in any order."""
    if window < GRAM:
        raise ValueError(f"window must be {GRAM} words or more")
    texts = _named(docs, text)
    phrases = stored(texts.mapInArrow(lambda batches: _scan(batches, window), "d long, at long, n int, h long, c long"))
    # stored, so that the join does not run in the partitions of the count and Spark can split a hot anchor
    anchors = stored(phrases.groupBy("h").count().filter("count > 1").select("h"))
    met = stored(phrases.join(anchors, "h", "left_semi"))
    discard(phrases)

    # the index: each different phrase once, at its first place
    grouped = met.groupBy("h", "c").agg(F.min(_place("d", "at")).alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("times"))
    index = stored(grouped)
    whole = _copies(met, index.filter("times > 1"), ["h", "c"], F.col("n"))

    # boundaries: phrases that only agree in part with others of their block, window by window
    partly = stored(index.groupBy("h").count().filter("count > 1").select("h"))
    bounds = index.join(partly, "h", "left_semi").select("first.d", "first.at", "h", "n")
    low = F.col("at").bitwiseAND(F.lit((1 << _TEXT_BITS) - 1))
    bounds = bounds.select("d", low.alias("t"), F.struct(_start(F.col("at")).alias("start"), "n", "h").alias("phrase"))
    wanted = stored(bounds.groupBy("d", "t").agg(F.collect_list("phrase").alias("open")))
    # texts stay where they are as long as what is wanted of them is measured to be small
    wanted = texts.join(broadcast_if_small({"wanted": wanted})["wanted"], ["d", "t"])
    windows = stored(wanted.mapInArrow(lambda batches: _windows(batches, window), "d long, at long, h long, w long"))
    seen = windows.groupBy("h", "w").agg(F.min(_place("d", "at")).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    return whole.unionByName(_copies(windows, stored(seen), ["h", "w"], F.lit(1)))


def factors_of(spans: list[dict], window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """(start, words, source_doc, source_start) of the greedy parse: a factor ends where its source does not run on."""
    out: list[list[int]] = []
    for start, n, doc, source in sorted((s["start"], s["n"], s["source_doc"], s["source_start"]) for s in spans):
        if out:
            begun, so_far, last_doc, last_source = out[-1]
            if doc == last_doc and start <= begun + so_far and start - begun == source - last_source:
                out[-1][1] = max(so_far, start + n - begun)
                continue
        out.append([start, n, doc, source])
    return [(start, n + window - 1, doc, source) for start, n, doc, source in out]


_PARSED = "n_words long, n_removed long, kept string, kept_sha256 string, factors array<struct<start:long,n_words:long,source_doc:long,source_start:long>>"


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "n_words", "source_doc", "source_start")]))
    for batch in batches:
        sizes, removed, texts, shas, factors = [], [], [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
            words = text.as_py()
            words = words.encode("utf-8", "surrogatepass").split() if words else []
            parse = factors_of(spans, window) if spans else []
            kept, end = [], 0
            for start, n, _, _ in parse:
                if start > end:
                    kept += words[end:start]
                end = max(end, start + n)
            kept += words[end:]
            body = b" ".join(kept)
            sizes.append(len(words))
            removed.append(len(words) - len(kept))
            texts.append(body.decode("utf-8", "surrogatepass"))
            shas.append(hashlib.sha256(body).hexdigest())
            factors.append([{"start": s, "n_words": n, "source_doc": None if d == _NO_ID else d, "source_start": p} for s, n, d, p in parse])
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string()), pa.array(shas, pa.string()), pa.array(factors, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256", "factors"])


def parsed(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256, factors) of each row of ``docs``.

    ``factors`` is the parse: from ``start``, ``n_words`` words are copied from ``source_start`` of
    ``source_doc``, which is earlier.  ``kept`` holds the words that no factor covers, joined by one
    space.
    """
    spans = copied_windows(docs, window, text).groupBy(F.col("d").alias("_d"), F.col("t").alias("_t")).agg(F.collect_list("span").alias("spans"))
    texts = _named(docs, text).withColumn("doc_id", F.nullif("d", F.lit(_NO_ID)))
    joined = texts.join(spans.hint("shuffle_hash"), (F.col("d") == F.col("_d")) & (F.col("t") == F.col("_t")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(lambda batches: _cut(batches, window), f"doc_id long, {_PARSED}")


def query(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document, from the parse of all of them."""
    return parsed(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = r"""
with words as (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents
), windows as (
    select doc_id, s, array_to_string(w[s:s + 19], ' ') as k
    from (select doc_id, w, unnest(range(1, len(w) - 18)) as s from words where len(w) >= 20)
), later as (
    select doc_id, s from (select doc_id, s, rank() over (partition by k order by doc_id, s) as r from windows) where r > 1
), covered as (
    select distinct doc_id, s + i as pos from later, (select unnest(range(0, 20)) as i)
), marked as (
    select x.doc_id, x.pos, x.word, c.pos is not null as gone
    from (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from words) x
    left join covered c on c.doc_id = x.doc_id and c.pos = x.pos
), kept as (
    select doc_id, count(*) as n_words, cast(sum(case when gone then 1 else 0 end) as bigint) as n_removed,
           coalesce(string_agg(case when gone then null else word end, ' ' order by pos), '') as body
    from marked group by doc_id
)
select d.doc_id, coalesce(k.n_words, 0) as n_words, coalesce(k.n_removed, 0) as n_removed, sha256(coalesce(k.body, '')) as kept_sha256
from documents d left join kept k on k.doc_id = d.doc_id
"""
