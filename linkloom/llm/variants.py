"""Spelling variants: words one edit apart, by a bit-sliced position index.

An index of up to ``BLOCK`` words holds one bitset over them for each (position, letter).  A query
word is read letter by letter; four bitsets follow it for all words of the index at once:

* ``same``: words that agree so far;
* ``other``: words with one letter replaced so far, compared at the same position;
* ``longer``: words with one more letter so far, compared one position further on;
* ``shorter``: words with one letter less so far, compared one position further back.

Each letter costs a few word-parallel operations, whatever the words are.  At the end, bitsets of the
word lengths leave those that end with the query.

Which words share an index: two words one edit apart, the shorter of n letters, agree in their
first or in their last n // 2 letters.  So words of n and n + 1 letters with one beginning, or one
end, form a *cell*.  Cells with one word go; small cells are put into an index together, and a cell
of more than ``BLOCK`` words is cut into parts, each pair of parts being separate work.  No near
word is missed, no cell is capped, and none is held whole by one task.

Words are counted in the tasks that read the texts and combined before the shuffle.  Forms
(``form``) lead from a word to a near word that is at least ``factor`` times as frequent, so a chain
of them has no circle and at most log2 of the largest count steps; the end is found by doubling.

Null and empty texts have no words.  A null doc_id is written as nothing in the number that
decides which letters are lost.  The same row twice counts twice.  Very long texts and words are
read whole.  An empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import col, table
from linkloom.session import discard, stored

LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_POINTS = 5
LEAST_COUNT = 3
FACTOR = 2
#: One word in so many loses a letter in the registered query.
SLIP = 97
BLOCK = 2048
#: 64-bit cells of an index, at most, unless one word alone needs more: 16 MB.
_CELLS = 1 << 21
_QUERIES = 512
#: Words a task counts before it passes the counts on.
_COUNTED = 400_000


# -- words and their counts ---------------------------------------------------------------------------


def slipped(doc_id: int | None, word: str, slip: int | None) -> str:
    """The word, or for one (document, word) in ``slip`` the word without one letter."""
    if slip is None:
        return word
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode("utf-8", "surrogatepass"))
    if h % slip:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def counted(docs: DataFrame, least_points: int = LEAST_POINTS, least_count: int = LEAST_COUNT, slip: int | None = None, text: str = "text") -> DataFrame:
    """(word, n): words of ``least_points`` or more, with A-Z lowered, that occur ``least_count`` times or more."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = re.compile(LETTERS), Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                body = body.as_py()
                if not body:
                    continue
                lowered = body.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                for word, n in Counter(found.findall(lowered)).items():
                    word = slipped(doc_id, word, slip)
                    if len(word) >= least_points:
                        held[word] += n
            if len(held) > _COUNTED:
                yield rows()
                held.clear()
        if held:
            yield rows()

    rows = docs.select(col("doc_id").cast("long").alias("doc_id"), col(text).alias("text"))
    counts = rows.mapInArrow(words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least_count)


# -- the index ----------------------------------------------------------------------------------------


class PositionIndex:
    """Bitsets over words: for each (position, letter) the words that have it there."""

    def __init__(self, words: list[str]):
        self.words = words
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.alphabet, letters = np.unique(points, return_inverse=True)
        self.width = (len(words) + 63) // 64
        whose = np.repeat(np.arange(len(words)), self.lengths)
        where = np.arange(len(points)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        most = int(self.lengths.max(initial=0))
        # one place before the first and two after the last stay empty
        self.sets = np.zeros((most + 3, len(self.alphabet) + 1, self.width), np.uint64)
        np.bitwise_or.at(self.sets, (where + 1, letters, whose >> 6), np.uint64(1) << (whose & 63).astype(np.uint64))
        self.codes = np.full((len(words), most), len(self.alphabet), np.int64)
        self.codes[whose, where] = letters
        self.of_length = np.zeros((most + 3, self.width), np.uint64)
        ids = np.arange(len(words))
        np.bitwise_or.at(self.of_length, (self.lengths + 1, ids >> 6), np.uint64(1) << (ids & 63).astype(np.uint64))

    @staticmethod
    def cells(words: int, longest: int, letters: int) -> int:
        return (longest + 3) * (letters + 1) * ((words + 63) // 64)

    def near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word) places of all pairs one edit apart, both ways round, a few queries at a time."""
        for length in np.unique(self.lengths).tolist():
            queries = np.flatnonzero(self.lengths == length)
            for at in range(0, len(queries), _QUERIES):
                some = queries[at : at + _QUERIES]
                hits = self._read(some, length)
                row, word = np.nonzero(hits)
                bits = np.unpackbits(hits[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                hit, bit = np.nonzero(bits)
                yield some[row[hit]], word[hit] * 64 + bit

    def _read(self, queries: np.ndarray, length: int) -> np.ndarray:
        shape = (len(queries), self.width)
        same = np.full(shape, ~np.uint64(0))
        other, longer, shorter = (np.zeros(shape, np.uint64) for _ in range(3))
        for i in range(length):
            letter = self.codes[queries, i]
            back, here, ahead = (self.sets[i + shift][letter] for shift in (0, 1, 2))
            other = (other & here) | (same & ~here)
            longer = (longer | same) & ahead
            shorter = (shorter & back) | same
            same &= here
        longer |= same
        less, equal, more = (self.of_length[length + shift] for shift in (0, 1, 2))
        return (other & equal) | (longer & more) | (shorter & less)


def _best(group: np.ndarray, own: np.ndarray, across: np.ndarray, start: np.ndarray, from_end: np.ndarray, longer: np.ndarray, counts: np.ndarray, words: list[str]) -> Iterator[tuple[int, int, int, int]]:
    """(query, near words, largest count, its word) of an index that holds whole groups of one (cell, pair of parts)."""
    index = PositionIndex(words)
    order = np.empty(len(words), np.int64)
    order[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    pairs = []
    for q, v in index.near():
        good = (group[q] == group[v]) & ~(longer[q] & longer[v]) & (~across[q] | (own[q] != own[v]))
        good &= ~from_end[q] | (start[q] != start[v])  # a pair that agrees at both ends counts at the beginning
        pairs.append((q[good], v[good]))
    if not pairs:
        return
    q, v = (np.concatenate(x) for x in zip(*pairs))
    by = np.lexsort((order[v], -counts[v], q))
    q, v = q[by], v[by]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, int)
    yield from zip(q[first].tolist(), np.diff(np.r_[first, len(q)]).tolist(), counts[v[first]].tolist(), v[first].tolist())


_ROW = ["cell", "p", "q", "own", "from_end", "longer", "start", "word", "n"]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, best_n, best) of each word in each of its cells, from rows sorted by (cell, p, q)."""

    def indexed(rows: pa.Table) -> pa.RecordBatch:
        words = rows.column("word").to_pylist()
        column = {name: rows.column(name).to_numpy() for name in _ROW if name != "word"}
        marks = np.stack([column[name] for name in ("cell", "p", "q")])
        group = np.r_[0, np.cumsum((marks[:, 1:] != marks[:, :-1]).any(axis=0))]
        found = list(_best(group, column["own"], column["p"] != column["q"], column["start"], column["from_end"], column["longer"], column["n"], words))
        q, near, best_n, best = ([f[i] for f in found] for i in range(4))
        columns = [pa.array([words[i] for i in q], pa.string()), pa.array(near, pa.int64()), pa.array(best_n, pa.int64()), pa.array([words[i] for i in best], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])

    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        marks = np.stack([rows.column(name).to_numpy() for name in ("cell", "p", "q")])
        starts = np.r_[0, np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1].tolist()
        # whole groups go into an index as long as they fit; the last group may go on in the next batch
        lengths = rows.column("word").combine_chunks() if len(rows) else None
        sizes = np.fromiter((len(w) for w in lengths.to_pylist()), np.int64, len(rows))
        begin, longest = 0, 0
        for lo, hi in zip(starts[:-1], starts[1:]):
            grown = max(longest, int(sizes[lo:hi].max()))
            if lo > begin and (hi - begin > BLOCK or PositionIndex.cells(hi - begin, grown, 96) > _CELLS):
                yield indexed(rows.slice(begin, lo - begin))
                begin, grown = lo, int(sizes[lo:hi].max())
            longest = grown
        if starts[-1] > begin:
            yield indexed(rows.slice(begin, starts[-1] - begin))
        rest = rows.slice(starts[-1]).combine_chunks()
    if rest is not None and len(rest):
        yield indexed(rest)


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best) of the words of ``vocabulary`` (word, n) that have a near word.

    ``best`` is the near word of the largest n, the smallest by code points among equals.
    """
    size = F.length("word")

    def cell(n, longer: bool, from_end: bool):
        half = (n / 2).cast("int")
        start = F.substring("word", F.lit(1), half)
        end = F.substring("word", size - half + 1, half)
        key = F.xxhash64(F.lit(from_end), n, end if from_end else start)
        return F.struct(key.alias("cell"), F.lit(from_end).alias("from_end"), F.lit(longer).alias("longer"), F.xxhash64(start).alias("start"))

    cells = F.array(*[cell(size - longer, bool(longer), from_end) for longer in (0, 1) for from_end in (False, True)])
    rows = vocabulary.select("word", "n", F.explode(cells).alias("c")).select("word", "n", "c.*")
    counts = rows.groupBy("cell").count().filter("count > 1").select("cell", F.ceil(F.col("count") / block).cast("int").alias("parts"))
    rows = rows.join(stored(counts), "cell")
    own = F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts")).cast("int")
    rows = rows.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("p", F.least("own", "with")).withColumn("q", F.greatest("own", "with"))
    dealt = rows.repartition("cell", "p", "q").sortWithinPartitions("cell", "p", "q").select(*_ROW)
    found = dealt.mapInArrow(_compare, "word string, n_near long, best_n long, best string")
    least = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least).select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word that has a form, by doubling the steps until no chain goes on."""
    steps = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        on = steps.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        doubled = steps.join(on.hint("merge"), F.col("root") == F.col("_w"), "left")
        doubled = stored(doubled.select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")))
        more = not doubled.filter("moved").isEmpty()
        discard(steps)
        steps = doubled.select("word", "root")
        if not more:
            return steps


def variants(docs: DataFrame, least_points: int = LEAST_POINTS, least_count: int = LEAST_COUNT, factor: float = FACTOR, slip: int | None = None, text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that is frequent enough.

    ``form`` is the near word of the largest n if that is ``factor`` times the word's n or more, else
    null; ``root`` is where the forms lead in the end, the word itself if it has none.
    """
    if factor <= 1:
        raise ValueError("forms lead nowhere unless factor is above 1")
    vocabulary = stored(counted(docs, least_points, least_count, slip, text))
    near = near_words(vocabulary)
    joined = vocabulary.join(near.hint("merge"), "word", "left")
    is_form = F.col("best_n") >= factor * F.col("n")
    found = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    roots = _roots(found.filter("form is not null"))
    out = found.join(roots.hint("merge"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of all documents, one in 97 with a letter lost."""
    return variants(table(spark, sf_dir, "documents"), slip=SLIP)
