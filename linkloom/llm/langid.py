"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a hash of its code point.  A three-letter
gram is the product of its letters' vectors, the first rotated by two places, the second by one
(binding); a document is the sum of its grams (bundling); a language is the sum of its documents,
each scaled to unit length.  A document gets the language whose prototype has the largest cosine.

Bundling is linear, so training only counts grams: tasks add up the weights of each language's
grams in whole numbers, and vectors appear once the counts are summed.  The model is one vector a
language, the only thing that passes the driver; ``max_languages`` bounds it.

A text is in no known language if its best cosine is no more than ``bounds`` tells:

* vectors of unlike texts have a cosine of about 1/sqrt(dim) by chance; ``CHANCE`` times that passes
  once in tens of thousands of texts, whatever their length;
* a text of n grams drawn like the language's has a cosine of about sqrt(n a / (1 + (n - 1) a)), a
  being the chance that two of its grams are equal; n is what the text's gram counts are worth,
  sum^2 / sum of squares.  Known texts lie about that, random letters far below; the bound is
  ``SHARE`` of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import col, table

UNDETERMINED = "und"
_BITS = 21  # of a code point
_UNIT = 1 << 20  # a document's weight, so that sums are whole numbers and reruns agree
_GRAMS_AT_ONCE = 1 << 18
_ROWS_AT_ONCE = 4096  # at 1,024 places; fewer where vectors are longer
_PLACES_AT_ONCE = 1 << 20
#: A cosine up to so many deviations of a chance one tells nothing.
CHANCE = 4.0
#: The part of a known text's usual cosine that a text must exceed.
SHARE = 1 / 3
#: Places of the vectors that tell unknown texts: chance cosines are half those of 1,024 places.
REJECT_DIM = 4096

_fold: np.ndarray | None = None


def _fold_table() -> np.ndarray:
    """For each code point its lower-case letter, 0 where it is no letter."""
    global _fold
    if _fold is None:
        out = np.zeros(0x110000, dtype=np.uint32)
        for point in range(0x110000):
            c = chr(point)
            if c.isalpha():
                low = c.lower()
                out[point] = ord(low) if len(low) == 1 else point
        _fold = out
    return _fold


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct three-letter grams of a whole text and their counts.

    What is no letter counts as one space, also before the first and after the last word.
    """
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = np.zeros(len(points) + 2, dtype=np.uint64)
    letters[1:-1] = _fold_table()[points]
    keep = letters != 0
    if not keep.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keep[1:] |= letters[:-1] != 0  # the first space of a run
    keep[0] = keep[1]
    letters = letters[keep]
    if letters[-1] != 0:
        letters = np.append(letters, np.uint64(0))
    two, one = np.uint64(2 * _BITS), np.uint64(_BITS)
    return np.unique((letters[:-2] << two) | (letters[1:-1] << one) | letters[2:], return_counts=True)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letter_vectors(points: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """One row of +1 and -1 a code point; ``dim`` is a multiple of 64."""
    with np.errstate(over="ignore"):
        base = _mix(points.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
        words = _mix(base[:, None] + np.arange(1, dim // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    bits = np.unpackbits(words.view(np.uint8).reshape(len(points), dim // 8), axis=1)
    return (bits.astype(np.int8) * 2) - 1


def gram_vectors(keys: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """Bound vectors of grams, one row each."""
    mask, out = np.uint64((1 << _BITS) - 1), None
    for place in (2, 1, 0):  # letters from the first to the last
        points, which = np.unique((keys >> np.uint64(place * _BITS)) & mask, return_inverse=True)
        vectors = np.roll(letter_vectors(points, dim, seed), place, axis=1)[which]
        out = vectors if out is None else np.multiply(out, vectors, out=out)
    return out


@dataclass(frozen=True)
class Profiles:
    """Prototypes of unit length, a row a language in the order of the names.

    ``repeats`` is the chance of two grams of a language being equal.
    """

    dim: int
    seed: int
    languages: list[str]
    prototypes: np.ndarray = field(repr=False)
    repeats: np.ndarray = field(repr=False)


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sum the grams' weights by language; emits when many have gathered, and at the end."""
    gathered: dict[str, list] = {}
    size = 0

    def flush() -> Iterator[pd.DataFrame]:
        for lang, parts in gathered.items():
            keys, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            total = np.zeros(len(keys), dtype=np.int64)
            np.add.at(total, which, np.concatenate([w for _, w in parts]))
            yield pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "weight": total})

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            keys, counts = grams(text)
            if len(keys):
                scale = _UNIT / np.sqrt(float((counts.astype(np.float64) ** 2).sum()))
                gathered.setdefault(lang, []).append((keys, np.rint(counts * scale).astype(np.int64)))
                size += len(keys)
        if size > 1 << 20:
            yield from flush()
            gathered, size = {}, 0
    yield from flush()


def train(
    docs: DataFrame,
    dim: int = 1024,
    seed: int = 7,
    max_languages: int = 4096,
    text: str = "text",
    lang: str = "lang",
) -> Profiles:
    """Prototypes of all languages named in ``docs``.

    Rows whose language is null, or whose text is null or has no letter, teach nothing; any other
    language value is a language, the empty one too.  More than ``max_languages`` of them is an
    error, never a cut.  Repeated rows count as often as they occur.
    """
    if dim % 64:
        raise ValueError("dim must be a multiple of 64")
    rows = docs.select(col(lang).alias("lang"), col(text).alias("text")).filter("lang is not null and text is not null")
    counted = rows.mapInPandas(_count_grams, "lang string, gram long, weight long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("weight").alias("weight"))

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        rows = _rows_at_once(dim)
        for batch in batches:
            for name, part in batch.groupby("lang"):
                keys = part["gram"].to_numpy().view(np.uint64)
                weights = part["weight"].to_numpy()
                total = sums.setdefault(name, np.zeros(dim + 1, dtype=np.int64))
                for at in range(0, len(keys), rows):
                    vectors = gram_vectors(keys[at : at + rows], dim, seed)
                    total[:dim] += weights[at : at + rows] @ vectors.astype(np.int64)
                total[dim] += weights.sum()
        for name, total in sums.items():
            yield pd.DataFrame({"lang": name, "place": np.arange(dim + 1), "value": total})

    placed = counted.mapInPandas(bundle, "lang string, place int, value long")
    summed = placed.groupBy("lang", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("double").alias("value"))
    rows = summed.limit(max_languages * (dim + 1) + 1).collect()
    if len(rows) > max_languages * (dim + 1):
        raise ValueError(f"more than {max_languages} languages")
    languages = sorted({r["lang"] for r in rows})
    at = {name: k for k, name in enumerate(languages)}
    prototypes = np.zeros((len(languages), dim + 1))
    for r in rows:
        prototypes[at[r["lang"]], r["place"]] = r["value"]
    prototypes, weights = prototypes[:, :dim], prototypes[:, dim]
    norms = np.linalg.norm(prototypes, axis=1, keepdims=True)
    repeats = np.minimum(1.0, (norms[:, 0] / weights) ** 2 / dim)
    return Profiles(dim, seed, languages, prototypes / np.where(norms == 0, 1, norms), repeats)


def _rows_at_once(dim: int) -> int:
    return max(1, _ROWS_AT_ONCE * 1024 // max(1024, dim))


def classify(texts: list[str | None], model: Profiles) -> tuple[list[str], np.ndarray]:
    """Language and cosine (0 to 1) of each whole text."""
    return _classify(texts, model)[:2]


def _classify(texts: list[str | None], model: Profiles) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, cosine and worth in grams of each whole text."""
    names, scores, worth = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    if not model.languages:
        return names, scores, worth
    group: list[tuple[int, np.ndarray, np.ndarray]] = []
    size = 0
    for k, text in enumerate(texts):
        keys, counts = grams(text)
        if len(keys):
            group.append((k, keys, counts))
            size += len(keys)
            exact = counts.astype(np.float64)
            worth[k] = exact.sum() ** 2 / (exact**2).sum()
        if size > _GRAMS_AT_ONCE or len(group) * model.dim >= _PLACES_AT_ONCE:
            _score(group, model, names, scores)
            group, size = [], 0
    if group:
        _score(group, model, names, scores)
    return names, scores, worth


def bounds(names: list[str], worth: np.ndarray, model: Profiles) -> np.ndarray:
    """The cosine that a text of a language must exceed to be known, see above; ``und`` has 1."""
    at = {name: k for k, name in enumerate(model.languages)}
    a = np.array([model.repeats[at[x]] if x in at else 1.0 for x in names])
    usual = np.sqrt(worth * a / (1 + (np.maximum(worth, 1) - 1) * a))
    return np.where(worth > 0, np.maximum(CHANCE / np.sqrt(model.dim), SHARE * usual), 1.0)


def _score(group: list, model: Profiles, names: list[str], scores: np.ndarray) -> None:
    keys, which = np.unique(np.concatenate([g[1] for g in group]), return_inverse=True)
    row = np.repeat(np.arange(len(group)), [len(g[1]) for g in group])
    count = np.concatenate([g[2] for g in group]).astype(np.float32)
    order = np.argsort(which, kind="stable")
    which, row, count = which[order], row[order], count[order]
    bundled = np.zeros((len(group), model.dim), dtype=np.float32)
    rows = _rows_at_once(model.dim)
    for at in range(0, len(keys), rows):
        lo, hi = np.searchsorted(which, [at, at + rows])
        block = keys[at : at + rows]
        table_ = np.zeros((len(group), len(block)), dtype=np.float32)
        table_[row[lo:hi], which[lo:hi] - at] = count[lo:hi]
        bundled += table_ @ gram_vectors(block, model.dim, model.seed).astype(np.float32)
    exact = bundled.astype(np.float64)
    norms = np.linalg.norm(exact, axis=1, keepdims=True)
    cosines = (exact / np.where(norms == 0, 1, norms)) @ model.prototypes.T
    best = cosines.argmax(axis=1)  # the first of equals: the smaller name
    for i, (k, _, _) in enumerate(group):
        names[k] = model.languages[best[i]]
        scores[k] = min(1.0, max(0.0, cosines[i, best[i]]))


def predict(text: Column, model: Profiles, context) -> Column:
    """struct(lang, score) of a text column; null or letterless text is ``und`` with score 0."""
    sent = context.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def tell(batch: pd.Series) -> pd.DataFrame:
        names, scores = classify(batch.tolist(), sent.value)
        return pd.DataFrame({"lang": names, "score": scores})

    return tell(text)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, model: Profiles) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of ``docs``, nothing shuffled.

    Null or letterless text: ``und`` with score 0, as is everything when no language was learned.
    Equal cosines: the smaller name.  A null doc_id is not held out.
    """
    found = docs.select(
        F.col("doc_id"),
        is_held_out(F.col("doc_id")).alias("held_out"),
        predict(F.col("text"), model, docs.sparkSession.sparkContext).alias("found"),
    )
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def reject_unknown(docs: DataFrame, model: Profiles | None = None, min_score: float | None = None) -> DataFrame:
    """The rows of ``docs`` written in some learned language, all columns kept.

    Rejected is what has no letter, or whose cosine with every language is at most ``min_score``;
    without one, at most what ``bounds`` says for the text.  Words too short and odd to be told from
    chance are rejected too.  Where no language could be learned, all that has letters stays.
    """
    model = model or train(docs.filter(~is_held_out(F.col("doc_id"))), dim=REJECT_DIM)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(batch: pd.Series) -> pd.Series:
        names, scores, worth = _classify(batch.tolist(), sent.value)
        least = bounds(names, worth, sent.value) if min_score is None else min_score
        return pd.Series((scores > least) & (worth > 0))

    return docs.filter(known(F.col("text")))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs.filter(~is_held_out(F.col("doc_id")))))
