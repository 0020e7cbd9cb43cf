"""Exact top-k set-similarity join: the best registry entries of each name, whatever they score.

Names are token sets, scores Jaccard similarities.  A name of n tokens and one of m that share o of
them score o / (n + m - o), so among the registry names that hold some tokens of a name, the small
ones score best unless they share still more.  That gives three steps:

1. *Posting prefixes.*  For each token and each pair of tokens, the registry names that hold them
   are put in order of size, and the first ``top`` entries are kept, however long the posting is.  An entry
   that shares exactly one or two tokens with a name and does not stand among those has ``top``
   others before it that score as much or more, so it is not missed.
2. *Bound.*  The k-th best score among those entries is a lower bound for each name's result.
3. *The rest.*  A better match shares three tokens or more and at least as many as the name's own
   bound demands, so its first shared tokens, rare ones first, lie in short prefixes of both sets;
   the sets are joined on combinations of three tokens from them (two for long names).  How long a
   name's prefix is follows from its bound.  Registry names list their combinations for each
   overlap, since they do not know the bounds.

Frequent tokens thus cost ``top`` rows a name in the first step, and in the third they only count
in combinations that the bound leaves open.  Nothing is cut off by a score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.similarity import SHORT, SLACK, _rare_first, best_matches
from linkloom.session import stored

#: Overlaps of the third step start here; those below are found by posting prefixes.
LEAST = 3
#: Overlaps by which long names are joined: each counts as the largest of these below it.
_STEPS = [3, 4, 6, 8, 11, 16, 22, 32, 45, 64, 90, 128, 181, 256, 362, 512, 724, 1024]


def _hashed(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _tail(tokens: Column, after: Column) -> Column:
    return F.slice(tokens, after + 2, F.size(tokens))


def _pairs(tokens: Column) -> Column:
    return F.flatten(F.transform(tokens, lambda a, i: F.transform(_tail(tokens, i), lambda b: F.xxhash64(a, b))))


def _triples(tokens: Column) -> Column:
    def from_(a: Column, i: Column) -> Column:
        return F.flatten(F.transform(_tail(tokens, i), lambda b, k: F.transform(_tail(tokens, i + k + 1), lambda c: F.xxhash64(a, b, c))))

    return F.flatten(F.transform(tokens, from_))


def _up(value: Column) -> Column:
    return F.ceil(value - SLACK).cast("int")


def _scored(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(_left, set_key, ror_id, name, score) of pairs (_left, _right)."""
    ours = left.select(F.col("id").alias("_left"), "set_key", F.col("tokens").alias("_ours"))
    theirs = right.select(F.col("id").alias("_right"), "ror_id", "name", F.col("tokens").alias("_theirs"))
    shared = F.size(F.array_intersect("_ours", "_theirs"))
    score = shared / (F.size("_ours") + F.size("_theirs") - shared)
    joined = pairs.join(ours, "_left").join(theirs, "_right")
    return joined.select("_left", "set_key", "ror_id", "name", score.alias("score")).filter("score > 0")


def posting_prefixes(left: DataFrame, right: DataFrame, top: int) -> DataFrame:
    """(_left, _right): for each token and pair of tokens of a name the ``top`` smallest entries that hold it."""

    def keys(tokens: Column) -> Column:
        hashed = _hashed(tokens)
        return F.explode(F.concat(hashed, _pairs(hashed)))

    wanted = left.select(F.col("id").alias("_left"), keys(F.col("tokens")).alias("key"))
    held = right.select("id", "ror_id", "name", F.size("tokens").alias("m"), keys(F.col("tokens")).alias("key"))
    held = held.join(wanted.select("key").distinct(), "key", "left_semi")
    entries = held.groupBy("key", "ror_id", "name").agg(F.min(F.struct("m", "id")).alias("least"))
    in_order = Window.partitionBy("key").orderBy("least.m", "name", "ror_id")
    first = entries.withColumn("place", F.row_number().over(in_order)).filter(F.col("place") <= top)
    # stored, so that the join has shuffles of its own and Spark can split a token that many names hold
    first = stored(first.select("key", F.col("least.id").alias("_right")))
    return wanted.join(first, "key").select("_left", "_right").distinct()


def _left_keys(left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Join keys of names (id, ordered, n, bound): by exact sizes among short names, by overlap else."""
    n, m, bound = F.col("n"), F.col("m"), F.col("bound")
    largest = F.when(bound > 0, F.floor(n / bound + SLACK)).otherwise(F.lit(1 << 30)).cast("int")
    left = left.filter(n >= LEAST).withColumn("largest", largest)

    sizes = F.sequence(F.lit(LEAST), F.lit(SHORT))
    short = left.filter(n <= SHORT).withColumn("m", F.explode(sizes)).filter((m <= F.col("largest")) & (m >= _up(n * bound)))
    overlap = F.greatest(_up((n + m) * (bound / (1 + bound))), F.lit(LEAST))
    short = short.withColumn("o", overlap).filter(F.col("o") <= F.least(n, m))
    key = F.explode(_triples(F.slice("ordered", F.lit(1), n - F.col("o") + LEAST)))
    short = short.select(F.col("id").alias("_left"), "m", "o", key.alias("key"))

    long = left.filter((n > SHORT) | (F.col("largest") > SHORT))
    least = F.greatest(_up(n * bound), F.lit(LEAST))
    steps = F.array(*[F.lit(s) for s in _STEPS])
    long = long.withColumn("o", F.array_max(F.filter(steps, lambda s: s <= least)))
    key = F.explode(_pairs(F.slice("ordered", F.lit(1), n - F.col("o") + 2)))
    return short, long.select(F.col("id").alias("_left"), "n", "o", key.alias("key"))


def _right_keys(right: DataFrame) -> tuple[DataFrame, DataFrame]:
    m, o = F.col("m"), F.col("o")
    right = right.withColumnRenamed("n", "m").filter(m >= LEAST)
    short = right.filter(m <= SHORT).withColumn("o", F.explode(F.sequence(F.lit(LEAST), m)))
    key = F.explode(_triples(F.slice("ordered", F.lit(1), m - o + LEAST)))
    short = short.select(F.col("id").alias("_right"), "m", "o", key.alias("key"))
    steps = F.array(*[F.lit(s) for s in _STEPS])
    long = right.withColumn("o", F.explode(F.filter(steps, lambda s: s <= m)))
    key = F.explode(_pairs(F.slice("ordered", F.lit(1), m - o + 2)))
    return short, long.select(F.col("id").alias("_right"), "m", "o", key.alias("key"))


def top_matches(left: DataFrame, right: DataFrame, top: int, frequent: list[str], min_score: float = 0.0) -> DataFrame:
    """The ``top`` best entries ``(set_key, ror_id, name, score, rank)`` of each name that shares a token with any.

    ``left(set_key, tokens)`` has one row per distinct token set, ``right(ror_id, name, tokens)`` one
    per registry name; an entry counts with its best one.  Ties go by name, then id.  ``min_score``
    leaves out what scores less.
    """
    left = stored(left.withColumn("id", F.xxhash64("set_key")))
    right = stored(right.withColumn("id", F.xxhash64("ror_id", "name", "tokens")))
    begun = stored(_scored(posting_prefixes(left, right, top), left, right))
    kth = best_matches(begun, top).filter(F.col("rank") == top).select("set_key", F.col("score").alias("kth"))

    def ordered(sets: DataFrame) -> DataFrame:
        return sets.withColumn("ordered", _hashed(_rare_first(F.col("tokens"), frequent))).withColumn("n", F.size("tokens"))

    bound = F.greatest(F.coalesce("kth", F.lit(0.0)), F.lit(float(min_score)))
    bounded = ordered(left).join(kth, "set_key", "left").select("id", "ordered", "n", bound.alias("bound"))
    mine, theirs = _left_keys(bounded), _right_keys(ordered(right).select("id", "ordered", "n"))
    short = mine[0].join(theirs[0], ["m", "o", "key"]).select("_left", "_right")
    long = mine[1].join(theirs[1], ["o", "key"]).filter(F.greatest("n", "m") > SHORT).select("_left", "_right")
    rest = _scored(short.unionByName(long).distinct(), left, right)
    found = begun.unionByName(rest).filter(F.col("score") >= min_score)
    return best_matches(found.select("set_key", "ror_id", "name", "score"), top)
