"""Exact set-similarity join of organisation names against a registry.

Let two token sets of n and m tokens have a Jaccard similarity of at least t.  Then they share
at least ``o = ceil(t / (1 + t) * (n + m))`` tokens.  Whatever total order tokens are put in, the
first j of the shared ones lie within the first ``n - o + j`` tokens of the one set and the first
``m - o + j`` of the other.  So names are joined on combinations of j tokens from those prefixes:
every pair above t meets, and it meets on the combination of its first j shared tokens.

Joining on combinations, with rare tokens ordered first, keeps names apart that only have common
words in common; no token, name or candidate is ever dropped.  Short names (up to ``SHORT``
tokens) use the exact overlap of each pair of sizes and up to three tokens, longer ones two
tokens and the bound ``o >= ceil(t * n)``, which needs no sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.titles import name_key

FREQUENT_TOKENS = 200
SHORT = 8
MAX_COMBINED = 3
MIN_SCORE = 0.75
# slack for products like 20 * 0.55, which floating point puts just above 11
SLACK = 1e-9


def token_set(title: Column) -> Column:
    """Distinct lower-case words of a name, sorted; null when there are none."""
    return F.array_sort(F.array_distinct(F.split(name_key(title), " ")))


def frequent_tokens(sets: DataFrame, limit: int = FREQUENT_TOKENS) -> list[str]:
    """The most frequent tokens, most frequent last; the list has a fixed maximum length."""
    counts = sets.select(F.explode("tokens").alias("token")).groupBy("token").count()
    top = counts.orderBy(F.desc("count"), "token").limit(limit).collect()
    return [row["token"] for row in reversed(top)]


def _rare_first(tokens: Column, frequent: list[str]) -> Column:
    """The tokens in one order for all sets: those not frequent, long before short, then the rest."""
    known = F.array(*[F.lit(t) for t in frequent]).cast("array<string>")

    def ranked(token: Column) -> Column:
        return F.struct(
            F.array_position(known, token).alias("rank"),
            (-F.length(token)).alias("shortness"),
            token.alias("token"),
        )

    return F.transform(F.array_sort(F.transform(tokens, ranked)), lambda r: r["token"])


def _combinations(tokens: Column, size: int) -> Column:
    """All combinations of ``size`` tokens, each as one text, tokens in their order."""
    if size == 1:
        return tokens

    def tail(at: Column) -> Column:
        return F.slice(tokens, at + 2, F.size(tokens))

    if size == 2:
        return F.flatten(F.transform(tokens, lambda a, i: F.transform(tail(i), lambda b: F.concat_ws(" ", a, b))))
    return F.flatten(
        F.flatten(
            F.transform(
                tokens,
                lambda a, i: F.transform(
                    tail(i), lambda b, k: F.transform(tail(i + k + 1), lambda c: F.concat_ws(" ", a, b, c))
                ),
            )
        )
    )


def _up(value: Column) -> Column:
    return F.ceil(value - SLACK).cast("int")


def _down(value: Column) -> Column:
    return F.floor(value + SLACK).cast("int")


def _join_keys(sets: DataFrame, frequent: list[str], t: float, left: bool) -> DataFrame:
    """One row ``(id, n, scheme, combination)`` per join key of a set ``(id, tokens)``.

    The combination is a hash, so a key takes the same few bytes however long the name is.
    """
    sets = sets.withColumn("ordered", _rare_first(F.col("tokens"), frequent)).drop("tokens")
    sets = sets.withColumn("n", F.size("ordered"))
    n, m, j = F.col("n"), F.col("m"), F.col("j")
    largest = _down(n / t)

    sizes = F.sequence(F.greatest(_up(n * t), F.lit(1)), F.least(largest, F.lit(SHORT)))
    short = sets.filter(n <= SHORT).withColumn("m", F.explode(sizes))
    overlap = _up((n + m) * (t / (1 + t)))
    short = short.withColumn("j", F.least(overlap, F.lit(MAX_COMBINED)))
    short = short.withColumn("prefix", F.slice("ordered", F.lit(1), n - overlap + j))
    by_size = F.when(j == 1, _combinations(F.col("prefix"), 1)).when(j == 2, _combinations(F.col("prefix"), 2))
    pair = (n, m) if left else (m, n)
    short = short.withColumn("combination", F.explode(by_size.otherwise(_combinations(F.col("prefix"), 3))))
    short = short.withColumn("scheme", F.concat_ws("-", *pair)).drop("m")

    long = sets.filter((n > SHORT) | (largest > SHORT)).withColumn("j", F.lit(2))
    long = long.withColumn("prefix", F.slice("ordered", F.lit(1), n - _up(n * t) + 2))
    long = long.withColumn("combination", F.explode(_combinations(F.col("prefix"), 2)))
    long = long.withColumn("scheme", F.lit("long"))
    keys = short.unionByName(long)
    return keys.select("id", "n", "scheme", F.xxhash64("combination").alias("combination"))


def similar_names(left: DataFrame, right: DataFrame, min_score: float, frequent: list[str]) -> DataFrame:
    """Pairs ``(set_key, ror_id, name, score)`` with a Jaccard score of at least ``min_score``.

    ``left(set_key, tokens)`` has one row per distinct token set, ``right(ror_id, name, tokens)``
    one per registry name.  Pairs that meet on several combinations are reduced to one; then the
    token lists come back and the score is checked.
    """
    if not 0.2 <= min_score <= 1:
        raise ValueError("min_score must lie between 0.2 and 1")
    # ids are hashes; two sets with the same id would both be looked at below
    left = left.withColumn("id", F.xxhash64("set_key"))
    right = right.withColumn("id", F.xxhash64("ror_id", "name", "tokens"))
    a = _join_keys(left.select("id", "tokens"), frequent, min_score, left=True).alias("a")
    b = _join_keys(right.select("id", "tokens"), frequent, min_score, left=False).alias("b")
    meet = (
        (F.col("a.scheme") == F.col("b.scheme"))
        & (F.col("a.combination") == F.col("b.combination"))
        & ((F.col("a.scheme") != "long") | (F.greatest("a.n", "b.n") > SHORT))
    )
    pairs = a.join(b, meet).select(F.col("a.id").alias("_left"), F.col("b.id").alias("_right")).distinct()
    ours = left.select(F.col("id").alias("_left"), "set_key", F.col("tokens").alias("_ours"))
    theirs = right.select(F.col("id").alias("_right"), "ror_id", "name", F.col("tokens").alias("_theirs"))
    shared = F.size(F.array_intersect("_ours", "_theirs"))
    score = shared / (F.size("_ours") + F.size("_theirs") - shared)
    scored = pairs.join(ours, "_left").join(theirs, "_right").select("set_key", "ror_id", "name", score.alias("score"))
    return scored.filter(F.col("score") >= min_score)


def best_matches(pairs: DataFrame, top: int) -> DataFrame:
    """The ``top`` best registry entries per name, an entry counted with its best alias."""
    per_entry = pairs.groupBy("set_key", "ror_id", "name").agg(F.max("score").alias("score"))
    best = Window.partitionBy("set_key").orderBy(F.desc("score"), "name", "ror_id")
    return per_entry.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
