"""The similarity join finds exactly the pairs brute force finds."""

import random

import pytest

from linkloom.operators.similarity import frequent_tokens, similar_names
from linkloom.operators.topk_names import posting_prefixes, top_matches
from linkloom.plans.reconcile import candidate_report

WORDS = [f"w{i}" for i in range(30)]


def random_sets(rng, count, longest):
    out = set()
    while len(out) < count:
        # low-numbered words are frequent
        size = rng.randint(1, longest)
        out.add(frozenset(WORDS[min(int(rng.expovariate(0.15)), 29)] for _ in range(size)))
    return [sorted(s) for s in out]


@pytest.mark.parametrize("t", [0.3, 0.5, 0.55, 0.6, 0.7, 0.75, 0.9, 1.0])
@pytest.mark.parametrize("with_frequent", [True, False])
def test_equals_brute_force(spark, t, with_frequent):
    rng = random.Random(int(t * 100))
    left, right = random_sets(rng, 120, 14), random_sets(rng, 120, 14)
    # near copies, so that high thresholds find something
    right += [sorted(set(s) ^ {rng.choice(WORDS)}) or ["w0"] for s in left[:60]]
    right = [list(x) for x in dict.fromkeys(map(tuple, right))]
    a = spark.createDataFrame([(" ".join(s), s) for s in left], "set_key string, tokens array<string>")
    b = spark.createDataFrame(
        [(f"r{i}", " ".join(s), s) for i, s in enumerate(right)], "ror_id string, name string, tokens array<string>"
    )
    frequent = frequent_tokens(a.select("tokens").unionByName(b.select("tokens")), 10) if with_frequent else []
    got = [(r["set_key"], r["ror_id"]) for r in similar_names(a, b, t, frequent).collect()]
    expected = {
        (" ".join(x), f"r{i}")
        for x in left
        for i, y in enumerate(right)
        if len(set(x) & set(y)) / len(set(x) | set(y)) >= t
    }
    assert expected
    assert len(got) == len(set(got))
    assert set(got) == expected


def test_long_names_equal_brute_force_and_keys_stay_small(spark):
    """Names far beyond the length that is joined by exact sizes."""
    from pyspark.sql import functions as F

    from linkloom.operators.similarity import _join_keys

    rng = random.Random(9)
    words = [f"v{i}" for i in range(90)]
    left = [sorted(rng.sample(words, rng.randint(15, 60))) for _ in range(60)]
    right = [sorted(set(s) ^ set(rng.sample(words, rng.randint(0, 12)))) for s in left] + [sorted(rng.sample(words, 5)) for _ in range(40)]
    right = [list(x) for x in dict.fromkeys(map(tuple, right))]
    a = spark.createDataFrame([(" ".join(s), s) for s in left], "set_key string, tokens array<string>")
    b = spark.createDataFrame([(f"r{i}", " ".join(s), s) for i, s in enumerate(right)], "ror_id string, name string, tokens array<string>")
    got = [(r["set_key"], r["ror_id"]) for r in similar_names(a, b, 0.75, []).collect()]
    expected = {
        (" ".join(x), f"r{i}") for x in left for i, y in enumerate(right) if len(set(x) & set(y)) / len(set(x) | set(y)) >= 0.75
    }
    assert expected and len(got) == len(set(got)) and set(got) == expected
    keys = _join_keys(a.select(F.xxhash64("set_key").alias("id"), "tokens"), [], 0.75, left=True)
    assert keys.columns == ["id", "n", "scheme", "combination"]


def test_report_marks_only_single_full_matches(spark):
    orgs = spark.createDataFrame(
        [("1", "Plain Lab"), ("2", "Twin Lab"), ("3", "Nothing Like It"), ("4", None), ("5", "PLAIN, LAB")],
        "id string, title string",
    )
    registry = spark.createDataFrame(
        [("r1", "Plain Lab", []), ("r2", "Twin Lab", []), ("r3", "Lab Twin", []), ("r4", "The Plain Lab Of It", ["x"])],
        "ror_id string, name string, aliases array<string>",
    )
    out = {r["id"]: r for r in candidate_report(orgs, registry).collect()}
    assert len(out) == 5
    assert (out["1"]["Match 1 ID"], out["1"]["Match 1 Chosen"]) == ("r1", True)
    assert (out["5"]["Match 1 ID"], out["5"]["Match 1 Chosen"]) == ("r1", True)
    assert (out["2"]["Match 1 Chosen"], out["2"]["Match 2 Chosen"]) == (False, False)
    assert out["3"]["Match 1 ID"] == "r4" and out["3"]["Match 1 Score"] == 1 / 7  # it shares one word
    assert out["1"]["Match 2 ID"] == "r4" and out["4"]["Match 1 ID"] is None


def _best(left, right, top, min_score=0.0):
    """{set_key: [(score, name, ror_id)]} of all pairs that share a token."""
    out = {}
    for x in left:
        scores = {}
        for ror_id, name, y in right:
            shared = len(set(x) & set(y))
            score = shared / (len(x) + len(y) - shared)
            if score > 0 and score >= min_score:
                scores[ror_id, name] = max(score, scores.get((ror_id, name), 0))
        best = sorted((-s, name, ror_id) for (ror_id, name), s in scores.items())[:top]
        if best:
            out[" ".join(x)] = [(-s, name, ror_id) for s, name, ror_id in best]
    return out


def _top(spark, left, right, top, frequent=10, **options):
    a = spark.createDataFrame([(" ".join(s), s) for s in left], "set_key string, tokens array<string>")
    b = spark.createDataFrame(right, "ror_id string, name string, tokens array<string>")
    tokens = frequent_tokens(a.select("tokens").unionByName(b.select("tokens")), frequent) if frequent else []
    out = {}
    for r in sorted(top_matches(a, b, top, tokens, **options).collect(), key=lambda r: r["rank"]):
        out.setdefault(r["set_key"], []).append((r["score"], r["name"], r["ror_id"]))
    return out


@pytest.mark.parametrize("top, longest", [(1, 5), (3, 8), (3, 14), (5, 25)])
def test_best_of_any_score_equal_brute_force(spark, top, longest):
    """Names of few common words, with several aliases an entry; many score below 0.2."""
    rng = random.Random(top * longest)
    left = random_sets(rng, 60, longest) + [[f"rare{i}", *rng.sample(WORDS, rng.randint(1, longest - 1))] for i in range(60)]
    left = [sorted(s) for s in left]
    right = [(f"r{i % 130}", f"name {i % 130 % 40}", s) for i, s in enumerate(random_sets(rng, 260, longest + 6))]
    want = _best(left, right, top)
    assert min(s for best in want.values() for s, _, _ in best) < 0.2
    assert _top(spark, left, right, top) == want
    assert _top(spark, left, right, top, frequent=0, min_score=0.3) == _best(left, right, top, 0.3)


def test_best_of_names_far_below_the_old_threshold(spark):
    """One shared word of thirty, entries that tie, and more aliases than are asked for."""
    words = [f"u{i}" for i in range(40)]
    left = [["of", *words[:29]], ["of"], ["none"]]
    right = [(f"r{i:02}", f"n{i // 2:02}", sorted({"of", *[f"x{i}-{k}" for k in range(i)]})) for i in range(20)]
    right += [("r19", "n09", ["of", *[f"y{k}" for k in range(5)]]), ("r30", "z", words[10:14] + ["q"])]
    left, right = [sorted(s) for s in left], [(a, b, sorted(c)) for a, b, c in right]
    got = _top(spark, left, right, 3)
    assert got == _best(left, right, 3) and " ".join(left[2]) not in got


def test_a_frequent_word_does_not_multiply_pairs(spark):
    """A word that all names and entries share costs the posting prefixes a few rows a name."""
    from pyspark.sql import functions as F

    left = spark.range(400).select(F.concat(F.lit("university k"), "id").alias("set_key"), F.array(F.lit("university"), F.concat(F.lit("k"), "id")).alias("tokens"))
    right = spark.range(600).select(F.col("id").cast("string").alias("ror_id"), F.lit("u").alias("name"), F.array(F.concat(F.lit("l"), "id"), F.lit("university")).alias("tokens"))
    pairs = posting_prefixes(left.withColumn("id", F.xxhash64("set_key")), right.withColumn("id", F.xxhash64("ror_id")), 3)
    assert pairs.count() == 400 * 3
    assert top_matches(left, right, 3, []).count() == 400 * 3
