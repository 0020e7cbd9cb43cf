import random

from pyspark.sql import functions as F

from linkloom.llm.common import components, fresh, running_start, word_count
from tests.llm import brute


def test_components_of_chains_stars_and_random_graphs(spark):
    dice = random.Random(1)
    links = [(i, i + 1) for i in range(1000, 1300)] + [(2000, 2000 + i) for i in range(1, 200)]
    links += [(dice.randrange(400), dice.randrange(400)) for _ in range(250)] + [(5, 5), (7, 3), (7, 3)]
    ties = brute.Ties()
    for a, b in links:
        ties.tie(a, b)
    want = {x: ties.root(x) for a, b in links if a != b for x in (a, b)}
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    rows = components(df).collect()
    assert {r.node: r.component for r in rows} == want and len(rows) == len(want)
    assert components(df.limit(0)).count() == 0


def test_running_start_is_a_sum_over_the_rows_before(spark):
    rows = [(i % 3, i, (i * 7) % 11) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, k int, n long")
    out = running_start(df, "g", ["k"], "n", "start", 5).collect()
    for g in range(3):
        mine = sorted((r.start, r.n) for r in out if r.g == g)
        end = 0
        for start, n in mine:
            assert start == end
            end = start + n


def test_word_count_and_fresh_names(spark):
    df = spark.createDataFrame([("a\u00a0b  c\x1cd\n\x0be",), ("",), (None,), (" \t",)], "text string")
    assert [r[0] for r in df.select(word_count(F.col("text"))).collect()] == [3, 0, 0, 0]
    assert fresh(df.withColumn("x", F.lit(1)), "X") == "X_"
