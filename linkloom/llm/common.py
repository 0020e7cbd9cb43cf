"""What the operators share: reading, names that cannot clash, tokens, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.session import ensure_checkpoint_dir

#: White space of a word or line edge: space and the code points 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
#: A word, as a pattern for Spark's built-in functions.
WORD = r"[^\x20\x09-\x0D]+"


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_A_BATCH = 1000


def short_batches(spark: SparkSession) -> None:
    """Send texts to Python 1,000 at a time, unless the session has its own number.

    Spark's default of 10,000 rows is meant for numbers; with texts it costs both sides memory.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(TEXTS_A_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder.

    Copies stay there unless the session sets ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def word_count(text: Column) -> Column:
    """Number of runs of anything but ``SPACES``; null counts 0.  Built-in functions only."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# -- connected components ---------------------------------------------------------------------


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over one partition: its links become one link from every end to the smallest."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    ends = [x for x in parent if root(x) != x]
    if ends:
        yield pd.DataFrame({"a": ends, "b": [root(x) for x in ends]}, dtype="int64")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of the links (a, b): the smallest node it is tied to.

    Partitions first reduce their links to forests.  Then two kinds of star steps alternate until
    nothing changes: each node ties its larger neighbours to its smallest one, then its smaller
    ones.  A round costs two aggregations of the links; chains shrink to a fraction each round.
    A node's neighbours are never gathered: the smallest is an aggregate, joined back.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    pairs = checkpointed(pairs.mapInPandas(_forest, "a long, b long"))
    mark = None
    while not pairs.isEmpty():
        pairs = checkpointed(_star(_star(pairs, larger=True), larger=False))
        seen = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.max("b"), F.countDistinct("a")
        ).first()
        if mark == seen:
            break
        mark = seen
    tied = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return tied.unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    if larger:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy(F.col("a").alias("_n")).agg(F.min("b").alias("_m"))
    least = least.withColumn("_m", F.least("_n", "_m"))
    joined = both.join(least, both["a"] == least["_n"])
    if larger:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("_m").alias("b"))
        out = out.unionByName(least.select(F.col("_n").alias("a"), F.col("_m").alias("b")))
    return out.filter("a <> b").distinct()


# -- running totals without one long task -------------------------------------------------------


def running_start(df: DataFrame, group: str, order: list[str], amount: str, out: str, chunks: int) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the rows of the group that come before.

    Rows go by the hash of the order columns to one of ``chunks`` chunks a group; the order is
    (chunk, order columns).  A hot group is thus spread over all chunks, and only chunk totals
    meet in one task a group.  Built-in functions only.
    """
    chunk = fresh(df, "_chunk")
    df = df.withColumn(chunk, F.pmod(F.xxhash64(*[col(c) for c in order]), F.lit(chunks)))
    totals = df.groupBy(group, chunk).agg(F.sum(amount).alias("_total"))
    before = Window.partitionBy(group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col(group).alias("_g"), F.col(chunk).alias("_c"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn(out, F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    # Spark takes a table that was exploded for as small as it was before, and would broadcast it
    joined = df.join(totals.hint("merge"), df[group].eqNullSafe(totals["_g"]) & (df[chunk] == totals["_c"]))
    return joined.withColumn(out, F.col(out) + F.col("_before")).drop(chunk, "_g", "_c", "_before")


def ascii_lower_bytes(text: str) -> bytes:
    """UTF-8 with A-Z lowered; other letters keep their case."""
    return text.encode("utf-8", "surrogatepass").lower()


def digest64(data: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(data)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
