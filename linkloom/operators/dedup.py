"""One row per key: newest, last by order, first by order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom import rules


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = tuple(rules.DEDUP_KEYS),
    order_col: str = "updated",
    tie: str = "id",
) -> DataFrame:
    """Keep the newest row of each key; a null date counts as newest, ties go to the lowest id.

    The ``= 1`` filter on the row number lets Spark cut every group to one row before the
    shuffle, so a group of copies of any size sends one row per input partition.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(order_col).desc_nulls_first(), F.col(tie))
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def pick_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = True) -> DataFrame:
    """One row per key, the greatest (``last``) or the least in ``order``; combined map-side.

    Rows that compare equal in ``order`` are told apart by their remaining columns.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    chosen = (F.max if last else F.min)(ranked).alias("_row")
    picked = df.groupBy(*keys).agg(chosen)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def assert_unique(df: DataFrame, column: str) -> DataFrame:
    """Return ``df`` if no non-null value of the column repeats, else raise."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    sample = repeated.limit(1).collect()
    if sample:
        raise ValueError(f"column {column!r} is not unique, e.g. {sample[0][column]!r}")
    return df
