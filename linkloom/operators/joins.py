"""Joins with a checked broadcast and a shuffle path that stands up to skew.

Beyond the broadcast bound, ``lookup_join`` is a shuffle join in which AQE can split the partition
of a hot key by map output, copies of one row included.  AQE only does so when both sides come
straight out of a shuffle made for the join.  A lookup that was aggregated by its key is already
partitioned by it and would be joined in place, so the join runs on a prefixed form of the key:
the lookup, the small side, is shuffled once more and the facts become splittable.  Null keys,
which match nothing, are left out where only matches stay; a left join gives them stand-ins that
spread them over all partitions.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
NULL_SPREAD = 997


def row_bytes(df: DataFrame) -> Column:
    """Rough size of a row: eight bytes a column, plus the length of text and nested values."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    total = F.lit(8 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, nested):
            value = F.to_json(F.struct(value))
        elif not isinstance(field.dataType, T.StringType):
            continue
        total = total + F.coalesce(F.octet_length(value), F.lit(0))
    return total


def broadcastable(
    tables: Mapping[str, DataFrame],
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> set[str]:
    """Names of the tables measured to be small enough to send to every executor.

    One job measures them all; only one row per table comes back.
    """
    probes = [
        table.agg(
            F.lit(name).alias("name"),
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(row_bytes(table)), F.lit(0)).alias("bytes"),
        )
        for name, table in tables.items()
    ]
    measured = reduce(DataFrame.unionByName, probes).collect()
    return {m["name"] for m in measured if m["rows"] <= max_rows and m["bytes"] <= max_bytes}


def broadcast_if_small(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    small = broadcastable(tables)
    return {name: F.broadcast(table) if name in small else table for name, table in tables.items()}


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, how: str = "left", small: bool = False) -> DataFrame:
    """Left, inner or semi join on one text column whose name both sides share.

    ``small``: the lookup has been measured and may be broadcast.
    """
    if small:
        return df.join(F.broadcast(lookup), key, how)
    spread_key = F.concat(F.lit("="), key)
    if how == "left":
        carried = [F.col(f"`{c}`") for c in df.columns if c != key]
        spread = F.xxhash64(*carried) if carried else F.spark_partition_id()
        slot = F.pmod(spread, F.lit(NULL_SPREAD)).cast("string")
        # real keys start with "=", stand-ins with "-", so they never meet
        spread_key = F.coalesce(spread_key, F.concat(F.lit("-"), slot))
    else:  # a null key matches nothing
        df = df.filter(F.col(key).isNotNull())
    left = df.withColumn("_spread_key", spread_key)
    right = lookup.filter(F.col(key).isNotNull()).withColumn("_lookup_key", F.concat(F.lit("="), key)).drop(key)
    joined = left.join(right, left["_spread_key"] == right["_lookup_key"], how)
    return joined.drop("_spread_key", "_lookup_key")


def in_all_partitions(df: DataFrame, *keys: str) -> DataFrame:
    """Rows laid out by key over as many partitions as the session shuffles into.

    AQE merges the partitions of its own shuffles by their compressed size.  Texts that compress
    well then fill a task's memory with many times that; a layout by number is left as it is.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


#: Rows of either side that one block of ``product_join`` takes.
BLOCK_ROWS = 1000


def product_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on a text column, for keys that both sides repeat so often that the matches outgrow the rows.

    The rows of a key are dealt into blocks of about ``BLOCK_ROWS`` on either side and every pair of
    blocks is joined by itself, so the matches of one key are made by all tasks.  A row is copied
    once for each block of the other side: matches divided by ``BLOCK_ROWS``.  Both sides are read twice.
    """

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias(name))

    grid = blocks(left, "_lefts").join(blocks(right, "_rights"), key)

    def dealt(df: DataFrame, mine: str, others: str, block: str, copy: str) -> DataFrame:
        columns = [F.col(f"`{c}`") for c in df.columns]
        own = F.pmod(F.xxhash64(*columns), F.col(mine)).cast("int").alias(block)
        rows = lookup_join(df, grid, key, "inner").select(*columns, own, others)
        copied = rows.withColumn(copy, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop(others)
        return in_all_partitions(copied, key, "_left", "_right")

    pairs = dealt(left, "_lefts", "_rights", "_left", "_right").join(
        dealt(right, "_rights", "_lefts", "_right", "_left"), [key, "_left", "_right"]
    )
    return pairs.drop("_left", "_right")


def keep_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key occurs in the only column of ``keys``."""
    return _on_key(df, key, keys, "left_semi")


def drop_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key does not occur in the only column of ``keys``; null keys stay."""
    return _on_key(df, key, keys, "left_anti")


def _on_key(df: DataFrame, key: str, keys: DataFrame, how: str) -> DataFrame:
    wanted = keys.select(F.col(keys.columns[0]).alias("_key"))
    return df.join(wanted, df[key] == wanted["_key"], how)
