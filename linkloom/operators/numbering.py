"""Exact global row numbers in key order without a single sorting task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.session import ensure_checkpoint_dir

ROWS_PER_FILE = 1_000_000
_POSITION_BITS = 33


@dataclass(frozen=True)
class Numbered:
    rows: DataFrame
    total: int
    chunks: int
    rows_per_chunk: int = ROWS_PER_FILE


def number_rows(
    df: DataFrame, key: str = "id", rows_per_chunk: int = ROWS_PER_FILE, partitions: int | None = None
) -> Numbered:
    """``(key, row_number, chunk)`` for every row, numbered from 1 in key order.

    Keys must be there and be different: a null or repeated one is an error, since rows could not
    be joined with their numbers.

    Only the key is moved: it is range-partitioned, sorted inside the partitions and cut to the
    shared checkpoint folder, which fixes what lies in which partition.  The number of a row is
    then its position in its partition plus the rows of all partitions before it.  Only the row
    count of each partition comes to the driver.  ``partitions`` sets how many there are; without
    it the session's shuffle partitions decide.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    by_range = [key] if partitions is None else [partitions, key]
    keys = df.select(key).repartitionByRange(*by_range).sortWithinPartitions(key).checkpoint()
    # upper bits: partition, lower 33 bits: position in it; fixed by the stored partitions
    placed = keys.withColumn("_place", F.monotonically_increasing_id())
    placed = placed.select(
        key,
        F.shiftright("_place", _POSITION_BITS).cast("int").alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
    )
    # equal keys lie in the same partition, so distinct ones may be counted in each
    counted = placed.groupBy("_part").agg(
        F.count(F.lit(1)).alias("n"), F.count(key).alias("filled"), F.count_distinct(key).alias("different")
    )
    sizes = sorted(tuple(r) for r in counted.collect())
    offsets, total = [], 0
    for part, n, filled, different in sizes:
        if filled < n or different < n:
            raise ValueError(f"{n - filled} rows without {key}, {filled - different} that repeat one")
        offsets.append((part, total))
        total += n
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_offset", T.LongType())])
    # one row per partition of the sort
    starts = F.broadcast(spark.createDataFrame(offsets, schema))
    number = F.col("_offset") + F.col("_position") + 1
    rows = placed.join(starts, "_part").select(
        key,
        number.alias("row_number"),
        (F.floor((number - 1) / rows_per_chunk) + 1).cast("int").alias("chunk"),
    )
    return Numbered(rows, total, -(-total // rows_per_chunk), rows_per_chunk)
