"""Bridges expanded by their dimension and nested as one array per assertion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators.joins import lookup_join


def expand_bridge(bridge: DataFrame, dim: DataFrame, fk: str, small: bool = False) -> DataFrame:
    """Bridge rows with the columns of the dimension row they point to."""
    keyed = dim.withColumnRenamed("id", fk)
    return lookup_join(bridge.select("assertion_id", fk), keyed, fk, "inner", small)


def nest(expanded: DataFrame, value: Column, name: str, keep: Column | None = None) -> DataFrame:
    """One sorted array per assertion; rows failing ``keep`` add nothing to it."""
    item = value if keep is None else F.when(keep, value)
    return expanded.groupBy("assertion_id").agg(F.sort_array(F.collect_list(item)).alias(name))


def attach(details: DataFrame, nested: DataFrame, name: str) -> DataFrame:
    """Add an array column by assertion id; an empty array where there is none."""
    arrays = nested.withColumnRenamed("assertion_id", "id")
    joined = details.join(arrays, "id", "left")
    empty = F.array().cast(nested.schema[name].dataType)
    return joined.withColumn(name, F.coalesce(F.col(name), empty))
