"""Summaries kept up to date by their changes instead of counted anew.

The state is a ``KeyedStore`` with a row for each value of each facet: how many rows of the corpus
hold it.  A refresh aggregates the added and withdrawn rows to signed counts and merges them into the
buckets of the values concerned; it reads the changes and those buckets, never the corpus.  The
summaries are read from the state, which holds a row a value and not a row a link.

A refresh is seen as a whole or not at all.  Withdrawing what is not there is an error and leaves
the state as it was.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.corpus import BRIDGES
from linkloom.sinks.keyed_store import KeyedStore

FACETS = ("repository", "publisher", "journal", "source")
#: Tables whose rows are counted.
COUNTED = ("assertions", *BRIDGES)


def _counted(tables: Mapping[str, DataFrame], sign: int) -> list[DataFrame]:
    """(facet, value, n) of each counted table at hand, one pass a table."""

    def pair(facet: str, value: Column) -> Column:
        return F.struct(F.lit(facet).alias("facet"), value.cast("string").alias("value"))

    unknown = set(tables) - set(COUNTED)
    if unknown:
        raise ValueError(f"not counted: {sorted(unknown)}")
    out = []
    for name, rows in tables.items():
        if name == "assertions":
            year = F.substring("published_date", 1, 4).try_cast("int")
            pairs = [pair("year", year), pair("day", F.to_date("created"))] + [pair(f, F.col(f"{f}_id")) for f in FACETS]
        else:
            column, dim = BRIDGES[name]
            pairs = [pair(dim, F.col(column))]
        held = rows.select(F.inline(F.array(*pairs)))
        out.append(held.groupBy("facet", "value").agg((F.count(F.lit(1)) * sign).alias("n")))
    return out


def signed_counts(added: Mapping[str, DataFrame], withdrawn: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(key, facet, value, n): by how much each value's count changes; values that do not change are left out.

    Both take ``assertions`` and bridges by name; a changed row is withdrawn as it was and added as it is.
    """
    parts = _counted(added, 1) + _counted(withdrawn or {}, -1)
    if not parts:
        raise ValueError("a change needs a table")
    total = reduce(DataFrame.unionByName, parts).groupBy("facet", "value").agg(F.sum("n").alias("n")).filter("n <> 0")
    # a null value has a key of its own, unlike that of an empty one
    key = F.concat("facet", F.coalesce(F.concat(F.lit("="), "value"), F.lit("")))
    return total.select(key.alias("key"), "facet", "value", "n")


def _merge(old: DataFrame, change: DataFrame) -> DataFrame:
    merged = old.unionByName(change).groupBy("key", "facet", "value").agg(F.sum("n").alias("n"))
    wrong = F.raise_error(F.concat(F.lit("more withdrawn than there is: "), "key")).cast("long")
    return merged.withColumn("n", F.when(F.col("n") < 0, wrong).otherwise(F.col("n"))).filter("n <> 0")


def create_summary_store(tables: Mapping[str, DataFrame], path: str, buckets: int) -> KeyedStore:
    """Count a corpus once; ``tables`` are its assertions and bridges."""
    return KeyedStore.create(signed_counts(tables), path, "key", buckets)


def refresh_summaries(
    store: KeyedStore, added: Mapping[str, DataFrame], withdrawn: Mapping[str, DataFrame] | None = None
) -> KeyedStore:
    """The store after rows were added and withdrawn; only the buckets of their values are read and rewritten."""
    return store.upsert(signed_counts(added, withdrawn), _merge)


def _values(store: KeyedStore, facet: str) -> DataFrame:
    return store.read().filter(F.col("facet") == facet)


def assertions_last_10_years(store: KeyedStore, until_year: int) -> DataFrame:
    year = F.col("value").cast("int")
    kept = _values(store, "year").filter(year.between(until_year - 9, until_year))
    return kept.select(year.alias("year"), F.col("n").alias("assertions"))


def growth_per_day(store: KeyedStore) -> DataFrame:
    """The window sees one row per day."""
    per_day = _values(store, "day").select(F.col("value").cast("date").alias("day"), F.col("n").alias("added"))
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.withColumn("total", F.sum("added").over(running))


def facet_unique_counts(store: KeyedStore) -> DataFrame:
    """A facet without values has a count of 0."""
    names = [*FACETS, *(dim for _, dim in BRIDGES.values())]
    facets = F.explode(F.array(*[F.lit(n) for n in names])).alias("facet")
    wanted = store.spark.range(1).select(facets)
    held = store.read().groupBy("facet").agg(F.count("value").alias("unique_values"))
    return wanted.join(F.broadcast(held), "facet", "left").select("facet", F.coalesce("unique_values", F.lit(0)).alias("unique_values"))
