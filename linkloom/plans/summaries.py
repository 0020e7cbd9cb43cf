"""Dashboard summaries.  Their definitions are our reading of their names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.corpus import BRIDGES, Corpus


def assertions_last_10_years(assertions: DataFrame, until_year: int) -> DataFrame:
    """Assertions per publication year, the ten years up to ``until_year``."""
    year = F.substring("published_date", 1, 4).try_cast("int")
    return (
        assertions.select(year.alias("year"))
        .filter(F.col("year").between(until_year - 9, until_year))
        .groupBy("year")
        .agg(F.count(F.lit(1)).alias("assertions"))
    )


def growth_per_day(assertions: DataFrame) -> DataFrame:
    """Assertions created per day and the running total; the window sees one row per day."""
    per_day = assertions.groupBy(F.to_date("created").alias("day")).agg(F.count(F.lit(1)).alias("added"))
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.withColumn("total", F.sum("added").over(running))


def facet_unique_counts(corpus: Corpus) -> DataFrame:
    """Number of distinct values of each facet among the assertions and their bridges."""
    columns = [(corpus.assertions, name, f"{name}_id") for name in ("repository", "publisher", "journal", "source")]
    columns += [(corpus.tables()[bridge], dim, fk) for bridge, (fk, dim) in BRIDGES.items()]
    counts = [
        df.select(column).distinct().agg(F.lit(facet).alias("facet"), F.count(column).alias("unique_values"))
        for df, facet, column in columns
    ]
    return reduce(DataFrame.unionByName, counts)
