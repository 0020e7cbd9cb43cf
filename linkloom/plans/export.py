"""The dump: nested JSON and flat CSV, cut into files of a fixed number of rows in id order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.labels import joined, object_label, organisation_label, ror_label
from linkloom.operators.numbering import ROWS_PER_FILE, Numbered, number_rows
from linkloom.operators.updates import fix_separators
from linkloom.sinks.files import CSV_OPTIONS, one_task_per_chunk, write_csv_laid_out, write_json_laid_out


def with_chunks(details: DataFrame, numbered: Numbered, key: str = "id") -> DataFrame:
    """Attach the row number and chunk.  Details are laid out by id already, so only keys move."""
    return details.join(numbered.rows, key)


def csv_rows(details: DataFrame, compat: bool = False) -> DataFrame:
    """Flat form of the nested records: 16 text columns in their fixed order."""

    def labels(column: str, one: Callable[[Column, bool], Column]) -> Column:
        return joined(F.transform(column, lambda ref: one(ref, compat)))

    def label(column: str) -> Column:
        return F.coalesce(object_label(F.col(column), compat), F.lit(""))

    # the row number and the chunk ride along
    extra = [c for c in details.columns if c in ("row_number", "chunk")]
    return details.select(
        "id",
        "created",
        "updated",
        label("repository").alias("repository"),
        label("publisher").alias("publisher"),
        label("journal").alias("journal"),
        "title",
        "dataset",
        "publication",
        "publishedDate",
        "source",
        joined(F.col("subjects")).alias("subjects"),
        labels("affiliations", organisation_label).alias("affiliations"),
        labels("affiliations", ror_label).alias("affiliationsROR"),
        labels("funders", organisation_label).alias("funders"),
        labels("funders", ror_label).alias("fundersROR"),
        *extra,
    )


def export_dump(
    details: DataFrame,
    path: str,
    rows_per_file: int = ROWS_PER_FILE,
    ids: DataFrame | None = None,
    name_template: str | None = None,
) -> Numbered:
    """Write the JSON and the CSV form under ``path/json`` and ``path/csv``.

    The nested rows are laid out by chunk once and kept on the executors' disks until both forms
    are written; a lost executor's part is built again.

    ``ids``: a cheaper table with the same ids (the assertions), to number without building the
    nested rows twice.  ``name_template`` such as ``"2025-01-01-links-{nn}"`` names the files.
    """
    numbered = number_rows(details if ids is None else ids, "id", rows_per_file)
    rows = one_task_per_chunk(with_chunks(details, numbered), numbered).persist(StorageLevel.DISK_ONLY)
    try:
        write_json_laid_out(rows, numbered, f"{path}/json", rows_per_file, name_template)
        write_csv_laid_out(csv_rows(rows), numbered, f"{path}/csv", name_template)
    finally:
        rows.unpersist()
    return numbered


def rewrite_separators(spark: SparkSession, source: str, target: str, compat: bool = False) -> None:
    """Rewrite CSV dumps with the separators of their list columns fixed; all columns stay text."""
    rows = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(source)
    fix_separators(rows, compat=compat).write.mode("overwrite").options(**CSV_OPTIONS).csv(target)
