"""File sinks."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.corpus import BRIDGES, Corpus
from linkloom.functions.papers import once
from linkloom.operators.numbering import Numbered
from linkloom.sinks.named_files import write_named

# Quotes doubled inside quoted fields, empty fields for null and for empty text.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""}


# Headers of the two comparison reports; another wording is the caller's ``headers``.
COMPARISON_HEADERS = {
    "article_doi": "Article DOI",
    "reported": "Reported DOIs",
    "reported_count": "Reported count",
    "events": "DOIs in events",
    "events_count": "Events count",
    "same": "Same in report and events",
    "count_difference": "Difference of counts",
    "missing": "Not in events",
    "missing_count": "Not in events count",
    "found_count": "Found in events count",
}

# A chunk is one file, whatever the session says about the length of files.
ONE_FILE = {"maxRecordsPerFile": 0}


def one_task_per_chunk(chunked: DataFrame, numbered: Numbered) -> DataFrame:
    """Task n gets chunk n and nothing else, in row order; a chunk has a fixed maximum of rows."""
    placed = chunked.repartitionById(max(numbered.chunks, 1), F.col("chunk") - 1)
    return placed.sortWithinPartitions("chunk", "row_number")


def json_lines(chunked: DataFrame, numbered: Numbered, rows_per_file: int) -> DataFrame:
    """``(chunk, row_number, value)``: the lines of each chunk's JSON array, one record a line.

    The array is streamed: brackets and commas are put around the single records, so no chunk is
    ever collected into one value.  Null fields are written, null objects as ``{}``.
    """
    keep_nulls = {"ignoreNullFields": "false"}
    objects = ("repository", "publisher", "journal")
    fields = []
    # neighbouring fields are one object, written once
    for single, names in groupby((c for c in chunked.columns if c not in ("chunk", "row_number")), lambda c: c in objects):
        if single:
            for name in names:
                value = F.coalesce(F.to_json(F.col(name), keep_nulls), F.lit("{}"))
                fields.append(F.concat(F.lit(f'"{name}":'), value))
        else:
            written = F.to_json(F.struct(*names), keep_nulls)
            # without its braces
            fields.append(once(written, lambda o: o.substr(F.lit(2), F.length(o) - 2)))
    first = (F.col("row_number") - 1) % rows_per_file == 0
    last = (F.col("row_number") % rows_per_file == 0) | (F.col("row_number") == numbered.total)
    line = F.concat(
        F.when(first, "[{").otherwise("{"),
        F.concat_ws(",", *fields),
        F.when(last, "}]").otherwise("},"),
    )
    return chunked.select("chunk", "row_number", line.alias("value"))


def write_json_chunks(
    chunked: DataFrame,
    numbered: Numbered,
    path: str,
    rows_per_file: int,
    name_template: str | None = None,
) -> None:
    """One file per chunk, each holding one JSON array of the records in id order."""
    write_json_laid_out(one_task_per_chunk(chunked, numbered), numbered, path, rows_per_file, name_template)


def write_json_laid_out(
    rows: DataFrame, numbered: Numbered, path: str, rows_per_file: int, name_template: str | None = None
) -> None:
    """The same for rows that ``one_task_per_chunk`` has placed."""
    lines = json_lines(rows, numbered, rows_per_file).select("chunk", "value")
    if name_template:
        write_named(lines.select(chunk_name(name_template + ".json", numbered), "value"), path, numbered.chunks)
    else:
        lines.write.mode("overwrite").options(**ONE_FILE).partitionBy("chunk").text(path)


def chunk_name(template: str, numbered: Numbered) -> Column:
    """``name``: the template with the chunk's number, of two digits or more, for ``{nn}``."""
    if "{nn}" not in template and numbered.chunks > 1:
        raise ValueError(f"{template} names {numbered.chunks} chunks alike")
    before, _, after = template.partition("{nn}")
    number = F.format_string("%02d", "chunk") if "{nn}" in template else F.lit("")
    return F.concat(F.lit(before), number, F.lit(after)).alias("name")


def write_csv_chunks(chunked: DataFrame, numbered: Numbered, path: str, name_template: str | None = None) -> None:
    write_csv_laid_out(one_task_per_chunk(chunked, numbered), numbered, path, name_template)


def write_csv_laid_out(rows: DataFrame, numbered: Numbered, path: str, name_template: str | None = None) -> None:
    """The same for rows that ``one_task_per_chunk`` has placed."""
    flat = rows.drop("row_number")
    if name_template:
        columns = [c for c in flat.columns if c != "chunk"]
        options = {k: str(v) for k, v in CSV_OPTIONS.items() if k != "header"}
        line = F.to_csv(F.struct(*columns), options)
        # the numbers run on from chunk to chunk, so a chunk's first row is the least of its numbers
        first = (F.col("row_number") - 1) % numbered.rows_per_chunk == 0
        headed = F.when(first, F.concat(F.lit(",".join(columns) + "\n"), line)).otherwise(line)
        write_named(rows.select(chunk_name(name_template + ".csv", numbered), headed.alias("value")), path, numbered.chunks)
    else:
        flat.write.mode("overwrite").options(**CSV_OPTIONS, **ONE_FILE).partitionBy("chunk").csv(path)


def write_partitioned_csv(df: DataFrame, path: str, by: str) -> None:
    """One folder of CSV files per value of ``by``.

    Rows are gathered by that value first, so a value does not leave a file in every task; the
    rebalance splits a value that holds many rows into files of the advisory size.
    """
    df.hint("rebalance", F.col(by)).write.mode("overwrite").options(**CSV_OPTIONS).partitionBy(by).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_citations(citations: DataFrame, path: str) -> None:
    """Resolved text-mined citations, one folder per repository code."""
    columns = ["repo_code", "repository", "dataset", "publication"]
    write_partitioned_csv(citations.select(*columns), path, "repo_code")


def write_validation(report: DataFrame, path: str) -> None:
    """Accession report, one folder per repository."""
    write_partitioned_csv(report, path, "repository_id")


def write_buckets(classified: DataFrame, path: str) -> None:
    """Review rows by bucket; rows in no bucket are not written."""
    write_partitioned_csv(classified.filter(F.col("bucket").isNotNull()), path, "bucket")


def write_candidates(report: DataFrame, path: str) -> None:
    """The candidate report without the organisation id: the name and four columns a match."""
    write_csv(report.drop("id"), path)


def write_comparison(report: DataFrame, path: str, headers: Mapping[str, str] | None = None) -> None:
    """A comparison with citation events under the report's headers; further columns keep their names."""
    names = {**COMPARISON_HEADERS, **(headers or {})}
    write_csv(report.withColumnsRenamed({c: names[c] for c in report.columns if c in names}), path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).saveAsTable(name)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Store a result and read it back; running it again is the refresh."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_corpus(corpus: Corpus, path: str) -> None:
    for name, table in corpus.tables().items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def save_bucketed(corpus: Corpus, buckets: int) -> None:
    """Store the corpus as tables, assertions and bridges bucketed and sorted by assertion id.

    Cascades, nesting and the details join on that id, so on these tables they need no shuffle
    on the stored side.  Read back with ``load_corpus(spark, reader=spark.table)``.
    """
    layout = {"assertions": "id", **{bridge: "assertion_id" for bridge in BRIDGES}}
    for name, table in corpus.tables().items():
        key = layout.get(name)
        if key is None:
            table.write.mode("overwrite").saveAsTable(name)
        else:
            # one task per bucket, so that each bucket is one sorted file
            rows = table.repartition(buckets, key)
            rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
