"""File sources."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom import rules, schemas
from linkloom.corpus import Corpus
from linkloom.functions.identifiers import strip
from linkloom.plans.ingest import usable_crosswalk, usable_feed
from linkloom.plans.papers import count_bad_lines, parse_papers
from linkloom.sources.quoted_csv import read_positional


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns with their types, then any further columns of the table.

    A missing column is added as nulls.  Timestamps stay with or without zone as they are stored.
    """
    timestamps = (T.TimestampType, T.TimestampNTZType)
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        kind = present.get(field.name)
        if kind is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif kind == field.dataType or isinstance(kind, timestamps) and isinstance(field.dataType, timestamps):
            columns.append(F.col(field.name))
        else:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*columns, *[c for c in df.columns if c not in schema.names])


def load_corpus(
    spark: SparkSession, path: str | None = None, reader: Callable[[str], DataFrame] | None = None
) -> Corpus:
    """The eleven tables as Parquet folders under ``path``.

    Another store goes through ``reader``, a function from table name to DataFrame such as
    ``spark.table`` for stored tables or ``lambda t: spark.read.jdbc(url, t, column="id", ...)``.
    """
    read = reader or (lambda name: spark.read.parquet(f"{path}/{name}"))
    return Corpus(**{name: conform(read(name), schema) for name, schema in schemas.CORPUS.items()})


def _file_name() -> Column:
    """Name of the file a row comes from, decoded."""
    return F.url_decode(F.substring_index(F.input_file_name(), "/", -1))


def read_removal_lists(spark: SparkSession, path: str) -> DataFrame:
    """``(assertion_id, repository_id)`` from every ``<repository>-remove*`` file of a folder."""
    lists = spark.read.schema("assertion_id string").option("pathGlobFilter", "*-remove*").csv(path)
    return removal_rows(lists.withColumn("file", _file_name()))


def removal_rows(lists: DataFrame) -> DataFrame:
    """``(assertion_id, repository_id)`` of raw list rows ``(assertion_id, file)``."""
    repository = F.regexp_extract("file", r"^(.+?)-remove", 1)
    return lists.select(strip(F.col("assertion_id")).alias("assertion_id"), repository.alias("repository_id"))


def read_textmined(
    spark: SparkSession,
    path: str,
    crosswalk_file: str = "PMID_PMCID_DOI.csv",
    exclude: Sequence[str] = tuple(rules.EXCLUDED_FEEDS),
) -> DataFrame:
    """``(repo_code, accession, pmcid)`` of all feeds of a folder, except the crosswalk and ``exclude``.

    The code of a feed is its file name up to the first dot.  Columns go by position.  Quoted fields
    may hold line breaks; a file is split among tasks all the same.
    """
    return feed_rows(read_positional(spark, path, ["accession", "pmcid"]), crosswalk_file, exclude)


def feed_rows(
    feed: DataFrame,
    crosswalk_file: str = "PMID_PMCID_DOI.csv",
    exclude: Sequence[str] = tuple(rules.EXCLUDED_FEEDS),
) -> DataFrame:
    """``(repo_code, accession, pmcid)`` of raw feed rows ``(file, accession, pmcid)``."""
    feed = feed.withColumn("repo_code", F.substring_index("file", ".", 1))
    feed = feed.filter(~F.col("file").endswith(crosswalk_file) & ~F.col("repo_code").isin(*exclude))
    return usable_feed(feed).select("repo_code", "accession", "pmcid")


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """``(pmcid, doi)``: the second and third column, rows with both filled.

    An id listed more than once is settled where the table is used, by its greatest DOI.
    """
    return usable_crosswalk(read_positional(spark, path, ["pmid", "pmcid", "doi"]).drop("file"))


def read_name_map(spark: SparkSession, path: str) -> DataFrame:
    """``(repo_code, name)`` from one JSON object of codes and names."""
    return name_rows(spark.read.text(path, wholetext=True))


def name_rows(text: DataFrame) -> DataFrame:
    """``(repo_code, name)`` of the JSON objects in column ``value``."""
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("repo_code", "name"))


def _stored_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_lookup_cache(spark: SparkSession, path: str) -> DataFrame:
    """``(pmcid, doi_url)`` stored as Parquet; empty when there is none yet."""
    return _stored_or_empty(spark, path, schemas.LOOKUP_CACHE)


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    """The paper table stored as Parquet; empty when there is none yet."""
    return _stored_or_empty(spark, path, schemas.PAPERS)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Organisation registry snapshot as JSON lines ``{ror_id, name, aliases, external_ids}``."""
    return spark.read.schema(schemas.REGISTRY).json(path)


def read_papers_jsonl(spark: SparkSession, path: str, compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """Papers and bad lines of a folder of (gzipped) JSON lines; one task per gzip file.

    ``count_bad_lines_of`` tells how many bad lines each file has.
    """
    lines = spark.read.option("pathGlobFilter", "*.jsonl*").text(path)
    papers, bad = parse_papers(lines, compat)
    return papers, bad


def count_bad_lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``(file, bad_lines)`` of the files of a folder that hold lines which are no JSON object."""
    lines = spark.read.option("pathGlobFilter", "*.jsonl*").text(path).withColumn("file", _file_name())
    return count_bad_lines(parse_papers(lines)[1])


def read_review_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, blanks after a separator skipped, empty fields null, names stripped."""
    df = (
        spark.read.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=True, nullValue="")
        .option("multiLine", True)
        .csv(path)
    )
    return df.toDF(*[c.strip() for c in df.columns])


REVIEW_COLUMNS = ("Dataset", *(f"Match {i} {what}" for i in (1, 2, 3) for what in ("Name", "ID", "Chosen")))


def review_rows(lines: DataFrame) -> DataFrame:
    """Reviewed candidates of CSV lines in column ``value``, read as ``read_review_csv`` reads files."""
    schema = ", ".join(f"`{c}` string" for c in REVIEW_COLUMNS)
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "nullValue": ""}
    return lines.select(F.from_csv("value", schema, options).alias("r")).select("r.*")


def citation_list(text: Column) -> Column:
    """Array of the entries of a bracketed, quoted, comma-separated list."""
    inner = F.btrim(text, F.lit("[]"))
    entries = F.transform(F.split(inner, ","), lambda e: F.btrim(e, F.lit('" ')))
    return F.filter(entries, lambda e: e != "")


def read_citation_report(
    spark: SparkSession, path: str, article_column: str = "Article DOI", cited_column: str | None = None
) -> DataFrame:
    """``(article_doi, cited)``; the list column is the one whose name ends in ``References``."""
    df = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(path)
    if cited_column is None:
        cited_column = next(c for c in df.columns if c.strip().endswith("References"))
    cited = citation_list(F.coalesce(F.col(f"`{cited_column}`"), F.lit("")))
    return df.select(F.col(f"`{article_column}`").alias("article_doi"), cited.alias("cited"))


def read_dump(spark: SparkSession, path: str, record_per_line: bool = True) -> DataFrame:
    """Records of exported JSON array files; an empty object reads as one with null fields.

    Our own dumps hold one record per line, so they are split and read line by line whatever
    their size.  ``record_per_line=False`` reads an array laid out in any other way.
    """
    if not record_per_line:
        return spark.read.schema(schemas.DETAILS).option("multiLine", True).json(path)
    return dump_records(spark.read.text(path))


def dump_records(lines: DataFrame) -> DataFrame:
    """Records of the lines of our own dumps in column ``value``."""
    # a record begins and ends with a brace, so what lies around it needs no search through the line
    record = F.btrim("value", F.lit("[],\r"))
    return lines.select(F.from_json(record, schemas.DETAILS).alias("r")).select("r.*")
