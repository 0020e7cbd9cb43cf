"""Table-level updates expressed as projections and keyed joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom import rules
from linkloom.functions.identifiers import normalize_doi
from linkloom.functions.titles import fix_separator
from linkloom.operators.dedup import pick_by_key
from linkloom.operators.joins import lookup_join

DOI_COLUMNS = ("subj_id", "obj_id", "doi", "dataset", "publication")


def add_dataset_publication(assertions: DataFrame) -> DataFrame:
    """Name the dataset and the publication end of each link by its source type."""
    source = F.col("source_type")
    subject_is_dataset = source.isNull() | (source == rules.SUBJECT_IS_DATASET_SOURCE)
    object_is_dataset = source == rules.OBJECT_IS_DATASET_SOURCE
    return assertions.withColumns(
        {
            "dataset": F.when(subject_is_dataset, F.col("subj_id")).when(object_is_dataset, F.col("obj_id")),
            "publication": F.when(subject_is_dataset, F.col("obj_id")).when(object_is_dataset, F.col("subj_id")),
        }
    )


def merge_repositories(
    assertions: DataFrame,
    repositories: DataFrame,
    merged: Mapping[str, str] = rules.MERGED_REPOSITORIES,
) -> tuple[DataFrame, DataFrame]:
    """Point assertions of a duplicate repository to the one kept and drop the duplicate."""
    current = F.col("repository_id")
    target = current
    for old, new in merged.items():
        target = F.when(current == old, F.lit(new)).otherwise(target)
    return (
        assertions.withColumn("repository_id", target),
        repositories.filter(~F.col("id").isin(*merged)),
    )


def clear_invalid_ids(orgs: DataFrame, invalid: Sequence[str]) -> DataFrame:
    """Null out external ids that are placeholders; an empty list changes nothing."""
    if not invalid:
        return orgs
    external_id = F.col("external_id")
    return orgs.withColumn("external_id", F.when(~F.trim(external_id).isin(*invalid), external_id))


def ensure_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the missing ones of these text columns as nulls."""
    missing = {c: F.lit(None).cast("string") for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def lowercase_titles(df: DataFrame) -> DataFrame:
    return df.withColumn("title", F.lower("title"))


def normalize_assertion_dois(assertions: DataFrame) -> DataFrame:
    """Normalise every identifier column that is present."""
    present = [c for c in DOI_COLUMNS if c in assertions.columns]
    return assertions.withColumns({c: normalize_doi(F.col(c)) for c in present})


def fix_separators(
    df: DataFrame, columns: Sequence[str] = ("affiliations", "funders"), compat: bool = False
) -> DataFrame:
    """Remove the blank before each separator of a flat list column.

    ``compat`` leaves the later columns alone where the first one is empty.
    """
    first = F.col(columns[0])
    fixed = {}
    for column in columns:
        value = F.col(column)
        fixed[column] = F.when(first != "", fix_separator(value)).otherwise(value) if compat else fix_separator(value)
    return df.withColumns(fixed)


def update_from(df: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite columns by the row of ``updates`` with the same key, nulls included.

    Of several updates of a key the greatest counts, so no row is multiplied.
    """
    single = pick_by_key(updates.select(key, *columns), [key], [])
    joined = lookup_join(df, single.select(key, F.struct(*columns).alias("_new")), key)
    matched = F.col("_new").isNotNull()
    replaced = {c: F.when(matched, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(replaced).drop("_new")
