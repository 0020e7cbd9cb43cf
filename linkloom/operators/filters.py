"""Row filters on assertions, each written as the condition to keep a row.

A delete removes rows where its condition is true; false and unknown stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom import rules
from linkloom.operators.joins import drop_keys


def unless(condition: Column) -> Column:
    """True where the delete condition is false or unknown."""
    return ~F.coalesce(condition, F.lit(False))


def is_citation(relations: Sequence[str] = tuple(rules.CITATION_RELATIONS)) -> Column:
    relation = F.col("relation_type_id")
    return relation.isNull() | relation.isin(*relations)


def outside_repositories(repositories: Sequence[str]) -> Column:
    return unless(F.col("repository_id").isin(*repositories))


def is_not_self_citation(keep_nulls: bool = False) -> Column:
    differs = F.col("subj_id") != F.col("obj_id")
    return F.coalesce(differs, F.lit(keep_nulls))


def not_source_relation(source_type: str, relation: str) -> Column:
    return unless((F.col("source_type") == source_type) & (F.col("relation_type_id") == relation))


def not_excluded_without_doi(repositories: Sequence[str]) -> Column:
    return unless(F.col("repository_id").isin(*repositories) & F.col("doi").isNull())


def keep_citations(assertions: DataFrame) -> DataFrame:
    return assertions.filter(is_citation())


def drop_repositories(
    assertions: DataFrame, repositories: Sequence[str] = tuple(rules.CLINICAL_TRIAL_REPOSITORIES)
) -> DataFrame:
    return assertions.filter(outside_repositories(repositories))


def drop_self_citations(assertions: DataFrame, keep_nulls: bool = False) -> DataFrame:
    return assertions.filter(is_not_self_citation(keep_nulls))


def drop_source_relation(
    assertions: DataFrame,
    source_type: str = rules.OBJECT_IS_DATASET_SOURCE,
    relation: str = "is-referenced-by",
) -> DataFrame:
    return assertions.filter(not_source_relation(source_type, relation))


def drop_excluded_without_doi(
    assertions: DataFrame, repositories: Sequence[str] = tuple(rules.EXCLUDED_REPOSITORIES)
) -> DataFrame:
    return assertions.filter(not_excluded_without_doi(repositories))


def drop_ids(assertions: DataFrame, removal_ids: DataFrame) -> DataFrame:
    """Drop the assertions listed in the first column of ``removal_ids``."""
    return drop_keys(assertions, "id", removal_ids)


def select_accession_source(assertions: DataFrame, source_id: str = rules.TEXT_MINED_SOURCE_ID) -> DataFrame:
    return assertions.filter(F.col("source_id") == source_id)


def select_recent(df: DataFrame, since: str | None) -> DataFrame:
    """Rows created on or after a date; everything without one."""
    return df if since is None else df.filter(F.col("created") >= F.lit(since).cast("timestamp"))


def select_unresolved(orgs: DataFrame, since: str | None = None) -> DataFrame:
    """Organisations without a registry id and name."""
    return select_recent(orgs, since).filter(F.col("ror_id").isNull() & F.col("ror_name").isNull())


def select_unresolved_with_id(orgs: DataFrame, since: str | None = None) -> DataFrame:
    """Organisations that have an external id and still no registry id."""
    return select_recent(orgs, since).filter(F.col("external_id").isNotNull() & F.col("ror_id").isNull())
