"""The corpus: one fact table, its dimensions and the many-to-many bridges."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame

# bridge table -> (its foreign key, the dimension it points to)
BRIDGES = {
    "assertions_affiliations": ("affiliation_id", "affiliations"),
    "assertions_funders": ("funder_id", "funders"),
    "assertions_subjects": ("subject_id", "subjects"),
}


@dataclass(frozen=True)
class Corpus:
    """Immutable set of lazy tables; every curation step returns a new one."""

    assertions: DataFrame
    repositories: DataFrame
    publishers: DataFrame
    journals: DataFrame
    sources: DataFrame
    subjects: DataFrame
    affiliations: DataFrame
    funders: DataFrame
    assertions_subjects: DataFrame
    assertions_affiliations: DataFrame
    assertions_funders: DataFrame

    def with_tables(self, **tables: DataFrame) -> Corpus:
        return replace(self, **tables)

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}
