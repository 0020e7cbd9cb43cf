"""Accession-number report and removal of listed assertions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom import rules
from linkloom.corpus import Corpus
from linkloom.functions.identifiers import accession_matches, accession_patterns
from linkloom.operators.filters import drop_ids, select_accession_source
from linkloom.operators.integrity import cascade
from linkloom.operators.joins import broadcastable, lookup_join


def validate_accessions(
    corpus: Corpus,
    patterns: Mapping[str, str] | None = None,
    source_id: str = rules.TEXT_MINED_SOURCE_ID,
    compat: bool = False,
) -> DataFrame:
    """Assertions of one source in the checked repositories, with a pattern-match flag."""
    patterns = accession_patterns(compat) if patterns is None else patterns
    checked = select_accession_source(corpus.assertions, source_id).filter(F.col("repository_id").isin(*patterns))
    lookups = {
        key: dim.select(F.col("id").alias(key), F.col("title").alias(title))
        for key, title, dim in [
            ("repository_id", "repository_title", corpus.repositories),
            ("publisher_id", "publisher_title", corpus.publishers),
            ("source_id", "source_title", corpus.sources),
        ]
    }
    small = broadcastable(lookups)
    for key, lookup in lookups.items():
        checked = lookup_join(checked, lookup, key, small=key in small)
    return checked.select(
        "repository_id",
        "id",
        "subj_id",
        "obj_id",
        "type",
        "created",
        "updated",
        "source_type",
        "title",
        "accession_number",
        "published_date",
        "doi",
        "not_found",
        "retried",
        "repository_title",
        "publisher_title",
        "source_title",
        accession_matches(F.col("repository_id"), F.col("accession_number"), patterns).alias(
            "accession_number_pattern_match"
        ),
    )


def remove_listed(corpus: Corpus, removal_ids: DataFrame) -> Corpus:
    """Drop the listed assertions and their bridge rows."""
    return cascade(corpus, drop_ids(corpus.assertions, removal_ids))
