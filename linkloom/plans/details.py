"""Denormalised assertion details: one nested row per assertion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.corpus import Corpus
from linkloom.functions.labels import organisation, titled, titled_or_null
from linkloom.operators.joins import broadcastable, lookup_join
from linkloom.operators.nesting import attach, expand_bridge, nest


def _lookups(corpus: Corpus, build) -> dict[str, DataFrame]:
    """The four fact dimensions, each reduced to its key and the one column it contributes."""
    made = {
        f"{one}_id": dim.select(
            F.col("id").alias(f"{one}_id"), build(F.col("title"), F.col("external_id")).alias(one)
        )
        for one, dim in [
            ("repository", corpus.repositories),
            ("publisher", corpus.publishers),
            ("journal", corpus.journals),
        ]
    }
    made["source_id"] = corpus.sources.select(F.col("id").alias("source_id"), F.col("abbreviation").alias("source"))
    return made


def _nested_dims(corpus: Corpus, *org_columns: str) -> dict[str, DataFrame]:
    """The bridged dimensions with the columns that are nested, so only those are measured."""
    return {
        "affiliations": corpus.affiliations.select("id", *org_columns),
        "funders": corpus.funders.select("id", *org_columns),
        "subjects": corpus.subjects.select("id", "title"),
    }


def join_dims(assertions: DataFrame, lookups: dict[str, DataFrame], small: set[str]) -> DataFrame:
    """Left join every lookup by its key, those measured small by broadcast."""
    for key, lookup in lookups.items():
        assertions = lookup_join(assertions, lookup, key, small=key in small)
    return assertions


def assertion_details_formatted(corpus: Corpus) -> DataFrame:
    """The dump table.  Needs the ``dataset`` and ``publication`` columns on assertions.

    The bridges are expanded and nested before they meet the fact, so the fact is shuffled once
    (by id) and all three joins reuse that partitioning.
    """
    dims = _nested_dims(corpus, "title", "external_id", "ror_name", "ror_id")
    lookups = _lookups(corpus, titled_or_null)
    small = broadcastable({**dims, **lookups})

    def expanded(bridge: DataFrame, dim: str, fk: str) -> DataFrame:
        return expand_bridge(bridge, dims[dim], fk, small=dim in small)

    details = join_dims(
        corpus.assertions.select(
            "id",
            "created",
            "updated",
            "repository_id",
            "publisher_id",
            "journal_id",
            "title",
            "dataset",
            "publication",
            F.col("published_date").alias("publishedDate"),
            "source_id",
        ),
        lookups,
        small,
    )
    org = organisation(F.col("title"), F.col("external_id"), F.col("ror_name"), F.col("ror_id"))
    named = F.col("title").isNotNull() | F.col("external_id").isNotNull()
    affiliations = expanded(corpus.assertions_affiliations, "affiliations", "affiliation_id")
    funders = expanded(corpus.assertions_funders, "funders", "funder_id")
    subjects = expanded(corpus.assertions_subjects, "subjects", "subject_id")
    details = attach(details, nest(affiliations, org, "affiliations", named), "affiliations")
    details = attach(details, nest(funders, org, "funders", named), "funders")
    title = F.col("title")
    details = attach(details, nest(subjects, title, "subjects", title.isNotNull()), "subjects")
    return details.select(
        "id",
        "created",
        "updated",
        "repository",
        "publisher",
        "journal",
        "title",
        "dataset",
        "publication",
        "publishedDate",
        "source",
        "affiliations",
        "funders",
        "subjects",
    )


def assertion_details(corpus: Corpus, funders_via: str = "funders") -> DataFrame:
    """The view form: identifiers kept, no null filter in the arrays, empty text for no source.

    ``funders_via='affiliations'`` looks funders up through the affiliations bridge.
    """
    dims = _nested_dims(corpus, "title", "external_id")
    lookups = _lookups(corpus, titled)
    small = broadcastable({**dims, **lookups})

    def expanded(bridge: DataFrame, dim: str, fk: str) -> DataFrame:
        return expand_bridge(bridge, dims[dim], fk, small=dim in small)

    details = join_dims(corpus.assertions, lookups, small)
    item: Column = titled(F.col("title"), F.col("external_id"))
    subjects = expanded(corpus.assertions_subjects, "subjects", "subject_id")
    affiliations = expanded(corpus.assertions_affiliations, "affiliations", "affiliation_id")
    if funders_via == "affiliations":
        funders = expanded(corpus.assertions_affiliations, "funders", "affiliation_id")
    else:
        funders = expanded(corpus.assertions_funders, "funders", "funder_id")
    details = attach(details, nest(subjects, F.col("title"), "subjects"), "subjects")
    details = attach(details, nest(affiliations, item, "affiliations"), "affiliations")
    details = attach(details, nest(funders, item, "funders"), "funders")
    return details.select(
        "id",
        "created",
        "updated",
        "repository",
        "publisher",
        "journal",
        "title",
        F.col("obj_id").alias("objid"),
        F.col("subj_id").alias("subjid"),
        F.col("published_date").alias("publisheddate"),
        F.col("accession_number").alias("accessionnumber"),
        "doi",
        F.col("relation_type_id").alias("relationtypeid"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        "subjects",
        "affiliations",
        "funders",
    )
