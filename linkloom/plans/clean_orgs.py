"""Clean-up of organisation tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.corpus import Corpus
from linkloom.functions import titles
from linkloom.operators.filters import unless
from linkloom.operators.integrity import drop_orgs


def clean_affiliations(affiliations: DataFrame, compat: bool = False) -> DataFrame:
    """Each step sees the result of the one before it."""
    steps = [
        titles.remove_emails,
        titles.remove_contact_labels,
        lambda t: titles.clean_remaining_email_titles(t, compat),
        lambda t: titles.clean_trailing(t, compat),
        titles.unwrap_parentheses,
        titles.clean_leading,
    ]
    return _apply(affiliations, steps)


def clean_funders(funders: DataFrame, compat: bool = False) -> DataFrame:
    steps = [
        lambda t: titles.clean_either_end(t, compat),
        lambda t: titles.clean_trailing(t, compat),
    ]
    return _apply(funders, steps)


def _apply(df: DataFrame, steps) -> DataFrame:
    for step in steps:
        df = df.withColumn("title", step(F.col("title")))
    return df


def drop_handle_orgs(orgs: DataFrame, bridge: DataFrame, fk: str = "affiliation_id") -> tuple[DataFrame, DataFrame]:
    """Remove organisations whose title holds only @handles, with their bridge rows."""
    handles = titles.is_handles_only(F.col("title"))
    _, kept_bridge = drop_orgs(orgs, bridge, fk, orgs.filter(handles).select("id"))
    return orgs.filter(unless(handles)), kept_bridge


def drop_org_ids(
    orgs: DataFrame, bridge: DataFrame, ids: Sequence[str], fk: str = "affiliation_id"
) -> tuple[DataFrame, DataFrame]:
    """Remove a short literal list of organisations, with their bridge rows."""
    return (
        orgs.filter(unless(F.col("id").isin(*ids))),
        bridge.filter(unless(F.col(fk).isin(*ids))),
    )


def clean_orgs(corpus: Corpus, doomed_ids: Sequence[str] = (), compat: bool = False) -> Corpus:
    affiliations, bridge = drop_handle_orgs(corpus.affiliations, corpus.assertions_affiliations)
    if doomed_ids:
        affiliations, bridge = drop_org_ids(affiliations, bridge, doomed_ids)
    return corpus.with_tables(
        affiliations=clean_affiliations(affiliations, compat),
        assertions_affiliations=bridge,
        funders=clean_funders(corpus.funders, compat),
    )
