"""Reviewed candidate matches: classify them, pick the chosen ones, link them to assertions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.identifiers import derived_id, is_uuid, strip
from linkloom.operators.joins import broadcastable, drop_keys, lookup_join, product_join
from linkloom.session import stored

MATCHES = (1, 2, 3)
BUCKETS = {"one": "exactly_one_true", "none": "all_false", "many": "more_than_one_true"}


def _chosen_flag(match: int) -> Column:
    return F.upper(strip(F.col(f"Match {match} Chosen")))


def classify_matches(review: DataFrame) -> DataFrame:
    """Add ``num_true``, ``all_false`` and ``bucket``; rows with a gap and no TRUE get no bucket."""
    flags = [_chosen_flag(i) for i in MATCHES]
    num_true = sum((F.coalesce(f == "TRUE", F.lit(False)).cast("int") for f in flags), F.lit(0))
    all_false = F.lit(True)
    for flag in flags:
        all_false = all_false & F.coalesce(flag == "FALSE", F.lit(False))
    bucket = (
        F.when(F.col("num_true") == 1, BUCKETS["one"])
        .when(F.col("num_true") > 1, BUCKETS["many"])
        .when(F.col("all_false"), BUCKETS["none"])
    )
    return review.withColumns({"num_true": num_true, "all_false": all_false}).withColumn("bucket", bucket)


def bucket_summary(classified: DataFrame) -> DataFrame:
    """Rows in total, in each bucket and in none."""
    counts = [F.count(F.lit(1)).alias("total")]
    counts += [F.count(F.when(F.col("bucket") == b, 1)).alias(b) for b in BUCKETS.values()]
    counts.append(F.count(F.when(F.col("bucket").isNull(), 1)).alias("no_bucket"))
    return classified.agg(*counts)


def chosen_matches(review: DataFrame) -> DataFrame:
    """Distinct ``(dataset_key, ror_id, title)`` of the first match marked TRUE in each row."""
    picked = F.coalesce(
        *[
            F.when(
                _chosen_flag(i) == "TRUE",
                F.struct(
                    strip(F.col(f"Match {i} ID")).alias("ror_id"),
                    strip(F.col(f"Match {i} Name")).alias("title"),
                ),
            )
            for i in MATCHES
        ]
    )
    rows = review.select(strip(F.col("Dataset")).alias("dataset_key"), picked.alias("m"))
    return rows.select("dataset_key", "m.ror_id", "m.title").dropna().dropDuplicates()


@dataclass(frozen=True)
class Linked:
    affiliations: DataFrame
    bridge: DataFrame
    new_affiliations: DataFrame
    new_links: DataFrame


def resolve_org_by_title(chosen: DataFrame, affiliations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(title, affiliation_id)`` of every chosen title and the affiliations that must be added.

    A title several affiliations share goes to the one with the greatest id; a new affiliation
    takes the least of the registry ids chosen for its title.
    """
    titles = chosen.groupBy("title").agg(F.min("ror_id").alias("ror_id"))
    # reduced to one row per title before the join, so a title of many affiliations stays small
    known = affiliations.groupBy("title").agg(F.max("id").alias("affiliation_id"))
    known = known.join(titles.select("title"), "title", "left_semi")
    new = titles.join(known, "title", "left_anti").select(
        derived_id(F.lit("affiliation"), F.col("title")).alias("id"),
        "title",
        "ror_id",
        F.lit("affiliation").alias("type"),
    )
    by_title = known.unionByName(new.select("title", F.col("id").alias("affiliation_id")))
    return by_title, new


def assertions_for_keys(
    keys: DataFrame,
    assertions: DataFrame,
    bridge: DataFrame,
    is_id: Callable[[Column], Column] = is_uuid,
    compat: bool = False,
) -> DataFrame:
    """``(dataset_key, assertion_id)`` of the assertions without an affiliation a key stands for.

    Keys that look like ids match the assertion id, others its dataset.  ``compat`` keeps one
    assertion per key, the one with the greatest id.
    """
    keys = keys.select("dataset_key").distinct()
    # reviewed keys are usually few: then neither pass over the assertions is shuffled
    small = bool(broadcastable({"keys": keys}))
    looks_like_id = is_id(F.col("dataset_key"))
    by_id = assertions.select(F.col("id").alias("dataset_key"), F.col("id").alias("assertion_id"))
    by_dataset = assertions.select(F.col("dataset").alias("dataset_key"), F.col("id").alias("assertion_id"))
    matched = lookup_join(by_id, keys.filter(looks_like_id), "dataset_key", "left_semi", small).unionByName(
        lookup_join(by_dataset, keys.filter(~looks_like_id), "dataset_key", "left_semi", small)
    )
    matched = drop_keys(matched, "assertion_id", bridge.select("assertion_id").distinct())
    if compat:
        matched = matched.groupBy("dataset_key").agg(F.max("assertion_id").alias("assertion_id"))
    return matched


def build_org_links(chosen: DataFrame, by_key: DataFrame, by_title: DataFrame) -> DataFrame:
    """New bridge rows: chosen match x assertion x organisation."""
    # a dataset may have many chosen matches and many assertions, and each pair of them is a link
    linked = product_join(stored(lookup_join(chosen, by_title, "title", "inner")), stored(by_key), "dataset_key")
    return linked.select(
        derived_id(
            F.lit("assertionAffiliation"),
            F.col("dataset_key"),
            F.col("ror_id"),
            F.col("title"),
            F.col("assertion_id"),
            F.col("affiliation_id"),
        ).alias("id"),
        "assertion_id",
        "affiliation_id",
        F.lit("assertionAffiliation").alias("type"),
    )


def link_chosen_affiliations(
    review: DataFrame,
    affiliations: DataFrame,
    assertions: DataFrame,
    bridge: DataFrame,
    is_id: Callable[[Column], Column] = is_uuid,
    compat: bool = False,
) -> Linked:
    chosen = chosen_matches(review)
    by_title, new_affiliations = resolve_org_by_title(chosen, affiliations)
    by_key = assertions_for_keys(chosen, assertions, bridge, is_id, compat)
    new_links = build_org_links(chosen, by_key, by_title)
    return Linked(
        affiliations.unionByName(new_affiliations, allowMissingColumns=True),
        bridge.unionByName(new_links, allowMissingColumns=True),
        new_affiliations,
        new_links,
    )
