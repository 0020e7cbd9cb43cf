"""Text-mined citations: accession and article id pairs resolved to publications."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom import rules
from linkloom.functions.identifiers import doi_to_url, strip, with_pmc_prefix
from linkloom.operators.dedup import pick_by_key
from linkloom.operators.joins import broadcastable, drop_keys, lookup_join

DOI_CODE = "doi"


def usable_feed(feed: DataFrame) -> DataFrame:
    """Rows with both fields filled (tested before trimming), trimmed."""
    filled = feed.filter((F.col("accession") != "") & (F.col("pmcid") != ""))
    return filled.withColumns({"accession": strip(F.col("accession")), "pmcid": strip(F.col("pmcid"))})


def usable_crosswalk(crosswalk: DataFrame) -> DataFrame:
    """``(pmcid, doi)`` with both filled after trimming."""
    trimmed = crosswalk.select(strip(F.col("pmcid")).alias("pmcid"), strip(F.col("doi")).alias("doi"))
    return trimmed.filter((F.col("pmcid") != "") & (F.col("doi") != ""))


def publication_lookup(crosswalk: DataFrame, cache: DataFrame) -> DataFrame:
    """One publication URL per article id: the crosswalk's, else the cache's.

    An id listed twice takes its greatest DOI.  Both inputs go into one map-side combined
    aggregate, so the feed needs a single join.
    """
    none = F.lit(None).cast("string")
    sides = usable_crosswalk(crosswalk).select("pmcid", "doi", none.alias("cached")).unionByName(
        cache.select("pmcid", none.alias("doi"), F.nullif(F.col("doi_url"), F.lit("")).alias("cached"))
    )
    best = sides.groupBy("pmcid").agg(F.max("doi").alias("doi"), F.max("cached").alias("cached"))
    return best.select("pmcid", F.coalesce(doi_to_url(F.col("doi")), F.col("cached")).alias("publication"))


def lookup_publications(feed: DataFrame, crosswalk: DataFrame, cache: DataFrame) -> DataFrame:
    """Feed rows with their publication, null where it is unknown."""
    lookup = publication_lookup(crosswalk, cache)
    return lookup_join(usable_feed(feed), lookup, "pmcid")


def resolve_publications(feed: DataFrame, crosswalk: DataFrame, cache: DataFrame) -> DataFrame:
    return lookup_publications(feed, crosswalk, cache).filter(F.col("publication").isNotNull())


def missing_keys(feed: DataFrame, crosswalk: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct article ids in neither table, and the form an id service expects."""
    keys = usable_feed(feed).select("pmcid").distinct()
    known = usable_crosswalk(crosswalk).select("pmcid").unionByName(cache.select("pmcid"))
    return drop_keys(keys, "pmcid", known.distinct()).withColumn("query_key", with_pmc_prefix(F.col("pmcid")))


def merge_lookup_cache(old: DataFrame, new: DataFrame) -> DataFrame:
    """Cache ``(pmcid, doi_url)`` with new entries put over old ones."""
    ranked = old.withColumn("age", F.lit(0)).unionByName(new.withColumn("age", F.lit(1)))
    return pick_by_key(ranked, ["pmcid"], [F.col("age"), F.col("doi_url")]).drop("age")


def name_table(df: DataFrame, names: Mapping[str, str] = rules.REPOSITORY_NAMES) -> DataFrame:
    return df.sparkSession.createDataFrame(list(names.items()), "repo_code string, name string")


def standardize_repository(df: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Add ``repository``: the display name of the code, or the code itself."""
    if names is None:
        named = df.join(F.broadcast(name_table(df)), "repo_code", "left")
    else:
        named = lookup_join(df, names, "repo_code", small=bool(broadcastable({"names": names})))
    return named.withColumn("repository", F.coalesce("name", "repo_code")).drop("name")


def lookup_publisher(df: DataFrame, publishers: DataFrame) -> DataFrame:
    """Rows of the DOI feed are named after the publisher of their dataset, null when unknown.

    Rows of other feeds carry no key, take no part in the join and are spread evenly.
    """
    is_doi_feed = F.col("repository") == DOI_CODE
    key = F.when(is_doi_feed & F.col("dataset").startswith("10."), F.col("dataset"))
    lookup = publishers.groupBy(F.col("doi").alias("_doi")).agg(F.max("publisher").alias("_publisher"))
    joined = lookup_join(df.withColumn("_doi", key), lookup, "_doi")
    named = F.when(is_doi_feed, F.col("_publisher")).otherwise(F.col("repository"))
    return joined.withColumn("repository", named).drop("_doi", "_publisher")


def match_rate(looked_up: DataFrame, by: str = "repo_code") -> DataFrame:
    """Rows, rows with a publication and their percentage per feed."""
    total, matched = F.count(F.lit(1)), F.count("publication")
    return looked_up.groupBy(by).agg(
        total.alias("total"),
        matched.alias("matched"),
        F.round(matched * 100.0 / total, 1).alias("percent"),
    )


@dataclass(frozen=True)
class Ingested:
    citations: DataFrame
    missing: DataFrame
    rates: DataFrame


def ingest_textmined(
    feed: DataFrame,
    crosswalk: DataFrame,
    cache: DataFrame,
    publishers: DataFrame,
    names: DataFrame | None = None,
) -> Ingested:
    """Citations ``(repo_code, repository, dataset, publication)``, unresolved ids, match rates."""
    looked_up = lookup_publications(feed, crosswalk, cache)
    resolved = looked_up.filter(F.col("publication").isNotNull()).withColumnRenamed("accession", "dataset")
    citations = lookup_publisher(standardize_repository(resolved, names), publishers)
    return Ingested(
        citations.select("repo_code", "repository", "dataset", "publication"),
        missing_keys(feed, crosswalk, cache),
        match_rate(looked_up),
    )
