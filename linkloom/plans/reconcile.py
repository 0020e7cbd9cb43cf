"""Organisations matched to a registry snapshot by id, by other external ids and by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom import rules
from linkloom.corpus import Corpus
from linkloom.functions.identifiers import ROR_URL, external_id_search_key, normalize_external_id
from linkloom.functions.titles import name_key
from linkloom.operators.joins import broadcastable, lookup_join
from linkloom.operators.similarity import frequent_tokens, token_set
from linkloom.operators.topk_names import top_matches
from linkloom.operators.updates import clear_invalid_ids, ensure_columns

MATCH_COLUMNS = ("Name", "ID", "Score", "Chosen")


def registry_names(registry: DataFrame) -> DataFrame:
    """``(ror_id, name, label)``: every name and alias of every entry."""
    labels = F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    return registry.select("ror_id", "name", F.explode(labels).alias("label"))


def by_id(registry: DataFrame) -> DataFrame:
    """One entry per registry id; an id listed more than once takes its least name."""
    keyed = registry.select(F.col("ror_id").alias("_id_key"), F.struct("ror_id", "name").alias("entry"))
    return keyed.groupBy("_id_key").agg(F.min("entry").alias("_by_id"))


def by_external_id(registry: DataFrame) -> DataFrame:
    """One entry per external id, the one with the lowest registry id."""
    keyed = registry.select(F.explode("external_ids").alias("_id_key"), F.struct("ror_id", "name").alias("entry"))
    return keyed.filter(F.col("_id_key") != "").groupBy("_id_key").agg(F.min("entry").alias("_by_id"))


def by_name(registry: DataFrame) -> DataFrame:
    """One entry per name, kept only where exactly one registry entry bears it."""
    keyed = registry_names(registry).select(
        name_key(F.col("label")).alias("_name_key"), F.struct("ror_id", "name").alias("entry")
    )
    least, greatest = F.min("entry"), F.max("entry")
    return (
        keyed.filter(F.col("_name_key").isNotNull())
        .groupBy("_name_key")
        .agg(least.alias("_by_name"), (least["ror_id"] == greatest["ror_id"]).alias("single"))
        .filter("single")
        .drop("single")
    )


def id_lookup(registry: DataFrame) -> DataFrame:
    """Registry ids and other external ids in one table, so one join serves both."""
    return by_id(registry).unionByName(by_external_id(registry).filter(~F.col("_id_key").startswith(ROR_URL)))


def with_search_keys(orgs: DataFrame, compat: bool = False) -> DataFrame:
    """Normalised external id, the key to look it up with, and the name key."""
    external_id = F.col("external_id")
    normalized = F.when(external_id != "", normalize_external_id(external_id, compat)).otherwise(external_id)
    # a ROR URL is its own search key
    return (
        orgs.withColumn("_normalized", normalized)
        .withColumn("_id_key", F.nullif(external_id_search_key(F.col("_normalized")), F.lit("")))
        .withColumn("_name_key", name_key(F.col("title")))
    )


def reconcile_orgs(
    orgs: DataFrame,
    registry: DataFrame,
    invalid_ids: Sequence[str] = (),
    since: str | None = None,
    compat: bool = False,
) -> DataFrame:
    """Fill ``ror_id`` and ``ror_name`` and normalise ``external_id`` of unresolved organisations.

    First pass, rows with neither registry id nor name: look up by external id, or by title when
    there is none.  Second pass, rows that have an external id and still no registry id: by
    title.  Both passes become two left joins and a projection.
    """
    columns = [*orgs.columns, *[c for c in ("ror_id", "ror_name") if c not in orgs.columns]]
    orgs = clear_invalid_ids(ensure_columns(orgs, ("ror_id", "ror_name")), invalid_ids)
    recent = F.lit(True)
    if since is not None:
        recent = F.coalesce(F.col("created") >= F.lit(since).cast("timestamp"), F.lit(False))
    lookups = {"_id_key": id_lookup(registry), "_name_key": by_name(registry)}
    small = broadcastable(lookups)
    joined = with_search_keys(orgs, compat)
    for key, lookup in lookups.items():
        joined = lookup_join(joined, lookup, key, small=key in small)

    first_pass = recent & F.col("ror_id").isNull() & F.col("ror_name").isNull()
    has_id = F.coalesce(F.col("external_id") != "", F.lit(False))
    first = F.when(has_id, F.col("_by_id")).otherwise(F.col("_by_name"))
    entry = F.struct(F.col("ror_id"), F.col("ror_name").alias("name"))
    after_first = F.when(first_pass, first).otherwise(entry)
    second_pass = recent & F.col("external_id").isNotNull() & F.col("_after_first.ror_id").isNull()
    joined = joined.withColumn("_after_first", after_first)
    joined = joined.withColumn("_final", F.when(second_pass, F.col("_by_name")).otherwise(F.col("_after_first")))
    return joined.withColumns(
        {
            "external_id": F.when(first_pass, F.col("_normalized")).otherwise(F.col("external_id")),
            "ror_id": F.col("_final.ror_id"),
            "ror_name": F.col("_final.name"),
        }
    ).select(*columns)


def reconcile_corpus(
    corpus: Corpus,
    registry: DataFrame,
    invalid_ids: Mapping[str, Sequence[str]] = rules.INVALID_EXTERNAL_IDS,
    since: str | None = None,
    compat: bool = False,
) -> Corpus:
    """Reconcile affiliations and funders, each with its own list of placeholder ids."""
    tables = corpus.tables()
    done = {
        name: reconcile_orgs(tables[name], registry, invalid_ids.get(name, ()), since, compat)
        for name in ("affiliations", "funders")
    }
    return corpus.with_tables(**done)


def unresolved_orgs(affiliations: DataFrame, funders: DataFrame) -> DataFrame:
    """Distinct ``(id, title)`` of both tables' rows without an external id."""
    sides = [t.filter(F.col("external_id").isNull()).select("id", "title") for t in (affiliations, funders)]
    return sides[0].union(sides[1]).distinct()


def candidate_matches(
    orgs: DataFrame, registry: DataFrame, min_score: float = 0.0, top: int = 3
) -> DataFrame:
    """The ``top`` best registry entries ``(set_key, rank, name, ror_id, score)`` per distinct name of ``orgs``.

    All that share a word with the name count, however low they score; ``min_score`` leaves out
    those below it.  Copies of a name are collapsed first, so a name borne by a third of all rows is
    matched once.
    """
    sets = orgs.select(token_set(F.col("title")).alias("tokens")).filter("size(tokens) > 0").distinct()
    sets = sets.select(F.array_join("tokens", " ").alias("set_key"), "tokens")
    names = registry_names(registry).select("ror_id", "name", token_set(F.col("label")).alias("tokens"))
    names = names.filter("size(tokens) > 0").distinct()
    frequent = frequent_tokens(sets.select("tokens").unionByName(names.select("tokens")))
    return top_matches(sets, names, top, frequent, min_score)


def candidate_report(orgs: DataFrame, registry: DataFrame, min_score: float = 0.0, top: int = 3) -> DataFrame:
    """One row per organisation: its name and its ``top`` best matches, whatever they score, best first.

    A match is chosen when it is the only one with a full score.
    """
    matches = candidate_matches(orgs, registry, min_score, top)

    def at(rank: int, column: str):
        return F.max(F.when(F.col("rank") == rank, F.col(column)))

    second_is_full = F.coalesce(at(2, "score") == 1, F.lit(False))
    columns = []
    for rank in range(1, top + 1):
        chosen = (at(rank, "score") == 1) & ~second_is_full if rank == 1 else at(rank, "score") < 0
        values = (at(rank, "name"), at(rank, "ror_id"), at(rank, "score"), chosen)
        columns += [v.alias(f"Match {rank} {label}") for label, v in zip(MATCH_COLUMNS, values)]
    wide = matches.groupBy("set_key").agg(*columns)
    keyed = orgs.withColumn("set_key", F.array_join(token_set(F.col("title")), " "))
    joined = lookup_join(keyed, wide, "set_key")
    return joined.select("id", F.col("title").alias("Original Name"), *[c for c in wide.columns if c != "set_key"])

