"""Referential clean-up between assertions, bridges and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.corpus import BRIDGES, Corpus
from linkloom.operators.joins import drop_keys, keep_keys


def cascade(corpus: Corpus, kept: DataFrame | None = None) -> Corpus:
    """Replace the assertions by ``kept`` and drop the bridge rows of every other assertion."""
    kept = corpus.assertions if kept is None else kept
    ids = kept.select("id")
    bridges = {name: keep_keys(corpus.tables()[name], "assertion_id", ids) for name in BRIDGES}
    return corpus.with_tables(assertions=kept, **bridges)


def drop_orphans(dim: DataFrame, bridge: DataFrame, fk: str, compat: bool = False) -> DataFrame:
    """Keep the dimension rows a bridge refers to.

    The keys are made distinct map-side before the shuffle.  ``compat`` removes nothing when the
    bridge holds a null key, as ``NOT IN`` does.
    """
    keys = bridge.select(fk)
    if compat and not keys.filter(F.col(fk).isNull()).isEmpty():
        return dim
    return keep_keys(dim, "id", keys.distinct())


def drop_all_orphans(corpus: Corpus, compat: bool = False) -> Corpus:
    tables = corpus.tables()
    kept = {
        dimension: drop_orphans(tables[dimension], tables[bridge], fk, compat)
        for bridge, (fk, dimension) in BRIDGES.items()
    }
    return corpus.with_tables(**kept)


def drop_orgs(orgs: DataFrame, bridge: DataFrame, fk: str, doomed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove the organisations whose id is in ``doomed`` and the bridge rows that point to them."""
    return drop_keys(orgs, "id", doomed), drop_keys(bridge, fk, doomed)
