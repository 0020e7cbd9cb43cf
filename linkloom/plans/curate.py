"""The removal pipeline, with an audit of what each step took out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom import rules
from linkloom.corpus import BRIDGES, Corpus
from linkloom.operators.dedup import dedup_latest
from linkloom.operators.filters import (
    is_citation,
    is_not_self_citation,
    not_excluded_without_doi,
    not_source_relation,
    outside_repositories,
)
from linkloom.operators.integrity import cascade, drop_all_orphans
from linkloom.session import discard, stored

DUPLICATES = "duplicates"
SELF_CITATIONS = "self citations"


@dataclass(frozen=True)
class Curated:
    """The result and its audit.  ``marks`` is the stored copy that both are read from, if any."""

    corpus: Corpus
    audit: DataFrame
    marks: DataFrame | None = None

    def release(self) -> None:
        """Delete the stored copy, once the tables and the audit have been written."""
        if self.marks is not None:
            discard(self.marks)


def row_checks(
    trial_repositories: Sequence[str] = tuple(rules.CLINICAL_TRIAL_REPOSITORIES),
    source_relation: tuple[str, str] | None = None,
    excluded_repositories: Sequence[str] | None = None,
) -> dict[str, Column]:
    """The row-level steps between deduplication and orphan removal, in order."""
    checks = {
        "non citations": is_citation(),
        "clinical trials": outside_repositories(trial_repositories),
    }
    if source_relation is not None:
        checks["source and relation"] = not_source_relation(*source_relation)
    if excluded_repositories is not None:
        checks["excluded without doi"] = not_excluded_without_doi(excluded_repositories)
    return checks


def curate(
    corpus: Corpus,
    removal_ids: DataFrame | None = None,
    checkpoint: bool = True,
    compat: bool = False,
    **check_options,
) -> Curated:
    """Deduplicate, drop non-citations, trials, orphans and self-citations, and count each step.

    Row filters only ever shrink the kept set, so they are not run one after the other: one pass
    marks each deduplicated row with the first step that removes it.  Bridges are then joined
    once with the marked ids; the rows alive before the self-citation step decide which
    dimension rows are orphans, those alive after it are the result.

    The marked table feeds the audit and every output table.  It is stored once in the shared
    checkpoint folder, so that rows are shuffled by the deduplication keys a single time and the
    bridges and the audit read one or two narrow columns of it; ``release`` deletes it when all is
    written.  ``checkpoint=False`` computes it anew for each output.
    """
    checks = {
        **row_checks(**check_options),
        SELF_CITATIONS: is_not_self_citation(),
    }
    marked = dedup_latest(corpus.assertions)
    if removal_ids is not None:
        listed = removal_ids.select(F.col(removal_ids.columns[0]).alias("id")).distinct()
        listed = listed.withColumn("_listed", F.lit(True))
        marked = marked.join(listed, "id", "left")
        checks = {
            "listed ids": F.col("_listed").isNull(),
            **checks,
        }
    first_failed = F.lit(None).cast("string")
    for step, keep in reversed(checks.items()):
        first_failed = F.when(~keep, F.lit(step)).otherwise(first_failed)
    marked = marked.withColumn("_removed_by", first_failed).drop("_listed")
    if checkpoint:
        marked = stored(marked)

    removed_by = F.col("_removed_by")
    alive_before_orphans = marked.filter(removed_by.isNull() | (removed_by == SELF_CITATIONS))
    marks = alive_before_orphans.select(F.col("id").alias("assertion_id"), removed_by.isNull().alias("_survives"))
    tables = corpus.tables()
    bridges_before = {name: tables[name].join(marks, "assertion_id") for name in BRIDGES}
    pruned = drop_all_orphans(corpus.with_tables(**bridges_before), compat)
    result = pruned.with_tables(
        assertions=marked.filter(removed_by.isNull()).drop("_removed_by"),
        **{name: bridge.filter("_survives").select(*tables[name].columns) for name, bridge in bridges_before.items()},
    )
    return Curated(result, _audit(corpus, marked, list(checks), pruned), marked if checkpoint else None)


def curate_stepwise(corpus: Corpus, compat: bool = False, **check_options) -> Corpus:
    """The same result by the literal sequence of steps, each followed by its bridge cascade."""
    corpus = cascade(corpus, dedup_latest(corpus.assertions))
    for keep in row_checks(**check_options).values():
        corpus = cascade(corpus, corpus.assertions.filter(keep))
    corpus = drop_all_orphans(corpus, compat)
    return cascade(corpus, corpus.assertions.filter(is_not_self_citation()))


def _audit(corpus: Corpus, marked: DataFrame, steps: list[str], pruned: Corpus) -> DataFrame:
    """Rows ``(step_no, step, table, removed, remaining)`` in the order the steps run."""
    orphans_at = steps.index(SELF_CITATIONS) + 2
    order = {DUPLICATES: 1}
    for position, step in enumerate(steps):
        order[step] = position + 2 + (step == SELF_CITATIONS)

    def counted(df: DataFrame, column: Column) -> DataFrame:
        return df.groupBy(column.alias("step")).agg(F.count(F.lit(1)).alias("n"))

    # one row per step: initial rows, rows lost to each check, and rows left at the end (null)
    initial = corpus.assertions.agg(F.lit("initial").alias("step"), F.count(F.lit(1)).alias("n"))
    counts = initial.unionByName(counted(marked, F.col("_removed_by")))
    initial_n = F.sum(F.when(F.col("step") == "initial", F.col("n")))
    marked_n = F.sum(F.when(F.col("step").isNull() | (F.col("step") != "initial"), F.col("n")))
    removed = {DUPLICATES: F.coalesce(initial_n, F.lit(0)) - F.coalesce(marked_n, F.lit(0))}
    for step in steps:
        removed[step] = F.coalesce(F.sum(F.when(F.col("step") == step, F.col("n"))), F.lit(0))
    entries = F.array(
        *[
            F.struct(
                F.lit(order[step]).alias("step_no"),
                F.lit(step).alias("step"),
                F.lit("assertions").alias("table"),
                n.cast("bigint").alias("removed"),
            )
            for step, n in removed.items()
        ]
    )
    facts = counts.agg(entries.alias("entries"), initial_n.alias("initial")).select(
        F.explode("entries").alias("entry"), "initial"
    )
    running = Window.partitionBy("initial").orderBy("entry.step_no")
    facts = facts.select("entry.*", (F.col("initial") - F.sum("entry.removed").over(running)).alias("remaining"))

    before, after = corpus.tables(), pruned.tables()
    dims = [
        before[dim]
        .select(F.lit(1).alias("b"), F.lit(0).alias("a"))
        .unionByName(after[dim].select(F.lit(0).alias("b"), F.lit(1).alias("a")))
        .agg(
            F.lit(orphans_at).alias("step_no"),
            F.lit("orphans").alias("step"),
            F.lit(dim).alias("table"),
            F.coalesce(F.sum("b") - F.sum("a"), F.lit(0)).alias("removed"),
            F.coalesce(F.sum("a"), F.lit(0)).alias("remaining"),
        )
        for _, dim in BRIDGES.values()
    ]
    return reduce(DataFrame.unionByName, [facts, *dims]).orderBy("step_no", "table")


def stage_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after one step and the number it removed."""
    sides = before.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    n_before, n_after = F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("a"), F.lit(0))
    return sides.agg(
        n_before.alias("rows_before"), (n_before - n_after).alias("removed"), n_after.alias("remaining")
    )
