"""Tag the new assertions of a repository with the subjects its rule names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom import rules
from linkloom.corpus import Corpus
from linkloom.functions.identifiers import derived_id
from linkloom.operators.dedup import assert_unique
from linkloom.operators.filters import select_recent
from linkloom.operators.joins import broadcast_if_small
from linkloom.operators.updates import lowercase_titles


def add_subjects(subjects: DataFrame, titles: Sequence[str], now: Column | None = None) -> DataFrame:
    """Add the titles that no subject has yet, in lower case."""
    now = F.current_timestamp() if now is None else now
    wanted = [(title,) for title in dict.fromkeys(t.lower() for t in titles)]
    literal = subjects.sparkSession.createDataFrame(wanted, "title string")
    # the literal list is the small side: find which of it exists, then add the others
    existing = subjects.join(F.broadcast(literal), "title", "left_semi").select("title").distinct()
    missing = literal.join(existing, "title", "left_anti")
    added = missing.select(
        derived_id(F.lit("subject"), F.col("title")).alias("id"),
        "title",
        F.lit("subject").alias("type"),
        now.alias("created"),
        now.alias("updated"),
    )
    return subjects.unionByName(added, allowMissingColumns=True)


def expand_subject_rules(
    assertions: DataFrame,
    subjects: DataFrame,
    existing: DataFrame,
    subject_rules: Mapping[str, Sequence[str]],
    since: str | None,
    now: Column | None = None,
) -> DataFrame:
    """New bridge rows: each recent assertion with each subject of its repository's rule."""
    now = F.current_timestamp() if now is None else now
    spark = assertions.sparkSession
    pairs = [(repository, title) for repository, titles in subject_rules.items() for title in dict.fromkeys(titles)]
    rule_rows = F.broadcast(spark.createDataFrame(pairs, "repository_id string, title string"))
    targets = subjects.join(rule_rows, "title").select("repository_id", F.col("id").alias("subject_id"))
    targets = broadcast_if_small({"targets": targets})["targets"]
    recent = select_recent(assertions, since).select(F.col("id").alias("assertion_id"), "repository_id")
    wanted = recent.join(targets, "repository_id").select("assertion_id", "subject_id")
    new = wanted.join(existing.select("assertion_id", "subject_id"), ["assertion_id", "subject_id"], "left_anti")
    return new.select(
        derived_id(F.lit("assertionSubject"), F.col("assertion_id"), F.col("subject_id")).alias("id"),
        F.lit("assertionSubject").alias("type"),
        now.alias("created"),
        now.alias("updated"),
        "assertion_id",
        "subject_id",
        F.lit(False).alias("inferred"),
    )


def tag_subjects(
    corpus: Corpus,
    subject_rules: Mapping[str, Sequence[str]] = rules.REPOSITORY_SUBJECTS,
    required: Sequence[str] = tuple(rules.REQUIRED_SUBJECTS),
    since: str | None = rules.CURRENT_INGEST_SINCE,
    now: Column | None = None,
    check_unique: bool = True,
) -> Corpus:
    """Lower-case the titles, check them, add the required subjects, then tag."""
    subjects = lowercase_titles(corpus.subjects)
    if check_unique:
        subjects = assert_unique(subjects, "title")
    subjects = add_subjects(subjects, required, now)
    new = expand_subject_rules(
        corpus.assertions, subjects, corpus.assertions_subjects, subject_rules, since, now
    )
    return corpus.with_tables(
        subjects=subjects,
        assertions_subjects=corpus.assertions_subjects.unionByName(new, allowMissingColumns=True),
    )
