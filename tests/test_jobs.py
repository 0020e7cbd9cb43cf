"""Small literal cases for the jobs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog.queries import corpus_of
from linkloom import rules
from linkloom.functions.identifiers import derived_id
from linkloom.plans import clean_orgs, compare, details, ingest, papers, reconcile, review, summaries, tag_subjects
from linkloom.operators.updates import add_dataset_publication, merge_repositories, update_from


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)


EVENTS = "subj_id string, obj_id string, relation_type_id string"
REPORT = "article_doi string, cited array<string>"


@pytest.mark.parametrize(
    "cited, events, same, difference",
    [
        ([], [], True, 0),
        (["10.1/x"], [], False, 1),
        (["10.1/X"], [("https://doi.org/10.9/a", "https://doi.org/10.1/x", "cites")], True, 0),
        (["10.1/x"], [("10.9/A", "10.1/y", "cites")], False, 0),
        # the other direction counts, relations that are no citation do not
        (["10.1/x"], [("10.1/x", "10.9/a", "is-cited-by"), ("10.9/a", "10.1/z", "is-part-of")], True, 0),
        # contained in one another is enough
        (["0.1/x"], [("10.9/a", "10.1/x", "cites")], False, 0),
        (["10.1/x", "10.1/y"], [("10.9/a", "10.1/x", "cites"), ("10.1/y", "10.9/a", "cites")], True, 0),
        # of the same length and one entry in common, yet not the same
        (["10.1/x", "10.1/x"], [("10.9/a", "10.1/x", "cites"), ("10.9/a", "10.1/y", "cites")], False, 0),
    ],
)
def test_compare_citations(spark, cited, events, same, difference):
    report = spark.createDataFrame([("10.9/a", cited)], REPORT)
    out = compare.compare_citations(report, spark.createDataFrame(events, EVENTS)).first()
    assert (out["same"], out["count_difference"]) == (same, difference)
    assert out["reported_count"] == len(cited)


def test_compare_lists_what_the_article_cites_first(spark):
    report = spark.createDataFrame([("10.9/a", ["10.1/z", "10.1/q"])], REPORT)
    events = [("10.1/a", "10.9/a", "cites"), ("10.9/a", "10.1/z", "cites"), ("10.1/z", "10.9/a", "cites")]
    out = compare.compare_citations(report, spark.createDataFrame(events, EVENTS)).first()
    assert out["events"] == "10.1/z,10.1/a"
    assert (out["only_reported"], out["only_events"]) == ("10.1/q", "10.1/a")


def test_missing_citations(spark):
    report = spark.createDataFrame(
        [("10.9/a", ["10.1/z", "10.1/x", "10.1/x"]), ("10.9/b", []), ("10.9/a", ["10.1/z", "10.1/x", "10.1/x"])], REPORT
    )
    events = spark.createDataFrame([("https://doi.org/10.9/A", "10.1/z", "cites"), ("10.1/x", "10.9/a", "cites")], EVENTS)
    assert rows(compare.missing_citations(report, events)) == [
        ("10.9/a", "10.1/z, 10.1/x, 10.1/x", 3, "10.1/x, 10.1/x", 2, 1),
        ("10.9/b", "", 0, "", 0, 0),
    ]
    pairs = spark.createDataFrame([("10.9/a", "10.1/z"), ("10.9/a", "10.1/x")], "article_doi string, dataset_doi string")
    assert rows(compare.in_events(pairs, events)) == [("10.9/a", "10.1/z")]
    assert rows(compare.in_events(pairs, events, present=False)) == [("10.9/a", "10.1/x")]


REVIEW = "Dataset string, " + ", ".join(
    f"`Match {i} Name` string, `Match {i} ID` string, `Match {i} Chosen` string" for i in (1, 2, 3)
)
UUID = "00363b65-f3ef-4fa9-8255-23ab269f4930"


def test_links_of_chosen_affiliations(spark):
    chosen = [
        (" 10.1/d ", "Known", "r1", "TRUE", "x", "x", "FALSE", "x", "x", "FALSE"),
        (UUID, "New", "r3", "FALSE", "New", "r2", " true", "x", "x", "TRUE"),
        ("10.1/none", "New", "r9", "TRUE", "x", "x", "FALSE", "x", "x", "FALSE"),
        ("10.1/d", None, "r1", "TRUE", "x", "x", "FALSE", "x", "x", "FALSE"),
        ("10.1/d", "Known", "r1", "FALSE", "x", "x", "FALSE", "x", "x", None),
    ]
    table = spark.createDataFrame(chosen, REVIEW)
    affiliations = spark.createDataFrame([("f1", "Known"), ("f2", "Known"), ("f0", "Other")], "id string, title string")
    assertions = spark.createDataFrame(
        [("a1", "10.1/d"), ("a2", "10.1/d"), ("a3", "10.1/d"), (UUID, "10.1/e")], "id string, dataset string"
    )
    bridge = spark.createDataFrame(
        [("b", "a1", "f0", "t")], "id string, assertion_id string, affiliation_id string, type string"
    )
    linked = review.link_chosen_affiliations(table, affiliations, assertions, bridge)
    new_id = spark.range(1).select(derived_id(F.lit("affiliation"), F.lit("New"))).first()[0]
    assert rows(linked.new_affiliations) == [(new_id, "New", "r2", "affiliation")]
    assert rows(linked.new_links, "assertion_id", "affiliation_id") == [
        (UUID, new_id),
        ("a2", "f2"),
        ("a3", "f2"),
    ]
    assert linked.bridge.count() == 4 and linked.affiliations.count() == 4
    literal = review.link_chosen_affiliations(table, affiliations, assertions, bridge, compat=True)
    assert rows(literal.new_links, "assertion_id", "affiliation_id") == [(UUID, new_id), ("a3", "f2")]


ORGS = "id string, title string, external_id string, ror_id string, ror_name string, created timestamp"
OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2025, 8, 1)
REGISTRY = [
    ("https://ror.org/01aaaaa11", "Alpha", ["A Lab"], ["grid.1.1", "0000000100"]),
    ("https://ror.org/02bbbbb22", "Beta", ["Shared"], ["501", "0000000100"]),
    ("https://ror.org/03ccccc33", "Gamma", ["shared"], []),
]


def test_reconcile(spark):
    orgs = spark.createDataFrame(
        [
            ("by ror", None, "01aaaaa11", None, None, NEW),
            ("by grid", None, "grid.1.1", None, None, NEW),
            ("lowest of two", None, "0000 0001 00", None, None, NEW),
            ("by funder doi", None, "10.13039/501", None, None, NEW),
            ("by title", "ALPHA!", None, None, None, NEW),
            ("by alias", "a lab", "", None, None, NEW),
            ("ambiguous", "Shared", None, None, None, NEW),
            ("second pass", "Gamma", "grid.9.9", None, None, NEW),
            ("invalid id", "Gamma", " N/A ", None, None, NEW),
            ("known", "Beta", "grid.1.1", "kept", "Kept", NEW),
            ("name only", "Beta", "grid.1.1", None, "Kept", NEW),
            ("name only, no id", "Beta", None, None, "Kept", NEW),
            ("old", "Alpha", "grid.1.1", None, None, OLD),
        ],
        ORGS,
    )
    registry = spark.createDataFrame(
        REGISTRY, "ror_id string, name string, aliases array<string>, external_ids array<string>"
    )
    a, b, c = (r[0] for r in REGISTRY)
    isni = "http://isni.org/isni/0000000100"
    expected = {
        "by ror": (a, a, "Alpha"),
        "by grid": ("https://www.grid.ac/grid.1.1", a, "Alpha"),
        "lowest of two": (isni, a, "Alpha"),
        "by funder doi": ("https://doi.org/10.13039/501", b, "Beta"),
        "by title": (None, a, "Alpha"),
        "by alias": ("", a, "Alpha"),
        "ambiguous": (None, None, None),
        "second pass": ("https://www.grid.ac/grid.9.9", c, "Gamma"),
        "invalid id": (None, c, "Gamma"),
        "known": ("grid.1.1", "kept", "Kept"),
        "name only": ("grid.1.1", b, "Beta"),
        "name only, no id": (None, None, "Kept"),
        "old": ("grid.1.1", None, None),
    }
    done = reconcile.reconcile_orgs(orgs, registry, ["N/A"], since="2025-07-01")
    assert done.columns == orgs.columns
    assert {r["id"]: (r["external_id"], r["ror_id"], r["ror_name"]) for r in done.collect()} == expected
    everything = reconcile.reconcile_orgs(orgs, registry, ["N/A"])
    assert everything.filter("id = 'old'").first()["ror_id"] == a


def test_reconcile_adds_missing_columns(spark):
    orgs = spark.createDataFrame([("1", "Alpha", None)], "id string, title string, external_id string")
    registry = spark.createDataFrame(
        REGISTRY, "ror_id string, name string, aliases array<string>, external_ids array<string>"
    )
    done = reconcile.reconcile_orgs(orgs, registry)
    assert rows(done) == [("1", "Alpha", None, REGISTRY[0][0], "Alpha")]


def test_tagging_is_idempotent_and_checks_titles(tables):
    corpus = corpus_of(tables)
    subject_rules = {"repo-1": ["economy", "basic medicine"], "repo-2": ["economy"]}
    once = tag_subjects.tag_subjects(corpus, subject_rules, since=None)
    twice = tag_subjects.tag_subjects(once, subject_rules, since=None)
    assert rows(once.assertions_subjects, "id") == rows(twice.assertions_subjects, "id")
    assert rows(once.subjects, "id", "title") == rows(twice.subjects, "id", "title")
    doubled = corpus.with_tables(subjects=corpus.subjects.unionByName(corpus.subjects.withColumn("id", F.lit("other"))))
    with pytest.raises(ValueError):
        tag_subjects.tag_subjects(doubled, subject_rules)


def test_default_tagging_rules_touch_no_foreign_repository(tables):
    corpus = corpus_of(tables)
    tagged = tag_subjects.tag_subjects(corpus)
    assert tagged.assertions_subjects.count() == corpus.assertions_subjects.count()
    titles = {r["title"] for r in tagged.subjects.collect()}
    assert set(rules.REQUIRED_SUBJECTS) <= titles


def test_clean_orgs_job(tables):
    corpus = corpus_of(tables)
    cleaned = clean_orgs.clean_orgs(corpus, ["aff-000001"])
    left = {r["id"]: r["title"] for r in cleaned.affiliations.collect()}
    assert "aff-000000" not in left and "aff-000001" not in left
    assert left["aff-000002"] == "Dept 2" and left["aff-000003"] == "Lab 3" and left["aff-000004"] == "Centre 4"
    assert left["aff-000008"] is None
    gone = cleaned.assertions_affiliations.filter(F.col("affiliation_id").isin("aff-000000", "aff-000001"))
    assert gone.isEmpty()


def test_ends_by_source_type(spark):
    df = spark.createDataFrame(
        [(rules.SUBJECT_IS_DATASET_SOURCE, "s", "o"), (None, "s", "o"), ("crossref", "s", "o"), ("x", "s", "o")],
        "source_type string, subj_id string, obj_id string",
    )
    out = {r["source_type"]: (r["dataset"], r["publication"]) for r in add_dataset_publication(df).collect()}
    assert out == {
        rules.SUBJECT_IS_DATASET_SOURCE: ("s", "o"),
        None: ("s", "o"),
        "crossref": ("o", "s"),
        "x": (None, None),
    }


def test_merge_and_update(spark):
    old, new = next(iter(rules.MERGED_REPOSITORIES.items()))
    facts = spark.createDataFrame([("1", old), ("2", None), ("3", "r")], "id string, repository_id string")
    dim = spark.createDataFrame([(old,), (new,)], "id string")
    merged, kept = merge_repositories(facts, dim)
    assert rows(merged) == [("1", new), ("2", None), ("3", "r")]
    assert rows(kept) == [(new,)]
    updates = spark.createDataFrame([("1", None), ("3", "z")], "id string, repository_id string")
    assert rows(update_from(facts, updates, "id", ["repository_id"])) == [("1", None), ("2", None), ("3", "z")]


def test_details_shape(tables):
    corpus = corpus_of(tables, named_ends=True)
    done = details.assertion_details_formatted(corpus)
    assert done.filter("affiliations is null or funders is null or subjects is null").isEmpty()
    assert done.count() == corpus.assertions.count()
    with_nulls = details.assertion_details(corpus)
    # the view form keeps untitled affiliations, the dump does so only when they have an id
    count = F.sum(F.size("affiliations"))
    assert with_nulls.agg(count).first()[0] >= done.agg(count).first()[0]


def test_search_and_stats(spark):
    table = spark.createDataFrame(
        [("1", "J", "P", "2020-01"), ("2", "J", "Q", "2021"), ("3", "K", "Q", ""), ("4", "K", "", "2020")],
        "doi string, journal string, publisher string, published_date string",
    )
    assert rows(papers.search_papers(table, year=2020), "doi") == [("1",), ("4",)]
    assert rows(papers.search_papers(table, doi="2", publisher="Q"), "doi") == [("2",)]
    stats = papers.paper_stats(table)
    assert [tuple(r) for r in stats.collect()] == [("Q", 2, 4), ("P", 1, 4)]


def test_publisher_lookup_is_per_row(spark):
    df = spark.createDataFrame(
        [("doi", "10.1/a"), ("doi", "10.1/b"), ("doi", "x"), ("geo", "10.1/a")], "repository string, dataset string"
    )
    known = spark.createDataFrame([("10.1/a", "P")], "doi string, publisher string")
    assert rows(ingest.lookup_publisher(df, known), "repository", "dataset") == sorted(
        [("P", "10.1/a"), (None, "10.1/b"), (None, "x"), ("geo", "10.1/a")], key=repr
    )


def test_growth_total_is_the_row_count(tables):
    growth = summaries.growth_per_day(tables.assertions)
    assert growth.agg(F.max("total")).first()[0] == tables.assertions.count()


def test_loose_equality_equals_brute_force(spark):
    import random

    rng = random.Random(7)
    pool = ["10.1/a", "10.1/ab", "10.1/abc", "0.1/a", "10.2/X", "10.2/x"]
    cases = []
    for _ in range(400):
        size = rng.randint(0, 3)
        reported = [rng.choice(pool) for _ in range(size)]
        events = [rng.choice(["", "https://doi.org/"]) + rng.choice(pool) for _ in range(rng.choice([size, size, 2]))]
        cases.append((reported, events))

    def expected(reported, events):
        left = [r.lower() for r in reported]
        right = [e.lower().removeprefix("https://doi.org/") for e in events]
        if len(left) != len(right):
            return False
        return all(any(r in e for e in right) for r in left) and all(any(e in r for r in left) for e in right)

    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, r array<string>, e array<string>")
    got = [x[1] for x in sorted(df.select("i", compare.same_citations(F.col("r"), F.col("e"))).collect())]
    want = [expected(*c) for c in cases]
    assert got == want and any(want) and not all(want)


def test_dedup_equals_brute_force(spark):
    import random

    from linkloom.operators.dedup import dedup_latest

    rng = random.Random(3)
    data = [
        (f"{i:04d}", rng.choice(["a", "b", None]), rng.choice(["x", None]), rng.choice([None, 1, 2, 3]))
        for i in range(300)
    ]
    best = {}
    for row in data:
        rank = (0 if row[3] is None else 1, -(row[3] or 0), row[0])
        if row[1:3] not in best or rank < best[row[1:3]][0]:
            best[row[1:3]] = (rank, row[0])
    df = spark.createDataFrame(data, "id string, k string, l string, updated int")
    assert sorted(r["id"] for r in dedup_latest(df, ["k", "l"]).collect()) == sorted(b[1] for b in best.values())


def test_unmatched_lines_equal_the_column_form(spark):
    """Lists of short and long entries that often lie within each other, ties and nulls included."""
    import random

    rng = random.Random(4)

    def entry():
        return None if rng.random() < 0.02 else "".join(rng.choice("ab1.") for _ in range(rng.choice((1, 3, 4, 5, 6, 9, 14))))

    lists = []
    for i in range(300):
        left = [entry() for _ in range(rng.randint(0, 6))]
        right = [x if x is None or rng.random() < 0.3 else rng.choice(("", "a")) + x + rng.choice(("", "b1")) for x in left]
        lists.append((i, left, [entry() if rng.random() < 0.05 else x for x in right]))
    df = spark.createDataFrame(lists, "line long, left array<string>, right array<string>")
    want = set()
    for i, left, right in lists:
        for mine, other in ((left, right), (right, left)):
            if any(x not in other and not any(x is not None and y is not None and x in y for y in other) for x in mine):
                want.add(i)
    assert want and len(want) < 300
    assert {r.line for r in compare.unmatched_lines(df).collect()} == want


def test_long_lists_are_compared_in_proportion(spark):
    """Thirty thousand entries a side that differ from all of the other side, in one line."""
    n = 30_000
    lists = spark.range(n).agg(
        F.collect_list(F.format_string("10.1029/a%07d", "id")).alias("left"),
        F.collect_list(F.format_string("10.1029/a%07d.v2", "id")).alias("right"),
    ).withColumn("line", F.lit(1))
    assert compare.unmatched_lines(lists).collect()[0].line == 1  # the longer ones lie in none of the shorter
    same = lists.select("line", "left", F.array_union(F.slice("right", 1, n - 1), F.array(F.lit("x10.1029/a0029999"))).alias("right"))
    one_way = same.select("line", "left", F.array_union("left", "right").alias("right"))
    assert compare.unmatched_lines(one_way.select("line", F.col("left"), F.col("left").alias("right"))).isEmpty()
    found = compare.unmatched_lines(same).count()
    assert found == 1
