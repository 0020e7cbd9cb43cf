"""Files in, files out."""

import csv
import gzip
import json

from pyspark.sql import functions as F

from catalog.queries import corpus_of
from linkloom import rules
from linkloom.operators.numbering import number_rows
from linkloom.plans import export, ingest, review
from linkloom.plans.accession import validate_accessions
from linkloom.plans.details import assertion_details_formatted
from linkloom.plans.papers import load_papers
from linkloom.sinks import files as sinks
from linkloom.sources import files as sources


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dump(spark, tables, tmp_path):
    corpus = corpus_of(tables, named_ends=True)
    details = assertion_details_formatted(corpus)
    out = str(tmp_path / "dump")
    numbered = export.export_dump(details, out, 400, ids=corpus.assertions.select("id"), name_template="2025-links-{nn}")
    assert (numbered.total, numbered.chunks) == (1500, 4)
    files = sorted((tmp_path / "dump" / "json").glob("*.json"))
    assert [f.name for f in files] == [f"2025-links-{n:02d}.json" for n in (1, 2, 3, 4)]
    chunks = [json.loads(f.read_text()) for f in files]
    assert [len(c) for c in chunks] == [400, 400, 400, 300]
    ids = [record["id"] for chunk in chunks for record in chunk]
    assert ids == sorted(r["id"] for r in corpus.assertions.select("id").collect())
    first = chunks[0][0]
    assert list(first) == details.columns
    assert all(isinstance(first[c], list) for c in ("affiliations", "funders", "subjects"))
    # a null object is written empty, a null field is written
    without_journal = [r for c in chunks for r in c if r["journal"] == {}]
    assert len(without_journal) == corpus.assertions.filter("journal_id is null").count()
    assert any(r["repository"].get("external_id", 0) is None for c in chunks for r in c)

    tables_read = [list(csv.reader(f.open(newline=""))) for f in sorted((tmp_path / "dump" / "csv").glob("*.csv"))]
    header = "id created updated repository publisher journal title dataset publication publishedDate source subjects affiliations affiliationsROR funders fundersROR".split()
    assert all(t[0] == header for t in tables_read)
    assert [r[0] for t in tables_read for r in t[1:]] == ids
    flat = {r["id"]: r for r in export.csv_rows(details).collect()}
    for table in tables_read:
        for line in table[1:]:
            assert line[6] == (flat[line[0]]["title"] or "")
            assert line[12] == flat[line[0]]["affiliations"]

    back = sources.read_dump(spark, f"{out}/json/*.json")
    whole = sources.read_dump(spark, f"{out}/json/*.json", record_per_line=False)
    columns = ["id", "title", "dataset", "subjects", "affiliations", "funders"]
    assert rows(back.select(*columns)) == rows(details.select(*columns)) == rows(whole.select(*columns))


def test_numbers_are_dense_and_ordered(tables):
    for partitions in (1, 3, 50):
        numbered = number_rows(tables.assertions, "id", 7, partitions)
        got = sorted((r["row_number"], r["id"], r["chunk"]) for r in numbered.rows.collect())
        assert [g[0] for g in got] == list(range(1, 1501))
        assert [g[1] for g in got] == sorted(g[1] for g in got)
        assert all(chunk == (n - 1) // 7 + 1 for n, _, chunk in got)


def test_numbering_an_empty_table(tables):
    numbered = number_rows(tables.assertions.limit(0))
    assert (numbered.total, numbered.chunks, numbered.rows.count()) == (0, 0, 0)


def test_removal_lists(spark, tmp_path):
    (tmp_path / "0a60b1a9-041a-444e-bd6a-94caaab7591b-remove.csv").write_bytes(b"id-1\r\nid-2")
    (tmp_path / "345977e0-6fb8-476e-9742-0b8987e2fce8-remove-ids.csv").write_bytes(b"id-3")
    (tmp_path / "notes.csv").write_bytes(b"id-4")
    assert rows(sources.read_removal_lists(spark, str(tmp_path))) == [
        ("id-1", "0a60b1a9-041a-444e-bd6a-94caaab7591b"),
        ("id-2", "0a60b1a9-041a-444e-bd6a-94caaab7591b"),
        ("id-3", "345977e0-6fb8-476e-9742-0b8987e2fce8"),
    ]


def test_textmined_ingest_from_files(spark, tmp_path):
    feeds = tmp_path / "feeds"
    feeds.mkdir()
    (feeds / "geo.csv").write_text('GEO,PMCID,extra\n GSE1 ,PMC1,x\n"GSE,2",PMC2\nGSE3,\n,PMC3\nGSE4,PMC9\n')
    (feeds / "doi.csv").write_text("DOI,PMCID\n10.5061/a,PMC1\n10.5061/b,PMC2\nnodoi,PMC1\n")
    (feeds / "nct.csv").write_text("NCT,PMCID\nNCT1,PMC1\n")
    (feeds / "PMID_PMCID_DOI.csv").write_text("PMID,PMCID,DOI\n1, PMC1 ,10.1/a\n1,PMC1,10.1/b\n2,PMC2,\n3,,10.1/c\n4\n")
    (tmp_path / "names.json").write_text(json.dumps({"geo": "Gene Store", "x": "X"}, indent=1))

    feed = sources.read_textmined(spark, str(feeds))
    assert rows(feed) == [
        ("doi", "10.5061/a", "PMC1"),
        ("doi", "10.5061/b", "PMC2"),
        ("doi", "nodoi", "PMC1"),
        ("geo", "GSE,2", "PMC2"),
        ("geo", "GSE1", "PMC1"),
        ("geo", "GSE4", "PMC9"),
    ]
    crosswalk = sources.read_crosswalk(spark, str(feeds / "PMID_PMCID_DOI.csv"))
    assert rows(crosswalk) == [("PMC1", "10.1/a"), ("PMC1", "10.1/b")]
    names = sources.read_name_map(spark, str(tmp_path / "names.json"))
    assert rows(names) == [("geo", "Gene Store"), ("x", "X")]
    cache = sources.read_lookup_cache(spark, str(tmp_path / "cache"))
    assert cache.isEmpty()
    fetched = spark.createDataFrame([("PMC2", "https://doi.org/10.2/z"), ("PMC3", "")], "pmcid string, doi_url string")
    sinks.materialize(ingest.merge_lookup_cache(cache, fetched), str(tmp_path / "cache"))
    cache = sources.read_lookup_cache(spark, str(tmp_path / "cache"))
    publishers = spark.createDataFrame([("10.5061/a", "Dryad")], "doi string, publisher string")
    done = ingest.ingest_textmined(feed, crosswalk, cache, publishers, names)
    assert rows(done.citations) == sorted(
        [
            ("doi", "Dryad", "10.5061/a", "https://doi.org/10.1/b"),
            ("doi", None, "10.5061/b", "https://doi.org/10.2/z"),
            ("doi", None, "nodoi", "https://doi.org/10.1/b"),
            ("geo", "Gene Store", "GSE,2", "https://doi.org/10.2/z"),
            ("geo", "Gene Store", "GSE1", "https://doi.org/10.1/b"),
        ],
        key=repr,
    )
    assert rows(done.missing) == [("PMC9", "PMC9")]
    assert rows(done.rates) == [("doi", 3, 3, 100.0), ("geo", 3, 2, 66.7)]
    sinks.write_citations(done.citations, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 5
    assert (tmp_path / "out" / "repo_code=geo").is_dir()


def test_papers_from_gzipped_lines(spark, tmp_path):
    lines = [
        '{"DOI":"10.1/a","container-title":["J","K"],"publisher":"P","published":{"date-parts":[[2020,3,7]]}}',
        '{"DOI":"10.1/a","container-title":"Old","published":{"date-parts":[[2019]]}}',
        '{"DOI":"10.1/b"}',
        '{"publisher":"no doi"}',
        '{"DOI": null}',
        '{"DOI": "10.1/broken',
        "",
    ]
    with gzip.open(tmp_path / "part.jsonl.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    papers, bad = sources.read_papers_jsonl(spark, str(tmp_path))
    assert papers.count() == 3
    assert rows(bad) == [("",), ('{"DOI": "10.1/broken',)]
    loaded = load_papers(spark.read.text(str(tmp_path)))
    assert rows(loaded) == [("10.1/a", "J", "P", "2020-03-07"), ("10.1/b", "", "", "")]


def test_review_csv(spark, tmp_path):
    header = "Dataset, Match 1 Name,Match 1 ID,Match 1 Chosen,Match 2 Name,Match 2 ID,Match 2 Chosen,Match 3 Name,Match 3 ID,Match 3 Chosen\n"
    body = [
        '10.1/a, "Org, A",r1,TRUE,B,r2,FALSE,C,r3,FALSE',
        "10.1/b,A,r1,FALSE,B,r2,FALSE,C,r3,false",
        "10.1/c,A,r1,TRUE,B,r2,true ,C,r3,FALSE",
        "10.1/d,A,r1,FALSE,B,r2,FALSE,C,r3,",
    ]
    (tmp_path / "review.csv").write_text(header + "\n".join(body) + "\n")
    df = sources.read_review_csv(spark, str(tmp_path / "review.csv"))
    assert "Match 1 Name" in df.columns
    classified = review.classify_matches(df)
    assert [r["bucket"] for r in classified.orderBy("Dataset").collect()] == [
        "exactly_one_true",
        "all_false",
        "more_than_one_true",
        None,
    ]
    assert rows(review.bucket_summary(classified)) == [(4, 1, 1, 1, 1)]
    assert rows(review.chosen_matches(df)) == [("10.1/a", "r1", "Org, A"), ("10.1/c", "r1", "A")]
    sinks.write_buckets(classified, str(tmp_path / "buckets"))
    assert spark.read.csv(str(tmp_path / "buckets"), header=True).count() == 3


def test_citation_report_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        'Article DOI,Some References\n10.1029/a,"[""10.1/x"", ""10.1/y""]"\n10.1029/b,[]\n10.1029/c,\n'
    )
    assert rows(sources.read_citation_report(spark, str(tmp_path))) == [
        ("10.1029/a", ["10.1/x", "10.1/y"]),
        ("10.1029/b", []),
        ("10.1029/c", []),
    ]


def test_separators_of_a_csv_dump(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,affiliations,funders\n1,"A ;B",\n2,,"C ;D"\n')
    export.rewrite_separators(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"))
    got = spark.read.csv(str(tmp_path / "out"), header=True)
    assert rows(got) == [("1", "A;B", None), ("2", None, "C;D")]


def test_corpus_round_trip_and_bucketed_tables(spark, tables, tmp_path):
    corpus = corpus_of(tables)
    sinks.save_corpus(corpus, str(tmp_path / "corpus"))
    loaded = sources.load_corpus(spark, str(tmp_path / "corpus"))
    assert {n: t.count() for n, t in loaded.tables().items()} == {n: t.count() for n, t in corpus.tables().items()}
    sinks.save_bucketed(loaded, 4)
    stored = sources.load_corpus(spark, reader=spark.table)
    assert stored.assertions.count() == corpus.assertions.count()


def test_table_view_and_partitioned_sinks(spark, tables, tmp_path):
    corpus = corpus_of(tables)
    sinks.save_table(corpus.sources, "kept_sources")
    sinks.register_view(corpus.sources, "seen_sources")
    assert rows(spark.table("kept_sources")) == rows(spark.table("seen_sources"))
    report = validate_accessions(corpus, {"repo-0": r"^GSE\d+$", "repo-3": "^x$"}, "src-1")
    sinks.write_validation(report, str(tmp_path / "validation"))
    assert spark.read.csv(str(tmp_path / "validation"), header=True).count() == report.count()


def test_report_sinks(spark, tables, tmp_path):
    from linkloom.plans import compare, reconcile

    orgs = reconcile.unresolved_orgs(tables.affiliations, tables.funders).limit(20)
    candidates = reconcile.candidate_report(orgs, tables.registry)
    sinks.write_candidates(candidates, str(tmp_path / "candidates"))
    read = spark.read.csv(str(tmp_path / "candidates"), header=True)
    assert read.count() == 20 and read.columns == [c for c in candidates.columns if c != "id"]

    cited = tables.report_pairs.groupBy("article_doi").agg(F.collect_list("dataset_doi").alias("cited")).limit(30)
    for name, made in [
        ("both", compare.compare_citations(cited, tables.event_links)),
        ("missing", compare.missing_citations(cited, tables.event_links)),
    ]:
        sinks.write_comparison(made, str(tmp_path / name), {"reported": "Cited"})
        read = spark.read.csv(str(tmp_path / name), header=True)
        assert read.count() == 30 and read.columns[:2] == ["Article DOI", "Cited"]
        assert len(set(read.columns)) == len(made.columns)


def test_default_rules_meet_rows(tables):
    from catalog.rule_queries import ruled_corpus

    report = validate_accessions(ruled_corpus(tables))
    seen = {(r[0], r[1]) for r in report.select("repository_id", "accession_number_pattern_match").distinct().collect()}
    assert {pair for pair in seen if pair[1] is not None} == {(repository, fits) for repository in rules.ACCESSION_PATTERNS for fits in (True, False)}
    assert set(rules.ACCESSION_PATTERNS) - set(rules.REPOSITORY_SUBJECTS) == set()


def test_dump_is_one_file_a_chunk_whatever_the_session_says(spark, tables, conf, tmp_path):
    conf(spark__sql__files__maxRecordsPerFile="150")
    corpus = corpus_of(tables, named_ends=True)
    details = assertion_details_formatted(corpus)
    out = tmp_path / "dump"
    export.export_dump(details, str(out), 400, ids=corpus.assertions.select("id"), name_template="links-{nn}")
    chunks = [json.loads(f.read_text()) for f in sorted((out / "json").glob("*.json"))]
    assert [len(c) for c in chunks] == [400, 400, 400, 300]
    lines = [len(list(csv.reader(f.open(newline="")))) for f in sorted((out / "csv").glob("*.csv"))]
    assert lines == [401, 401, 401, 301]


def test_a_failing_dump_leaves_the_old_one(spark, tables, tmp_path):
    """Files are named by the tasks and appear together; a failure in one chunk changes nothing."""
    import pytest

    numbered = number_rows(tables.assertions, "id", 400)
    folder = tmp_path / "out" / "json"
    sinks.write_json_chunks(numbered.rows, numbered, str(folder), 400, "first-{nn}")
    names = [f"first-{n:02d}.json" for n in (1, 2, 3, 4)]
    assert sorted(f.name for f in folder.iterdir()) == names
    broken = numbered.rows.withColumn("id", F.when(F.col("row_number") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_json_chunks(broken, numbered, str(folder), 400, "second-{nn}")
    with pytest.raises(Exception, match="3 files of 4"):
        sinks.write_json_chunks(numbered.rows.filter("chunk <> 2"), numbered, str(folder), 400, "second-{nn}")
    with pytest.raises(ValueError):
        sinks.write_json_chunks(numbered.rows, numbered, str(folder), 400, "same")
    assert sorted(f.name for f in folder.iterdir()) == names and [f.name for f in folder.parent.iterdir()] == ["json"]
    sinks.write_csv_chunks(numbered.rows, numbered, str(folder), "third-{nn}")
    assert sorted(f.name for f in folder.iterdir()) == [f"third-{n:02d}.csv" for n in (1, 2, 3, 4)]
    assert [f.name for f in folder.parent.iterdir()] == ["json"]
    nothing = number_rows(tables.assertions.limit(0), "id", 400)
    sinks.write_json_chunks(nothing.rows, nothing, str(folder), 400, "none-{nn}")
    assert list(folder.iterdir()) == []


def test_dump_shuffles_nested_rows_once(spark, tables, tmp_path):
    """Both forms are written from rows laid out by chunk once."""
    from tests.test_plans import plan

    corpus = corpus_of(tables, named_ends=True)
    numbered = number_rows(corpus.assertions, "id", 400)
    rows = sinks.one_task_per_chunk(export.with_chunks(assertion_details_formatted(corpus), numbered), numbered).persist()
    for form in (sinks.json_lines(rows, numbered, 400), export.csv_rows(rows)):
        above = plan(form).split("InMemoryRelation")[0]
        assert "InMemoryTableScan" in above and "Exchange" not in above and "Sort" not in above
    rows.unpersist()


def test_numbering_rejects_keys_that_are_missing_or_repeat(spark):
    import pytest

    for keys in (["a", None, "b"], ["a", "b", "a"]):
        with pytest.raises(ValueError):
            number_rows(spark.createDataFrame([(k,) for k in keys], "id string"), "id", 2)


def test_line_breaks_inside_quoted_fields(spark, tmp_path):
    (tmp_path / "geo.csv").write_text('GEO,PMCID\n"GSE1\nx",PMC1\nGSE2,PMC2\n')
    assert rows(sources.read_textmined(spark, str(tmp_path))) == [("geo", "GSE1\nx", "PMC1"), ("geo", "GSE2", "PMC2")]
    (tmp_path / "PMID_PMCID_DOI.csv").write_text('PMID,PMCID,DOI\n"1\n",PMC1,10.1/a\n')
    assert rows(sources.read_crosswalk(spark, str(tmp_path / "PMID_PMCID_DOI.csv"))) == [("PMC1", "10.1/a")]


def test_odd_paper_records_are_kept(spark, tmp_path):
    lines = {
        '{"DOI":"10.1/a","published":[]}': "",
        '{"DOI":"10.1/b","published":{"date-parts":[["2020"]]}}': "2020",
        '{"DOI":"10.1/c","published":{"date-parts":[["2020","3",7]]}}': "2020-03-07",
        '{"DOI":"10.1/d","published":{"date-parts":[[2020,"May",7]]}}': "2020",
        '{"DOI":"10.1/e","published":"2020","publisher":["P"],"container-title":{"x":1}}': "",
        '{"DOI":"10.1/f","published":{"date-parts":"2020","date-time":null}}': "",
        '{"DOI":"10.1/g","published":{"date-parts":[2020]}}': "",
    }
    (tmp_path / "x.jsonl").write_text("\n".join([*lines, "[]", "7", "{"]) + "\n")
    papers, bad = sources.read_papers_jsonl(spark, str(tmp_path))
    assert [r["published_date"] for r in papers.orderBy("doi").collect()] == list(lines.values())
    assert rows(bad) == [("7",), ("[]",), ("{",)]
    assert rows(sources.count_bad_lines_of(spark, str(tmp_path))) == [("x.jsonl", 3)]


def test_each_chunk_is_one_task(spark, tables):
    numbered = number_rows(tables.assertions, "id", 100)
    placed = sinks.one_task_per_chunk(numbered.rows, numbered)
    per_task = placed.groupBy(F.spark_partition_id().alias("task")).agg(F.collect_set("chunk").alias("chunks")).collect()
    assert sorted((r["task"] + 1, r["chunks"]) for r in per_task) == [(n, [n]) for n in range(1, 16)]


def test_paper_store(spark, tmp_path):
    from linkloom.plans.paper_store import import_papers
    from linkloom.plans.papers import search_papers
    from tests.test_plans import plan

    first, second = tmp_path / "one", tmp_path / "two"
    for folder, lines in [
        (first, ['{"DOI":"10.1/a","publisher":"Old"}', '{"DOI":"10.1/b","publisher":"B"}']),
        (second, ['{"DOI":"10.1/a","publisher":"New"}', "not json"]),
    ]:
        folder.mkdir()
        (folder / "x.jsonl").write_text("\n".join(lines))
    none, old, new = (str(tmp_path / n) for n in ("none", "v1", "v2"))
    import_papers(spark, str(first), none, old)
    stored, bad = import_papers(spark, str(second), old, new)
    assert rows(stored.select("doi", "publisher")) == [("10.1/a", "New"), ("10.1/b", "B")]
    assert rows(bad) == [("not json",)]
    assert "EqualTo(doi,10.1/a)" in plan(search_papers(stored, doi="10.1/a"), "formatted")


def test_registry_and_conforming_tables(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"ror_id":"r","name":"N","aliases":["A"],"external_ids":["grid.1"],"x":1}\n')
    assert rows(sources.read_registry(spark, str(tmp_path / "r.json"))) == [("r", "N", ["A"], ["grid.1"])]
    from linkloom import schemas

    raw = spark.createDataFrame([(1, "t", "more")], "id int, title string, extra string")
    done = sources.conform(raw, schemas.NAMED)
    assert done.columns == ["id", "title", "external_id", "extra"]
    assert rows(done) == [("1", "t", None, "more")]
