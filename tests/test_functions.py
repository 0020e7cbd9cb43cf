"""Literal input, literal output."""

import pytest
from pyspark.sql import functions as F

from linkloom.functions import identifiers as ids
from linkloom.functions import labels, titles
from linkloom.functions.papers import journal_name, publication_date
from linkloom.schemas import ORGANISATION_REF, PAPER_RECORD
from linkloom.sources.files import citation_list


def evaluate(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").select("out").collect()]


@pytest.mark.parametrize(
    "function, cases",
    [
        (
            ids.normalize_doi,
            {
                "doi.org/10.1/a": "https://doi.org/10.1/a",
                "10.1/a": "https://doi.org/10.1/a",
                "//doi.org/10.1/a": "https://doi.org/10.1/a",
                "https://doi.org/10.1/a": "https://doi.org/10.1/a",
                "GSE1": "GSE1",
                "": None,
                None: None,
                " 10.1/a ": "https://doi.org/10.1/a",
                " \t10.1/a　": "https://doi.org/10.1/a",
                " ": "",
            },
        ),
        (ids.doi_to_url, {"10.1/a": "https://doi.org/10.1/a", "doi:10.1/a": "doi:10.1/a"}),
        (
            ids.normalize_external_id,
            {
                "grid.5.1": "https://www.grid.ac/grid.5.1",
                "0000 0001 2345 6789": "http://isni.org/isni/0000000123456789",
                "10.13039/1": "https://doi.org/10.13039/1",
                "01abcde23": "https://ror.org/01abcde23",
                " 01abcde23": "https://ror.org/01abcde23",
                "01abcde234": "01abcde234",
                "000012345": "http://isni.org/isni/000012345",
                "http://isni.org/0000000123456789": "http://isni.org/isni/0000000123456789",
                "http://isni.org/isni/1": "http://isni.org/isni/1",
                "https://ror.org/01abcde23": "https://ror.org/01abcde23",
                "https://doi.org/10.13039/1": "https://doi.org/10.13039/1",
                "N/A": "N/A",
                None: None,
            },
        ),
        (
            lambda c: ids.normalize_external_id(c, compat=True),
            {
                "http://isni.org/isni/1": "http://isni.org/isni/isni/1",
                "0000 0001": "http://isni.org/isni/00000001",
            },
        ),
        (
            ids.external_id_search_key,
            {
                "https://www.grid.ac/grid.5.1": "grid.5.1",
                "http://isni.org/isni/00001": "00001",
                "https://doi.org/10.13039/1": "1",
                "https://ror.org/01abcde23": "https://ror.org/01abcde23",
                "a/b": "a/b",
            },
        ),
        (ids.last_segment, {"https://x.org/a/b": "b", "plain": "plain"}),
        (ids.with_pmc_prefix, {"PMC1": "PMC1", "1": "PMC1"}),
        (ids.doi_key, {"https://doi.org/10.1/A": "10.1/a", "10.1/a": "10.1/a"}),
        (
            ids.is_uuid,
            {
                "00363b65-f3ef-4fa9-8255-23ab269f4930": True,
                "00363B65-F3EF-4FA9-8255-23AB269F4930": True,
                "00363b65f3ef4fa9825523ab269f4930": False,
                "10.1/a": False,
            },
        ),
        (titles.is_handles_only, {"@a / @b": True, "@a/@b": True, "@a b": False, "@": False, "a @b": False}),
        (titles.remove_emails, {"Inst, a.b@x.org": "Inst, ", "a@b.co c@d.org": " ", "no mail": "no mail", "@x": "@x"}),
        (titles.remove_contact_labels, {"E‐mail: x": " x", "Electronic address: y": " y", "E-mail: z": "z"}),
        (titles.unwrap_parentheses, {"(Lab 1)": "Lab 1", "(A) and (B)": "A) and (B", "(a": "(a", "(a\nb)": "a\nb"}),
        (titles.clean_leading, {"..; Centre  4": "Centre 4", "Centre  4": "Centre  4"}),
        (titles.clean_trailing, {"Recherche  5 ., ": "Recherche 5", "a  b": "a  b", "...": ""}),
        (titles.clean_either_end, {" National Foundation": "National Foundation", "; a ;": "a ;", "a ;": "a"}),
        (
            lambda c: titles.clean_either_end(c, compat=True),
            {" National Foundation": "National Foundatio"},
        ),
        (titles.clean_remaining_email_titles, {" a@b.co": "a@b.co", " plain": " plain"}),
        (titles.fix_separator, {"A ;B": "A;B"}),
        (titles.name_key, {"  The  X-Lab, Inc. ": "the x lab inc", "..": None, "Universität": "universität"}),
        (journal_name, {'["J","K"]': "J", "S": "S", "[]": "", None: "", "[draft]": "[draft]", "[null]": ""}),
        (citation_list, {'["10.1/a", "10.1/b"]': ["10.1/a", "10.1/b"], "[]": [], "": [], '[ "x",, ]': ["x"]}),
    ],
)
def test_literal_cases(spark, function, cases):
    assert evaluate(spark, function, list(cases)) == list(cases.values())


def test_normalisation_is_idempotent(spark):
    for function in (ids.normalize_doi, ids.normalize_external_id):
        values = ["10.1/a", "grid.1", "0000 1", "01abcde23", "http://isni.org/1", "//doi.org/10.1", "x"]
        once = evaluate(spark, function, values)
        assert evaluate(spark, function, once) == once


def test_accession_patterns(spark):
    uniprot, ontology = "58d689da-7c8c-4ac1-90c9-69253d28f81f", "e387c003-d7e5-455d-b7b0-544e9251b1d0"
    rows = [
        (uniprot, "P12345", True, True),
        (uniprot, "x P12345", False, False),
        (ontology, "GO:0000001", True, False),
        (ontology, None, None, None),
        ("unknown", "P12345", None, None),
        ("54753603-c263-4cc0-bd65-57c39b5a20f6", "ENSG00000000001", True, False),
        ("19ad31a7-e6d0-4547-ad14-1201d3c96dca", "PF00001", True, True),
    ]
    df = spark.createDataFrame(rows, "r string, a string, plain boolean, compat boolean")
    out = df.select(
        "plain",
        "compat",
        ids.accession_matches(F.col("r"), F.col("a"), ids.accession_patterns()).alias("p"),
        ids.accession_matches(F.col("r"), F.col("a"), ids.accession_patterns(compat=True)).alias("c"),
    ).collect()
    assert [(r.p, r.c) for r in out] == [(r.plain, r.compat) for r in out]


def test_derived_id_is_stable_and_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", "-"), ("a", "")], "x string, y string")
    made = [r[0] for r in df.select(ids.derived_id(F.col("x"), F.col("y"))).collect()]
    assert len(set(made)) == 3
    assert made == [r[0] for r in df.select(ids.derived_id(F.col("x"), F.col("y"))).collect()]
    assert all(evaluate(spark, ids.is_uuid, made))


@pytest.mark.parametrize(
    "json, expected",
    [
        ('{"published":{"date-parts":[[2020,3,7]]}}', "2020-03-07"),
        ('{"published":{"date-parts":[[2020,3]]}}', "2020-03"),
        ('{"published":{"date-parts":[[2020]]}}', "2020"),
        ('{"published":{"date-parts":[[]]}}', ""),
        ('{"published":{"date-parts":[[null]]}}', ""),
        ('{"published":{"date-time":"2020-01-01T00:00:00Z","date-parts":[[1999]]}}', "2020-01-01T00:00:00Z"),
        ("{}", ""),
    ],
)
def test_publication_date(spark, json, expected):
    df = spark.createDataFrame([(json,)], "v string").select(F.from_json("v", PAPER_RECORD).alias("r"))
    assert df.select(publication_date(F.col("r.published"))).first()[0] == expected


def test_publication_date_compat(spark):
    df = spark.createDataFrame([('{"published":{"date-parts":[[null]]}}',)], "v string")
    df = df.select(F.from_json("v", PAPER_RECORD).alias("r"))
    assert df.select(publication_date(F.col("r.published"), compat=True)).first()[0] == "None"


def test_labels(spark):
    rows = [
        ({"title": "T", "external_id": "e", "ror_name": "N", "ror_id": "R"}, "T e", "N R", "T e", "N R"),
        ({"title": "T", "external_id": "", "ror_name": None, "ror_id": None}, "T", "", "T", "None None"),
        ({"title": None, "external_id": "e", "ror_name": "N", "ror_id": None}, "e", "N", "None e", "N None"),
    ]
    for ref, label, ror, label_compat, ror_compat in rows:
        df = spark.createDataFrame([(ref,)], spark_schema())
        out = df.select(
            labels.organisation_label(F.col("r")),
            labels.ror_label(F.col("r")),
            labels.organisation_label(F.col("r"), compat=True),
            labels.ror_label(F.col("r"), compat=True),
            labels.object_label(F.col("r")),
            labels.object_label(F.col("r"), compat=True),
        ).first()
        assert tuple(out) == (label, ror, label_compat, ror_compat, label, label_compat)


def spark_schema():
    from pyspark.sql import types as T

    return T.StructType([T.StructField("r", ORGANISATION_REF)])
