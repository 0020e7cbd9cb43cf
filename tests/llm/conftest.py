import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} {'x' * (i % 7)}y" for i in range(60_000))
COPY = "The same passage stands here in several documents,\nand in this line too, word for word."

#: doc_id, text, lang, source: nulls, empty, blank, very long, copies, ties, one row twice.
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \t\n\n ", None, "a"),
    (4, LONG, "en", "b"),
    (5, COPY, "en", "a"),
    (6, COPY, "de", "b"),
    (7, COPY + "\nOnly here.", "de", "b"),
    (7, COPY + "\nOnly here.", "de", "b"),
    (8, "Ein kurzer Satz, und noch einer. Größe über alles: ÄÖÜ ß.", "de", None),
    (9, "12 34 !!", "en", "c"),
    (10, "ONE two Three four", "en", "c"),
    (11, "one TWO three\tfour", "en", "c"),
    (None, COPY, "en", "c"),
    (12, "emoji 😀 token = 'abcdef123456' \u0000 end", "en", "c"),
]
CLASHING = ("key", "rep", "shard", "_row", "_gone", "start", "kind", "size", "sid", "component", "_hash", "text_", "found")


@pytest.fixture(scope="session")
def edge(spark):
    """Awkward documents with columns named like what operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    rows = [(*r, len(r[1] or ""), *CLASHING) for r in ROWS]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
