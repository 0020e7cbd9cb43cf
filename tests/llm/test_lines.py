import numpy as np
import pytest

from linkloom.llm import lines
from tests.llm import brute


def kept(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect()}


def wanted(rows):
    return {i: (n, d, brute.sha256(text)) for i, (n, d, text) in brute.clean_lines(rows).items()}


def test_equals_brute_force(docs, doc_rows):
    assert kept(lines.cleaned(docs, lines.LineIndex.build(docs))) == wanted(doc_rows)


def dropped(index):
    return sorted(map(tuple, index.dropped().collect()))


def test_insertions_and_deletions(docs, doc_rows, monkeypatch):
    monkeypatch.setattr(lines, "KEYS_PER_SHARD", 100)
    monkeypatch.setattr(lines, "ROWS_PER_SLICE", 50)
    first, rest = docs.filter("doc_id % 3 = 0"), docs.filter("doc_id % 3 <> 0")
    small, whole = lines.LineIndex.build(first), lines.LineIndex.build(docs)
    assert small.shards > 1
    grown = small.insert(rest)
    assert dropped(grown) == dropped(whole)
    back = grown.delete(rest.select("doc_id"))
    assert dropped(back) == dropped(small)
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, small.counts.collect()))
    assert kept(lines.cleaned(first, back)) == wanted([r for r in doc_rows if r[0] % 3 == 0])
    assert dropped(back.insert(rest)) == dropped(whole)
    # filters let all repeated keys through, and after deletions hardly any others
    passed = {(r.k1, r.k2) for r in back.suspects().collect()}
    repeated = {(r.k1, r.k2) for r in back.repeated().collect()}
    assert repeated <= passed and len(passed - repeated) < 20


@pytest.mark.parametrize("n", [1, 7, 1000, 20000])
def test_cuckoo_filter(n):
    dice = np.random.default_rng(n)
    k1, k2 = dice.integers(-(2**63), 2**63 - 1, (2, n))
    made = lines.Cuckoo.of(k1, k2)
    assert made.has(k1, k2).all()
    other = dice.integers(-(2**63), 2**63 - 1, (2, 20000))
    assert made.has(*other).mean() < 0.001
    half = n // 2
    made = lines.Cuckoo.read(made.bytes())
    made.remove(k1[:half], k2[:half])
    assert made.has(k1[half:], k2[half:]).all() and (made.cells != 0).sum() == n - half
    assert made.add(k1[:half], k2[:half]) and made.has(k1, k2).all()


def test_a_full_filter_says_so():
    k1, k2 = np.zeros(9, np.int64), np.full(9, 7, np.int64)
    assert not lines.Cuckoo.sized(2).add(k1, k2)


def test_edge_cases(edge):
    index = lines.LineIndex.build(edge)
    rows = lines.cleaned(edge, index).collect()
    assert len(rows) == edge.count()
    got = {r.doc_id: r for r in rows}
    assert (got[1].n_lines, got[1].n_dropped, got[1].kept_sha256) == (1, 0, brute.sha256(""))
    assert got[5].n_dropped == 2 and got[5].text == "" and got[None].n_dropped == 2
    assert got[7].n_dropped == 0  # the largest id keeps its lines, in each of its rows
    out = lines.drop_repeated_lines(edge)
    assert out.columns == edge.columns
    left = sorted((r.doc_id for r in out.collect()), key=str)
    assert left == sorted([1, 2, 3, 4, 7, 7, 8, 9, 10, 11, 12], key=str)
    assert lines.cleaned(edge.limit(0), lines.LineIndex.build(edge.limit(0))).count() == 0


def test_a_repeated_row_is_one_document(spark):
    """Two copies of a row beside one other document: two documents hold the line, as the SQL counts."""
    line = "a line that stands in several documents"
    rows = spark.createDataFrame([(1, line), (1, line), (2, line)], "doc_id long, text string")
    assert [r.n_dropped for r in lines.cleaned(rows, lines.LineIndex.build(rows)).collect()] == [0, 0, 0]
    again = lines.LineIndex.build(rows).insert(rows.filter("doc_id = 1"))
    assert again.counts.first().n_docs == 2 and again.repeated().count() == 0
    third = again.insert(spark.createDataFrame([(3, line)], "doc_id long, text string"))
    assert third.counts.first().n_docs == 3
    assert third.delete(spark.createDataFrame([(1,)], "id long")).counts.first().n_docs == 2
