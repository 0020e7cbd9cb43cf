"""Relative Lempel-Ziv parsing against a dictionary of all windows."""

import random

import pytest

from linkloom.llm import substrings
from tests.llm import brute


def _removed(df):
    return {r.doc_id: (r.n_words, r.kept) for r in df.collect()}


def _plain(rows, window=20):
    return {i: (n, " ".join(kept)) for i, (n, kept) in brute.parsed_windows(rows, window).items()}


def _texts(seed, count, words, alphabet):
    """Texts of passages, copies with changed words, and repetitions within a text."""
    rng = random.Random(seed)
    passages = [[f"p{k}w{i}" for i in range(rng.randint(15, 90))] for k in range(6)]
    rows = []
    for i in range(count):
        text = []
        while len(text) < words:
            if rng.random() < 0.4:
                passage = list(rng.choice(passages))
                if rng.random() < 0.5:
                    passage[rng.randrange(len(passage))] = "x"
                at = rng.randrange(len(passage))
                text += passage[at:] if rng.random() < 0.3 else passage
            else:
                text += [rng.choice(alphabet) for _ in range(rng.randint(1, 40))]
        rows.append((i, " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("alphabet", [["a"], ["a", "b"], [f"z{i}" for i in range(500)]])
def test_equals_all_windows(spark, alphabet):
    rows = _texts(len(alphabet), 60, 150, alphabet)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _removed(substrings.parsed(docs)) == _plain(rows)


def test_another_window(spark):
    rows = _texts(7, 40, 120, ["a", "b", "c"])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _removed(substrings.parsed(docs, window=9)) == _plain(rows, 9)
    with pytest.raises(ValueError):
        substrings.parsed(docs, window=4)


def test_factors_tell_where_the_words_come_from(spark):
    rows = _texts(3, 50, 200, [f"z{i}" for i in range(300)])
    words = {i: text.split() for i, text in rows}
    found = {r.doc_id: r for r in substrings.parsed(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert any(r.factors for r in found.values())
    for r in found.values():
        covered = set()
        for f in r.factors:
            assert f.n_words >= 20 and (f.source_doc, f.source_start) < (r.doc_id, f.start)
            assert words[r.doc_id][f.start : f.start + f.n_words] == words[f.source_doc][f.source_start : f.source_start + f.n_words]
            covered.update(range(f.start, f.start + f.n_words))
        assert r.n_removed == len(covered)


def test_a_copy_is_one_factor(spark):
    text = " ".join(f"w{i}" for i in range(3000))
    docs = spark.createDataFrame([(5, "before " + text), (2, text), (9, text + " after")], "doc_id long, text string")
    found = {r.doc_id: [tuple(f) for f in r.factors] for r in substrings.parsed(docs).collect()}
    assert found[2] == [] and found[5] == [(1, 3000, 2, 0)] and found[9] == [(0, 3000, 2, 0)]


def test_awkward_rows(spark, edge):
    """Nulls, empty, very long, one row twice, clashing columns; a null doc_id comes first."""
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    out = substrings.parsed(edge)
    plain = _plain(dict(rows).items())
    got = [(r.doc_id, (r.n_words, r.kept)) for r in out.collect()]
    assert len(got) == len(rows) and all(plain[i] == value for i, value in got)
    assert substrings.parsed(edge.limit(0)).collect() == []


def test_rows_with_one_id_and_several_texts(spark):
    a = " ".join(f"a{i}" for i in range(40))
    rows = [(1, a), (1, "x " + a), (1, a), (2, "y z " + a), (0, "short")]
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substrings.parsed(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 1, 0), (1, 40, 0), (1, 40, 0), (1, 41, 40), (2, 42, 40)]
