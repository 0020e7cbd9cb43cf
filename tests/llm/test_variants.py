"""Spelling variants against all words one edit away."""

import random

import pytest

from linkloom.llm import variants
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def _found(df):
    rows = [(r.word, (r.form, r.root, r.n, r.n_near, r.form_n)) for r in df.collect()]
    assert len(dict(rows)) == len(rows)
    return dict(rows)


def _edited(word, rng, letters):
    k, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:k] + (rng.choice(letters) if kind else "") + word[k + (kind < 2) :]


def _vocabulary(seed, letters, count, least, most):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(count)]
    words += [_edited(w, rng, letters) for w in words for _ in range(2)]
    return list(dict.fromkeys(w for w in words if len(w) >= 5))


@pytest.mark.parametrize("letters, least, most", [("ab", 5, 9), ("abcdefgh", 5, 7), ("aé÷ßzz", 5, 30), ("abc", 60, 80)])
def test_near_words_equal_brute_force(spark, letters, least, most):
    words = _vocabulary(len(letters), letters, 300, least, most)
    counts = {w: 3 + (len(w) * 7 + i * i) % 50 for i, w in enumerate(words)}
    want = {w: (near, *best) for w, (_, _, _, near, _) in brute.variants([w for w in counts for _ in range(counts[w])]).items() if near for best in [()]}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    for block in (variants.BLOCK, 7):  # small blocks cut every cell into parts
        got = {r.word: (r.n_near,) for r in variants.near_words(vocabulary, block).collect()}
        assert got == want


def test_a_batch_longer_than_an_index(spark, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="50")
    words = _vocabulary(9, "abcde", 400, 5, 8)
    want = {w: x[3] for w, x in brute.variants(words * 3).items() if x[3]}
    got = {r.word: r.n_near for r in variants.near_words(spark.createDataFrame([(w, 3) for w in words], "word string, n long")).collect()}
    assert got == want


def test_position_index_of_one_and_many_bitset_words():
    for count in (1, 63, 64, 65, 200):
        words = _vocabulary(count, "abc", count, 5, 8)[:count]
        near = {(words[q], words[v]) for qs, vs in variants.PositionIndex(words).near() for q, v in zip(qs, vs)}
        assert near == {(a, b) for a in words for b in words if a != b and _one_edit(a, b)}


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def test_documents(spark, docs, doc_rows):
    got = _found(variants.query(spark, SF))
    assert got == brute.variants(brute.slipped_words(doc_rows, 97))
    assert any(form for form, *_ in got.values()) and any(form is None and near for form, _, _, near, _ in got.values())


def test_chains_lead_to_their_end(spark):
    chain = ["aaaaa" + "b" * k for k in range(9)]
    rows = [(i, " ".join([w] * (3 << i))) for i, w in enumerate(chain)]
    got = _found(variants.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert all(got[w][1] == chain[-1] for w in chain) and got[chain[0]][0] == chain[1]
    assert got == brute.variants(brute.slipped_words(rows, None))


def test_awkward_rows(spark, edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert _found(variants.variants(edge, slip=7)) == brute.variants(brute.slipped_words(rows, 7))
    assert variants.variants(edge.limit(0)).collect() == []
    # ties, and a word far longer than others
    long = "x" * 50_000
    rows = [(1, "wordy words wordz " * 3), (2, f"{long} {long}y {long} {long}y {long} {long}y {long}y {long}y {long}y")]
    got = _found(variants.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute.variants(brute.slipped_words(rows, None))
