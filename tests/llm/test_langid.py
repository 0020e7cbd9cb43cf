import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import langid


def test_grams_cover_whole_words():
    keys, counts = langid.grams("A, a")
    assert sorted(counts.tolist()) == [1, 2]  # "a space a" and, twice, "space a space"
    assert langid.grams(None)[0].size == langid.grams("12 %")[0].size == 0


def test_binding_tells_order_and_letters_apart():
    a, b, c = ord("a"), ord("b"), ord("c")
    keys = np.array([(x << 42) | (y << 21) | z for x, y, z in ((a, b, c), (c, b, a), (a, b, b))], dtype=np.uint64)
    vectors = langid.gram_vectors(keys, 1024, 7).astype(float)
    assert np.abs(vectors @ vectors.T - 1024 * np.eye(3)).max() < 200


def brute(texts, model):
    """One document at a time, each gram bound by itself."""
    out = []
    for text in texts:
        keys, counts = langid.grams(text)
        bundle = np.zeros(model.dim)
        for key, count in zip(keys, counts):
            letters = [(int(key) >> s) & 0x1FFFFF for s in (42, 21, 0)]
            bound = np.ones(model.dim)
            for place, letter in zip((2, 1, 0), letters):
                bound *= np.roll(langid.letter_vectors(np.array([letter], np.uint64), model.dim, model.seed)[0], place)
            bundle += count * bound
        cosines = model.prototypes @ bundle / (np.linalg.norm(bundle) or 1)
        out.append((model.languages[int(cosines.argmax())], max(0.0, float(cosines.max()))) if len(keys) else ("und", 0.0))
    return out


def test_classify_equals_brute_force(docs):
    model = langid.train(docs, dim=256)
    texts = [r.text for r in docs.select("text").limit(40).collect()] + [None, "", "7"]
    names, scores = langid.classify(texts, model)
    for name, score, (want, cosine) in zip(names, scores, brute(texts, model)):
        assert name == want and score == pytest.approx(cosine, abs=1e-5)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    held = langid.query(spark, folder).filter("held_out").join(truth, "doc_id")
    right, everything = held.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert everything > 200 and right / everything >= 0.98


def test_edge_cases(spark, edge):
    model = langid.train(edge)
    assert model.languages == ["de", "en"]
    got = langid.identify(edge, model).collect()
    assert len(got) == edge.count()
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (1, 2, 3, 9)] == ["und"] * 4 and by_id[1].score == 0
    assert by_id[8].lang_pred == "de" and by_id[None].held_out is False
    kept = langid.reject_unknown(edge, model)
    assert kept.columns == edge.columns and {1, 2, 3, 9}.isdisjoint(r.doc_id for r in kept.collect())


def test_empty_table_and_limits(spark, edge):
    empty = edge.limit(0)
    model = langid.train(empty)
    assert model.languages == [] and langid.identify(empty, model).count() == 0
    assert {r.lang_pred for r in langid.identify(edge, model).collect()} == {"und"}
    with pytest.raises(ValueError):
        langid.train(edge, max_languages=1)


def test_texts_in_no_known_language_go(spark, docs):
    """Unknown scripts and random letters of many lengths go; clean texts stay, short ones too."""
    dice = random.Random(8)

    def made(letters, words):
        return " ".join("".join(dice.choices(letters, k=dice.randint(3, 9))) for _ in range(words))

    cyrillic, greek = ("".join(map(chr, range(*x))) for x in ((0x430, 0x450), (0x3B1, 0x3CA)))
    lengths = [2, 3, 5, 10, 40, 200]
    odd = [made(letters, n) for letters in (cyrillic, greek, string.ascii_lowercase) for n in lengths for _ in range(30)]
    texts = [r.text.split() for r in docs.filter("text is not null").orderBy("doc_id").collect()]
    clean = [" ".join(words[:n]) for n in (5, 10, 40) for words in texts if len(words) >= n]
    rows = [(i, x) for i, x in enumerate(odd + clean)]
    model = langid.train(docs, dim=langid.REJECT_DIM)
    kept = {r.doc_id for r in langid.reject_unknown(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    unknown = [i for i in kept if i < len(odd)]
    assert not [i for i in unknown if i < len(odd) * 2 // 3] and len(unknown) <= 0.02 * len(odd)
    assert len(kept) - len(unknown) >= 0.97 * len(clean)
