import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from linkloom.llm import langid, minhash, mixing
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages_follow_their_plain_versions(spark, docs, doc_rows):
    """Each stage on what the one before kept, against brute force."""
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "source_mix", "packing"]
    known = stages["language_id"](spark, docs, SF).cache()
    model = langid.train(docs.filter(~langid.is_held_out(F.col("doc_id"))), dim=langid.REJECT_DIM)
    names, scores, worth = langid._classify([t for _, t in doc_rows], model)
    least = langid.bounds(names, worth, model)
    assert {r.doc_id for r in known.collect()} == {i for (i, _), n, s, x in zip(doc_rows, names, scores, least) if n != "und" and s > x}

    lined = stages["line_dedup"](spark, known, SF).cache()
    clean = brute.clean_lines([(r.doc_id, r.text) for r in known.collect()])
    want = {i: text for i, (_, gone, text) in clean.items() if not gone or text.strip(" \t\n\x0b\x0c\r")}
    assert {r.doc_id: r.text for r in lined.collect()} == want
    assert all(r.n_chars == len(r.text) for r in lined.collect() if clean[r.doc_id][1])

    single = stages["near_dedup"](spark, lined, SF).cache()
    groups = brute.near_duplicates(list(want.items()), corpus_pipeline.NEAR_PERCENT)
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, (_, c) in groups.items() if i == c)

    mixed = stages["source_mix"](spark, single, SF).cache()
    assert known.columns == lined.columns == single.columns == mixed.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixing.mix(single).taken().collect() if r.taken}
    words = mixed.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n"))
    assert {r.doc_id: r.n for r in words.collect()} == taken

    packed = stages["packing"](spark, mixed, SF)
    assert packed.agg(F.sum("n_words")).first()[0] == sum(taken.values())
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_awkward_and_empty_documents(spark, edge):
    for table in (edge, edge.limit(0)):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.count()


def test_near_dedup_stage_links_from_80_percent(spark):
    """Pairs of every similarity about the threshold of the stage, which is not that of op4."""
    rows = []
    for k in range(1, 31):  # sets of 100 + k and 100 shingles, 100 shared
        words = [f"v{k}-{i}" for i in range(104 + k)]
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(words[:104]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF).collect()}
    want = {10 * k for k in range(1, 31)} | {10 * k + 1 for k in range(1, 31) if 100 * 100 < 80 * (100 + k)}
    assert kept == want
    at_85 = {r.doc_id for r in minhash.drop_near_duplicates(docs).collect()}
    assert at_85 == {10 * k for k in range(1, 31)} | {10 * k + 1 for k in range(1, 31) if 100 * 100 < 85 * (100 + k)}


def _pieces(rows, largest=4096):
    """Counter of (doc_id, first word, words) of plain cuts; texts without words have one empty piece."""
    out = Counter()
    for doc_id, text in rows:
        words = re.findall(r"[^ \t\n\x0b\x0c\r]+", text or "")
        for at in range(0, max(1, len(words)), largest):
            out[doc_id, at, tuple(words[at : at + largest])] += 1
    return out


def _check_bins(packed):
    bins = {}
    for r in packed:
        words = re.findall(r"[^ \t\n\x0b\x0c\r]+", r.text or "")
        assert len(words) == r.n_words and (r.bin is None) == (r.n_words == 0)
        if r.bin is not None:
            bins.setdefault((r.bin, r.capacity), []).append((r.place, r.n_words))
    for (_, capacity), places in bins.items():
        end = 0
        for place, n in sorted(places):
            assert place == end
            end += n
        assert end <= capacity


def test_bins_of_the_run_hold_the_words_of_the_mixed_documents(spark, monkeypatch):
    mixed = []

    def seen(spark, docs, sf_dir):
        mixed.extend((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
        return corpus_pipeline.pack_sequences(spark, docs, sf_dir)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[:-1], ("packing", seen)])
    packed = corpus_pipeline.run(spark, SF).collect()
    assert len({i for i, _ in mixed}) < len(mixed)  # some documents come in several rounds
    _check_bins(packed)
    assert Counter((r.doc_id, r.first_word, tuple(re.findall(r"[^ \t\n\x0b\x0c\r]+", r.text))) for r in packed) == _pieces(mixed)


def test_pieces_of_rows_with_one_id_keep_their_own_text(spark):
    long = "\n".join(f"word{i} and" for i in range(5000))
    rows = [(1, long), (1, "a  b\nc"), (1, long[:30000]), (2, None), (2, " "), (None, "x")]
    packed = corpus_pipeline.pack_sequences(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    _check_bins(packed)
    assert Counter((r.doc_id, r.first_word, tuple(re.findall(r"[^ \t\n\x0b\x0c\r]+", r.text or ""))) for r in packed) == _pieces(rows)
    assert "a  b\nc" in {r.text for r in packed}
    assert all(r.text in long for r in packed if r.n_words > 3)
