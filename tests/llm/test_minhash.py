import random

from linkloom.llm import minhash
from tests.llm import brute


def result(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_equals_brute_force(docs, doc_rows):
    assert result(minhash.near_duplicates(docs)) == brute.near_duplicates(doc_rows)


def test_chains_and_large_groups(spark, monkeypatch):
    """Near copies of one text by the hundred, chained ones, and pairs about the threshold; small blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    dice = random.Random(5)
    base = [f"w{dice.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(240):
        words = list(base)
        for _ in range(dice.choice([0, 1, 1, 2, 3, 4, 6])):
            words[dice.randrange(len(words))] = f"z{dice.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    chain = [f"c{k}" for k in range(200)]
    for i in range(300, 340):
        chain[dice.randrange(200)] = f"y{i}"
        rows.append((i, " ".join(chain)))
    rows += [(400 + i, " ".join(f"u{i}-{k}" for k in range(50))) for i in range(50)]
    dice.shuffle(rows)
    got = result(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))
    assert got == brute.near_duplicates(rows)


def test_edge_cases(spark, edge):
    rows = minhash.near_duplicates(edge).collect()
    assert len(rows) == edge.count()
    got = {r.doc_id: r for r in rows}
    assert [got[i].n_shingles for i in (1, 2, 3)] == [0, 0, 0] and got[3].component_id == 3
    assert got[6].component_id == 5 and not got[6].kept
    assert got[None].component_id is None and got[None].kept
    assert got[11].component_id == 10 and got[10].n_shingles == 1  # fewer than five words, one set
    assert got[7].component_id in (5, 7) and sum(r.doc_id == 7 for r in rows) == 2
    kept = minhash.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id in (5, 6, 10, 11)) == [5, 10]
    assert minhash.near_duplicates(edge.limit(0)).count() == 0


def test_a_repeated_id_ties_its_texts(spark):
    texts = [" ".join(f"{c}{k}" for k in range(20)) for c in "ab"]
    rows = [(1, texts[0]), (5, texts[0]), (5, texts[1]), (7, texts[1])]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {1}


def test_near_copies_cost_in_proportion(spark, monkeypatch):
    """Each class goes to one block of a bucket, whatever the group's size, and tied buckets go no further."""
    from linkloom.session import stored

    monkeypatch.setattr(minhash, "BLOCK", 32)
    dice = random.Random(8)
    base = [f"w{k}" for k in range(200)]
    dealt = {}
    for n in (200, 800):
        texts = []
        for i in range(n):
            words = list(base)
            words[dice.randrange(200)] = f"z{i}"
            texts.append((i, " ".join(words)))
        docs = spark.createDataFrame(texts, "doc_id long, text string")
        classes = stored(minhash.signed(docs).withColumnRenamed("doc_id", "rep"))
        meetings = stored(minhash._meetings(classes))
        rows = minhash._in_blocks(meetings)
        dealt[n] = rows.count()
        pivots = meetings.select("key", "blocks").distinct().agg({"blocks": "sum"}).first()[0]
        assert dealt[n] <= meetings.count() + pivots
        ties = minhash.components(minhash._confirmed(docs, classes, rows, 85))
        # at most a few classes that share no table with a first one are compared again
        assert minhash._across_blocks(meetings, classes, ties).count() < n
    assert dealt[800] < 5 * dealt[200]
