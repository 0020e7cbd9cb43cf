import random

import pytest
from pyspark.sql import functions as F

from linkloom.llm import packing, sharding
from tests.llm import brute


def check_bins(sizes, bins, offsets, made, capacities):
    held = {}
    for size, b, offset in zip(sizes, bins, offsets):
        held.setdefault(b, []).append((offset, size))
    for b, parts in held.items():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert made[b] == min(c for c in capacities if c >= end)


@pytest.mark.parametrize("seed", range(5))
def test_bins_are_tight_and_cheap(seed):
    dice = random.Random(seed)
    capacities = (64, 128, 256)
    sizes = [dice.randint(1, 256) if k % 3 else dice.randint(1, 40) for k in range(400)]
    bins, offsets, made = packing.best_fit(sizes, capacities, 8.0, 512.0)
    check_bins(sizes, bins, offsets, made, capacities)
    cost = sum(packing.bin_cost(c, 8.0, 512.0) for c in made)
    least = sum(sizes) * min(packing.bin_cost(c, 8.0, 512.0) / c for c in capacities)
    single = []
    for c in capacities[-1:]:  # plain best fit into the largest size
        b, _, m = packing.best_fit(sizes, (c,), 8.0, 512.0)
        single.append(sum(packing.bin_cost(x, 8.0, 512.0) for x in m))
    assert least <= cost <= min(single) and sum(made) <= 1.05 * sum(sizes)


def test_best_fit_takes_the_tightest_bin():
    bins, _, made = packing.best_fit([60, 50, 40, 10], (64, 100), 1000.0, 1e9)
    assert bins[0] == bins[2] and bins[1] == bins[3] and made == [100, 64]


@pytest.mark.parametrize("seed", range(12))
def test_best_fit_equals_looking_at_every_bin(seed):
    dice = random.Random(seed)
    capacities = dice.choice([(64, 128, 256), (256,), (16, 100, 200, 256)])
    sizes = [dice.choice([1, 2, 40, 64, 100, 128, 200, 256, dice.randint(1, 256)]) for _ in range(dice.randint(0, 300))]
    overhead, quadratic = dice.choice([(8.0, 512.0), (1000.0, 1e9), (0.0, 64.0)])
    sizes = [min(s, max(capacities)) for s in sizes]
    assert packing.best_fit(sizes, capacities, overhead, quadratic) == brute.best_fit(sizes, capacities, overhead, quadratic)


def test_each_group_of_the_query_is_packed_like_brute_force(docs):
    """Pieces, told by their own words, and bins of every group; the least sequence of the group is as cheap."""
    rows = packing.pack(docs, capacities=(64, 256, 512), group_rows=40).filter("bin is not null").collect()
    sizes = {r.doc_id: len(brute.WORD.findall(r.text or "")) for r in docs.collect()}
    cut = {(i, p): (p * 512, min(512, n - p * 512)) for i, n in sizes.items() for p in range(-(-n // 512))}
    assert {(r.doc_id, r.part): (r.first_word, r.n_words) for r in rows} == cut and len(rows) == len(cut)
    groups = {}
    for r in rows:
        groups.setdefault(r.bin.split("-")[0], []).append(r)
    assert len(groups) > 3
    for held in groups.values():
        bins = {}
        for r in held:
            bins.setdefault((r.bin, r.capacity), []).append(r.n_words)
        *_, made = brute.best_fit([r.n_words for r in held], (64, 256, 512), packing.OVERHEAD, packing.QUADRATIC)
        assert sum(c for _, c in bins) == sum(made) and len(bins) == len(made)


def test_bins_do_not_hang_on_the_split_of_the_input(docs, edge):
    for df in (docs, edge.unionByName(edge).unionByName(edge)):
        packed = [packing.pack(x, capacities=(32, 64), group_rows=40, texts=True).drop("_row") for x in (df.repartition(7), df.coalesce(1), df.orderBy("text"))]
        first, *others = (sorted(map(repr, x.collect())) for x in packed)
        assert all(first == other for other in others) and len(first) > df.count()


def test_every_word_has_one_place(docs, edge):
    for df in (docs, edge):
        packed = packing.pack(df, capacities=(32, 64), group_rows=50)
        rows = packed.collect()
        assert len({(r["_row"], r.part) for r in rows}) == len(rows)
        assert sum(r.n_words for r in rows) == sum(len(brute.WORD.findall(r.text or "")) for r in df.select("text").collect())
        for b in {r.bin for r in rows if r.bin}:
            parts = sorted((r.place, r.n_words, r.capacity) for r in rows if r.bin == b)
            assert parts[0][0] == 0 and all(x[0] + x[1] == y[0] for x, y in zip(parts, parts[1:])) and parts[-1][0] + parts[-1][1] <= parts[0][2]
        assert {r.n_words for r in rows if r.bin is None} <= {0}
    assert packing.pack(edge.limit(0)).count() == 0


def test_sequences_hold_the_text(docs):
    packed = packing.pack(docs)
    made = packing.sequences(docs, packed).collect()
    assert all(len(brute.WORD.findall(r.text)) == r.n_words <= r.capacity for r in made)
    words = sorted(w for r in made for w in brute.WORD.findall(r.text))
    assert words == sorted(w for r in docs.collect() for w in brute.WORD.findall(r.text or ""))


# -- sharding


def split(rows, limit):
    """Splitting buckets one by one."""
    import hashlib

    bits = {i: format(int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16), "032b") for i, _ in rows}
    buckets, done = {"": rows}, {}
    while buckets:
        prefix, held = buckets.popitem()
        if sum(n for _, n in held) <= limit or len(prefix) == 32:
            done[prefix] = held
            continue
        for bit in "01":
            buckets[prefix + bit] = [r for r in held if bits[r[0]].startswith(prefix + bit)]
    return {i: ("b" + prefix, len(prefix), n, sum(m for _, m in held)) for prefix, held in done.items() for i, n in held}


@pytest.mark.parametrize("limit", [60_000, 200_000, 1 << 24])
def test_shards_equal_splitting_one_by_one(docs, limit):
    rows = [(r.doc_id, len((r.text or "").encode())) for r in docs.collect()]
    got = {r.doc_id: (r.shard, r.depth, r.n_bytes, r.shard_bytes) for r in sharding.assign(docs, limit).collect()}
    assert got == split(rows, limit)


def test_a_small_corpus_is_split_too(docs, monkeypatch):
    monkeypatch.setattr(sharding, "LEAST_BYTES", 10_000)
    rows = [(r.doc_id, len((r.text or "").encode())) for r in docs.collect()]
    got = {r.doc_id: (r.shard, r.depth, r.n_bytes, r.shard_bytes) for r in sharding.assign(docs, shards=20).collect()}
    assert got == split(rows, sum(n for _, n in rows) // 20)
    assert len({shard for shard, *_ in got.values()}) >= 20 and len({depth for _, depth, *_ in got.values()}) > 1


def test_rows_of_one_id_get_overflow_pages(docs):
    same = docs.select(F.lit(5).cast("long").alias("doc_id"), "text", F.col("lang").alias("shard"))
    got = sharding.assign(same, 30_000)
    assert got.columns == ["doc_id", "text", "shard", "shard_", "depth", "n_bytes", "shard_bytes"] and got.count() == docs.count()
    pages = got.groupBy("shard_").agg(F.sum("n_bytes").alias("n"), F.count("*").alias("rows"), F.max("shard_bytes").alias("told")).collect()
    assert len(pages) > 5 and all(p.n == p.told and (p.n <= 30_000 or p.rows == 1) for p in pages)


def test_sharding_edge_cases(edge, tmp_path, spark):
    got = sharding.assign(edge, 1000)
    assert got.count() == edge.count() and got.columns[: len(edge.columns)] == edge.columns
    sharding.write_shards(edge.select("doc_id", "text"), str(tmp_path / "out"), 1000)
    assert spark.read.parquet(str(tmp_path / "out")).count() == edge.count()
    assert sharding.assign(edge.limit(0), 1000).count() == 0
