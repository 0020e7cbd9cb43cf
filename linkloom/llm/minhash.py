"""MinHash near-dedup with tensored banding.

A document is the set of its five-word shingles.  Two collections A and B of ``GROUPS`` groups of
``ROWS`` minhashes stand for ``GROUPS``^2 tables: table (i, j) is keyed by group i of A and group
j of B together.  2 * GROUPS * ROWS minhashes thus give tables that would take GROUPS^2 * 2 * ROWS
if each were computed for itself.  At the threshold of 0.85 a pair shares no table with a
probability of one in a million; at 0.80, which the corpus pipeline asks for, of five in 100,000.

What keeps this linear, in copies as well as in documents:

* documents with the same set are one class from the start;
* a group that only one class has, in A or in B, is left out before anything is compared;
* the classes of a bucket of A are dealt out in blocks of about ``BLOCK``.  A task forms the tables of
  its block, that is, the classes that share the bucket's group of A and one of B, and compares
  those only.  Signatures (a byte of each minhash, four of each group of A) rule out pairs whose
  estimate is four deviations below the threshold, or whose sizes differ too much;
* the first class of a bucket is a member of all its blocks, so that a group of near copies is
  tied together there, however large it is;
* only buckets of several blocks whose classes are then still in several components go on, and in
  them classes that share a table with one of another component.  Those outside the bucket's
  largest component are compared with all others, block by block, and nothing else;
* candidates never become rows.  The tasks that compare signatures only tell which classes have a
  candidate in which block; those classes come back to the block with their full sets, and the
  task that confirms the links tells a spanning forest of them.  A pair that is already tied is
  not confirmed again, so a dense group costs about as many confirmations as it has members.

Links are confirmed on the full sets, recomputed from the texts of the documents concerned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import components, fresh, table
from linkloom.operators.joins import broadcast_if_small
from linkloom.session import discard, stored

SHINGLE = 5
#: Least Jaccard similarity of a link, in hundredths, unless the caller has its own.
PERCENT = 85
GROUPS = 20
ROWS = 4
BLOCK = 1024
#: Shingles of a block, on average at most: 8 MB of full sets.
BLOCK_SHINGLES = 1 << 20
_HASHES = 2 * GROUPS * ROWS
_CHUNK = 1 << 11  # shingles hashed at once: 2.6 MB
_MULTIPLIERS = (np.random.default_rng(4).integers(0, 2**63, _HASHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_PLACES = (np.random.default_rng(5).integers(0, 2**63, SHINGLE, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct five-word shingles of a whole text.

    Words are what white space (space, 9 to 13) separates, A-Z lowered.  With one to four words
    the whole sequence is the only shingle; without words there is none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(words) - SHINGLE + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(SHINGLE):
        total += _mix(hashed[k : k + n] + np.uint64(k)) * _PLACES[k]
    return np.unique(_mix(total))


def minhashes(items: np.ndarray) -> np.ndarray:
    least = np.full(_HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(items), _CHUNK):
        np.minimum(least, (_MULTIPLIERS[:, None] * items[None, at : at + _CHUNK]).min(axis=1), out=least)
    return least


_SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, groups array<long>, signature binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("groups", pa.list_(pa.int64())), ("signature", pa.binary())])
    for batch in batches:
        sizes, firsts, seconds, groups, signatures = [], [], [], [], []
        for text in batch.column(1):
            items = shingles(text.as_py())
            sizes.append(len(items))
            if not len(items):
                for out in (firsts, seconds, groups, signatures):
                    out.append(None)
                continue
            digest = np.frombuffer(xxhash.xxh3_128_digest(items.tobytes()), dtype=np.int64)
            least = minhashes(items)
            bands = least.reshape(2 * GROUPS, ROWS)
            keys = np.zeros(2 * GROUPS, dtype=np.uint64)
            for k in range(ROWS):
                keys = _mix(keys + bands[:, k])
            keys = _mix(keys + np.arange(1, 2 * GROUPS + 1, dtype=np.uint64))
            firsts.append(digest[0])
            seconds.append(digest[1])
            groups.append(keys.view(np.int64))
            marks = ((least >> np.uint64(24)) & np.uint64(0xFF)).astype(np.uint8).tobytes()
            signatures.append(marks + keys[:GROUPS].astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, t.type) for v, t in zip((sizes, firsts, seconds, groups, signatures), list(schema)[1:]))], schema=schema)


def signed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sign, _SIGNED)


# -- candidates ---------------------------------------------------------------------------------------


def _repeated(classes: DataFrame, first: int, last: int) -> DataFrame:
    """(rep, place, key, blocks, pivot): groups from ``first`` up to ``last`` that more than one class has.

    ``blocks`` is the number of blocks that the group's bucket is cut into, ``pivot`` its first class.
    """
    keys = classes.select("rep", "n_shingles", F.posexplode(F.slice("groups", first + 1, last - first)).alias("place", "key"))
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("count"), F.sum("n_shingles").alias("weight"), F.min("rep").alias("pivot"))
    counts = counts.filter("count > 1").select("key", _blocks(F.col("count"), F.col("weight")).alias("blocks"), "pivot")
    return keys.drop("n_shingles").join(stored(counts), "key")


def _blocks(count, weight):
    return F.greatest(F.ceil(count / BLOCK), F.ceil(weight / BLOCK_SHINGLES)).cast("int")


def _meetings(classes: DataFrame) -> DataFrame:
    """(rep, place, key, blocks, pivot): the buckets of A, classes without company in A or in B left out."""
    in_a = stored(_repeated(classes, 0, GROUPS))
    met = classes.join(in_a.select("rep").distinct(), "rep", "left_semi")
    in_b = _repeated(met, GROUPS, 2 * GROUPS).select("rep").distinct()
    return in_a.join(in_b, "rep", "left_semi")


def _own(blocks):
    return F.pmod(F.xxhash64("rep", F.lit(9)), blocks).cast("int")


def _in_blocks(meetings: DataFrame) -> DataFrame:
    """Each class in its block of each of its buckets, and a bucket's first class in all its blocks."""
    own = _own(F.col("blocks"))
    where = F.when(F.col("rep") == F.col("pivot"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    rows = meetings.select("rep", "place", "key", F.explode(where).alias("p"))
    return rows.select("rep", "place", "key", "p", F.col("p").alias("q"), F.col("p").alias("own"), F.col("rep").alias("component"))


def _across_blocks(meetings: DataFrame, classes: DataFrame, ties: DataFrame) -> DataFrame:
    """Classes of the buckets that hold several components still, once for each pair of blocks to compare."""
    large = meetings.filter("blocks > 1").select("rep", "place", "key")
    large = large.join(ties, F.col("rep") == F.col("node"), "left").withColumn("component", F.coalesce("component", "rep")).drop("node")
    open_ = large.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most")
    large = large.join(stored(open_.select("key")), "key", "left_semi")
    groups = classes.select("rep", "n_shingles", F.slice("groups", GROUPS + 1, GROUPS).alias("groups"))
    large = stored(large.join(groups, "rep"))

    # keys of pairs of groups: a class whose tables hold no other component has nothing to compare
    tables = large.select("rep", "key", "component", F.explode("groups").alias("group")).withColumn("table", F.xxhash64("key", "group")).drop("group")
    mixed = tables.groupBy("table").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most")
    met = tables.join(stored(mixed.select("table")), "table", "left_semi").select("rep", "key").distinct()
    large = large.drop("groups").join(met, ["rep", "key"], "left_semi")

    parts = large.groupBy("key", "component").agg(F.count(F.lit(1)).alias("count"), F.sum("n_shingles").alias("weight"))
    sizes = parts.groupBy("key").agg(
        F.max(F.struct("count", "component")).alias("top"), F.sum("count").alias("count"), F.sum("weight").alias("weight")
    )
    rest = F.col("count") - F.col("top.count")
    blocks = _blocks(F.col("count"), F.col("weight"))
    few = F.ceil(blocks * rest / F.col("count")).cast("int")
    sizes = stored(sizes.filter(rest > 0).select("key", F.col("top.component").alias("top"), blocks.alias("blocks"), few.alias("few")))
    rows = large.join(sizes, "key")
    # blocks of the largest component first, then those of the others
    is_top, every = F.col("component") == F.col("top"), F.col("blocks") + F.col("few") - 1
    rows = rows.withColumn("own", F.when(is_top, _own(F.col("blocks"))).otherwise(F.col("blocks") + _own(F.col("few"))))
    with_ = F.when(is_top, F.sequence(F.col("blocks"), every)).otherwise(F.sequence(F.lit(0), every))
    rows = rows.withColumn("with", F.explode(with_))
    return rows.select("rep", "place", "key", F.least("own", "with").alias("p"), F.greatest("own", "with").alias("q"), "own", "component")


def _least_equal(percent: int) -> int:
    t = percent / 100
    return math.ceil((t - 4 * math.sqrt(t * (1 - t) / _HASHES)) * _HASHES)


_ROW = "key long, p int, q int, own int, place int, rep long, component long, n_shingles long, signature binary"
_ROW_NAMES = [f.split()[0] for f in _ROW.split(", ")]


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block pair, from rows sorted by (key, p, q)."""
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        marks = np.stack([rows.column(n).to_numpy() for n in ("key", "p", "q")])
        starts = np.r_[0, np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1]
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
            yield rows.slice(lo, hi - lo)
        rest = rows.slice(int(starts[-1])).combine_chunks()
    if rest is not None and len(rest):
        yield rest


def _candidates(rows: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(x, later rows that are candidates of x) of a block pair: rows that share a table and look similar enough.

    A pair counts only in the first group of A that it shares.
    """
    n = len(rows)
    if n < 2:
        return
    sizes, own, components = (rows.column(c).to_numpy() for c in ("n_shingles", "own", "component"))
    p, q, place = (rows.column(c)[0].as_py() for c in ("p", "q", "place"))
    signatures = np.frombuffer(b"".join(rows.column("signature").to_pylist()), dtype=np.uint8).reshape(n, -1)
    prints = signatures[:, _HASHES:].copy().view(np.uint32)
    signatures = signatures[:, :_HASHES]
    tables = signatures[:, GROUPS * ROWS :].copy().view(np.uint32)  # with the bucket's group of A the keys of the tables
    least = _least_equal(percent)
    for x in range(n - 1):
        near = (tables[x + 1 :] == tables[x]).any(axis=1)
        near &= components[x + 1 :] != components[x]
        near &= 100 * np.minimum(sizes[x + 1 :], sizes[x]) >= percent * np.maximum(sizes[x + 1 :], sizes[x])
        if p != q:
            near &= own[x + 1 :] != own[x]
        if near.any():
            kept = np.flatnonzero(near) + x + 1
            near = (signatures[kept] == signatures[x]).sum(axis=1) >= least
            near &= (prints[kept] == prints[x]).argmax(axis=1) == place
            yield x, kept[near]


def _with_candidates(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The rows of a block pair that have a candidate in it."""
    for rows in _by_block(batches):
        wanted = np.zeros(len(rows), dtype=bool)
        for x, others in _candidates(rows, percent):
            wanted[others] = True
            wanted[x] |= len(others) > 0
        if wanted.any():
            yield from rows.filter(pa.array(wanted)).combine_chunks().to_batches()


# -- confirmation -------------------------------------------------------------------------------------


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = [shingles(t.as_py()).tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.binary())], names=["rep", "items"])


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links within each block pair, confirmed on the full sets."""
    for rows in _by_block(batches):
        reps = rows.column("rep").to_numpy()
        items = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in rows.column("items")]
        components, which = np.unique(rows.column("component").to_numpy(), return_inverse=True)
        parent = list(range(len(components)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        left, right = [], []
        for x, others in _candidates(rows, percent):
            for y in others.tolist():
                a, b = root(which[x]), root(which[y])
                if a != b and _similar(items[x], items[y], percent):
                    parent[b] = a
                    left.append(reps[x])
                    right.append(reps[y])
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _confirmed(docs: DataFrame, classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the links in each block pair of ``rows``."""
    rows = rows.join(classes.select("rep", "n_shingles", "signature"), "rep")
    dealt = rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q").select(*_ROW_NAMES)
    found = stored(dealt.mapInArrow(lambda batches: _with_candidates(batches, percent), _ROW))
    # texts stay where they are as long as the ids wanted are measured to be few
    wanted = broadcast_if_small({"ids": found.select("rep").distinct()})["ids"]
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(wanted, "rep", "left_semi")
    sets = stored(texts.mapInArrow(_sets, "rep long, items binary"))
    # an id that occurs with several texts comes back with the set of the row's own size
    full = found.join(sets, "rep").filter(F.octet_length("items") == F.col("n_shingles") * 8)
    full = full.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    links = stored(full.select(*_ROW_NAMES, "items").mapInArrow(lambda batches: _confirm(batches, percent), "a long, b long"))
    discard(found)
    discard(sets)
    return links


def _links(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that tie together all representatives of classes that are tied by any links."""
    meetings = stored(_meetings(classes.select("rep", "n_shingles", "groups")))
    links = _confirmed(docs, classes, _in_blocks(meetings), percent)
    if meetings.filter("blocks > 1").isEmpty():
        return links
    rest = stored(_across_blocks(meetings, classes, components(links)))
    return links if rest.isEmpty() else links.unionByName(_confirmed(docs, classes, rest, percent))


# -- the operator -------------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs`` (doc_id, text).

    Two documents are linked if the Jaccard similarity of their sets is ``percent`` / 100 or more.
    ``component_id`` is the smallest doc_id reachable over links, the document's own included.
    Documents without words are linked with nothing.  A null doc_id has a null component and is
    kept.  Rows of equal doc_id and equal set count as one document.
    """
    known = stored(signed(docs))
    linkable = known.filter("n_shingles > 0 and doc_id is not null")
    reps = stored(linkable.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")))
    grouped = linkable.join(reps, ["d1", "d2"])
    classes = stored(grouped.filter("doc_id = rep").select("rep", "n_shingles", "groups", "signature"))
    links = _links(docs, classes, percent)

    # documents that occur with several texts tie their classes together
    several = grouped.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b")
    ties = components(links.unionByName(several.select("a", "b")))
    found = grouped.select("doc_id", "d1", "d2", "rep").join(ties, F.col("rep") == F.col("node"), "left")
    found = found.groupBy(F.col("doc_id").alias("_id")).agg(F.min(F.coalesce("component", "rep")).alias("_component"))
    out = known.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("_id"), "left")
    component = F.coalesce("_component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group, that with the smallest doc_id; all columns kept."""
    gone = near_duplicates(docs, percent).filter(~F.col("kept")).select(F.col("doc_id").alias(fresh(docs, "_gone"))).distinct()
    gone = broadcast_if_small({"ids": stored(gone)})["ids"]
    return docs.join(gone, docs["doc_id"] == gone[gone.columns[0]], "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: All pairs that share a shingle; the reachable ids of linked documents by recursion.
SQL = """
with recursive words as (
    select doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
    from documents
), shingles as (
    select distinct doc_id, shingle from (
        select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as shingle
        from words)
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as both
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
), links as (
    select s.a, s.b from shared s join sizes x on x.doc_id = s.a join sizes y on y.doc_id = s.b
    where 100 * s.both >= 85 * (x.n + y.n - s.both)
), edges as (
    select a, b from links union all select b, a from links
), reach as (
    select a as node, a as root from edges
    union
    select e.b, r.root from reach r join edges e on e.a = r.node
), components as (
    select node, min(root) as component from reach group by node
)
select d.doc_id, cast(coalesce(s.n, 0) as bigint) as n_shingles, coalesce(c.component, d.doc_id) as component_id,
       coalesce(c.component, d.doc_id) = d.doc_id as kept
from documents d left join sizes s on s.doc_id = d.doc_id left join components c on c.node = d.doc_id
"""
