"""Mixing sources to target weights: fixed-length blocks, multinomial shards, permuted indices.

Only DataFrame functions; nothing passes the driver but row counts.

1.  Each source is a stream of words, its documents one after the other; the stream is cut into
    blocks of one length: ``block`` words, in sources of few blocks a little less, so that the last
    block is about as long as the others.
2.  A source's target is its weight's part of the words to make, at most ``max_epochs`` times its
    size; what is cut off goes to the others by weight.
3.  The output has shards of ``slots`` block slots.  Each slot draws its source with the targets
    as odds, which gives every shard a multinomial count of each source.  A source's draws are
    numbered over all shards.  Draws beyond its target are handed to the sources that chance left
    short, so totals are met.
4.  Draw j of a source is place j of a pseudorandom permutation of its blocks, a new one for each
    time round.  Slots and blocks are joined by that index.  A source's last place takes only as
    many words of its block as the target still wants, so small sources meet theirs too.

Streams, draws and permutations are numbered with ``running_start``: hashed chunks within a
source, so that a source with a third of all rows is no longer task than others.  The blocks of all
sources are one range of numbers, dealt to tasks, in which each looks up its source.  The table of
sources, one row each, is ordered in one task.  All draws are hashes of ``seed`` and positions, so
reruns and recomputed tasks agree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.llm.common import WORD, col, fresh, running_start, table, word_count
from linkloom.session import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
BLOCK = 128
SLOTS = 4096
_CELLS = 1024
_ROWS_A_TASK = 1_000_000
#: Tables of sources up to this many rows are sent to all tasks.
_FEW = 100_000


@dataclass(frozen=True)
class Mix:
    """``docs``: _row, doc_id, _tie (hash of the text), source, size, start (in the source's stream), sid,
    length (of the source's blocks).  ``sources``: sid, source, source_size, target, length, blocks, quota.
    ``slots``: shard, sid, epoch, place, part (words taken of the block, null for all).  ``chosen``: the same
    slots with their block.
    """

    docs: DataFrame
    sources: DataFrame
    slots: DataFrame
    chosen: DataFrame

    def pieces(self) -> DataFrame:
        """(_row, doc_id, sid, block, at, first, words): the part of each document in each block of its source.

        ``first`` is the piece's first word, counted from 0 within the document, ``at`` the same within the block.
        """
        length = F.col("length")
        blocks = F.sequence(F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("size") - 1) / length))
        cut = self.docs.filter("size > 0").select("_row", "doc_id", "sid", "start", "size", "length", F.explode(blocks).alias("block"))
        lo = F.greatest(F.col("start"), F.col("block") * length)
        hi = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * length)
        at, first = lo - F.col("block") * length, lo - F.col("start")
        return cut.select("_row", "doc_id", "sid", "block", at.alias("at"), first.alias("first"), (hi - lo).alias("words"))

    def taken(self) -> DataFrame:
        """doc_id, source, size, source_size, target, taken: a row for each row of the input."""
        whole = F.count(F.when(F.col("part").isNull(), 1))
        times = self.chosen.groupBy("sid", "block").agg(whole.alias("times"), F.max("part").alias("part"))
        words = self.pieces().join(times.hint("merge"), ["sid", "block"])  # pieces look smaller than they are
        last = F.greatest(F.lit(0), F.least(F.col("words"), F.coalesce("part", F.lit(0)) - F.col("at")))
        words = words.groupBy("_row").agg(F.sum(F.col("words") * F.col("times") + last).alias("taken"))
        known = F.broadcast(self.sources) if _few(self.sources) else self.sources
        rows = self.docs.join(words, "_row", "left").join(known.drop("source"), "sid")
        return rows.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def spans(self) -> DataFrame:
        """(_row, doc_id, shard, epoch, block, first, words): what the output shards consist of."""
        used = self.chosen.select("shard", "sid", "epoch", "block", "part")
        words = F.when(F.col("part").isNull(), F.col("words")).otherwise(F.least(F.col("words"), F.col("part") - F.col("at")))
        found = self.pieces().join(used.hint("merge"), ["sid", "block"]).withColumn("words", words)
        return found.filter("words > 0").drop("sid", "at", "part")


def _few(sources: DataFrame) -> bool:
    return sources.limit(_FEW + 1).count() <= _FEW


def mixing_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_epochs: int) -> DataFrame:
    """``sizes`` (source, source_size) with sid, weight and target.

    Targets are min(cap, rate * weight) with the one rate that makes them add up: sources in the
    order of cap / weight, the rate follows from how many of them are capped.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("sid", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("sid", F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_epochs))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    upto, everything = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    capped = F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    rate = (F.sum("source_size").over(everything) * share - capped) / left
    ranked = ranked.withColumn("_rate", rate)
    # the first source, in that order, whose cap is not below the rate: the rate holds from there on
    found = F.min(F.when(F.col("_rate") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "sid", "_rate"))).over(everything)
    target = F.least(F.col("cap"), F.coalesce(found["_rate"] * F.col("weight"), F.col("cap")))
    return ranked.withColumn("target", target).drop("_rate", "cap")


def _draw(seed: int, salt: str, *columns: Column) -> Column:
    """A whole number from 0 to 2^62 - 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(salt), *columns), 2)


def _chunks(rows: int) -> int:
    """As many chunks as rows in a chunk: neither a chunk nor the totals of a source's chunks make a long task."""
    return max(1, math.isqrt(rows))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    block: int = BLOCK,
    slots: int = SLOTS,
    seed: int = 11,
) -> Mix:
    """Plan a mix of ``share`` times the words of ``docs`` (doc_id, text, source).

    Each row is a document, repeated rows too; null and wordless texts have size 0 and no part in
    it.  A null source is a source of its own, after the others.  A source without words has
    target 0, an empty table an empty mix.
    """
    sized = docs.select(
        F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_tie"), F.monotonically_increasing_id().alias("_row")
    )
    sized = stored(sized)
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = mixing_targets(sizes, weights, share, max_epochs)
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / block))
    length = F.when(F.col("blocks") > 0, F.ceil(F.col("source_size") / F.col("blocks"))).otherwise(F.lit(block))
    sources = sources.withColumn("length", length.cast("long"))
    # whole rounds take every block, the last one whole blocks and a part of one
    goal = F.round("target").cast("long")
    rounds = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0))
    sources = sources.withColumn("_rounds", rounds).withColumn("_rest", goal - rounds * F.col("source_size"))
    whole = F.floor(F.col("_rest") / F.col("length"))
    sources = sources.withColumn("part", F.col("_rest") - whole * F.col("length"))
    quota = F.col("_rounds") * F.col("blocks") + whole + (F.col("part") > 0).cast("long")
    sources = stored(sources.withColumn("quota", quota.cast("long")).drop("_rounds", "_rest"))
    total = sources.agg(F.sum("quota")).first()[0] or 0
    count = sources.count()
    few = count <= _FEW

    ids = sources.select("sid", "length", F.col("source").alias("_source"))
    with_sid = sized.join(F.broadcast(ids) if few else ids, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    streamed = running_start(with_sid, "sid", ["doc_id", "_tie", "size"], "size", "start", _chunks(sized.count()))
    streamed = stored(streamed.select("_row", "doc_id", "_tie", "source", "size", "start", "sid", "length"))

    drawn = stored(_drawn(sources, total, slots, seed, count))
    placed = _settled(drawn, sources, seed, count)
    round_, place = F.floor(F.col("_j") / F.col("blocks")), F.pmod("_j", "blocks")
    known = sources.select("sid", "blocks", "quota", F.col("part").alias("_part"))
    placed = placed.join(F.broadcast(known) if few else known.hint("merge"), "sid")
    part = F.when((F.col("_j") == F.col("quota") - 1) & (F.col("_part") > 0), F.col("_part"))
    placed = placed.select("shard", "sid", round_.alias("epoch"), place.alias("place"), part.alias("part"))

    rounds = F.ceil(F.col("quota") / F.col("blocks"))
    shelf = _dealt(sources.filter("blocks > 0").withColumn("_n", rounds * F.col("blocks")), "_n", count)
    epoch = F.floor(F.col("_at") / F.col("blocks"))
    shelf = shelf.select("sid", epoch.alias("epoch"), (F.col("sid") * max_epochs + epoch).alias("_g"), F.pmod("_at", "blocks").alias("block"))
    shelf = shelf.withColumn("_hash", _draw(seed, "order", F.col("_g"), F.col("block"))).withColumn("_one", F.lit(1))
    shelf = running_start(shelf, "_g", ["_hash", "block"], "_one", "place", _chunks(total))
    chosen = placed.join(shelf.select("sid", "epoch", "place", "block").hint("merge"), ["sid", "epoch", "place"])
    return Mix(streamed, sources, placed, stored(chosen.select("shard", "sid", "epoch", "place", "part", "block")))


def _found(numbers: DataFrame, sources: DataFrame, amount: str, total: int, count: int) -> DataFrame:
    """``numbers`` (_u, from 0 below ``total``) with the source in whose stretch of ``amount`` numbers each falls.

    Stretches are looked up by cell, a table of one row a source and one a cell, which is sent to
    all tasks if there are few sources (``count``).  ``_at`` is the place within the stretch.
    """
    width = max(1, math.ceil(total / max(_CELLS, count)))
    end = F.sum(amount).over(Window.orderBy("sid"))
    stretches = sources.filter(F.col(amount) > 0).withColumn("_hi", end).withColumn("_lo", F.col("_hi") - F.col(amount))
    cells = F.sequence(F.floor(F.col("_lo") / width), F.floor((F.col("_hi") - 1) / width))
    stretches = stretches.withColumn("_cell", F.explode(cells))
    numbers = numbers.withColumn("_cell", F.floor(F.col("_u") / width))
    found = numbers.join(F.broadcast(stretches) if count <= _FEW else stretches.hint("merge"), "_cell")
    return found.filter("_u >= _lo and _u < _hi").withColumn("_at", F.col("_u") - F.col("_lo")).drop("_cell", "_lo", "_hi")


def _dealt(sources: DataFrame, amount: str, count: int) -> DataFrame:
    """A row for each of the ``amount`` things of each source: its columns, ``_at`` and the number ``_u`` over all.

    The rows are a range of numbers, so no source's things are built by one task.
    """
    total = sources.agg(F.sum(amount)).first()[0] or 0
    spark = sources.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(total / _ROWS_A_TASK))
    return _found(spark.range(0, total, 1, tasks).withColumnRenamed("id", "_u"), sources, amount, total, count)


def _drawn(sources: DataFrame, total: int, slots: int, seed: int, count: int = 1) -> DataFrame:
    """(shard, sid, n): the multinomial counts.  A slot's number falls into the stretch of its source."""
    shards = sources.sparkSession.range(math.ceil(total / slots)).withColumnRenamed("id", "shard")
    last = F.least(F.lit(slots), F.lit(total) - F.col("shard") * slots) - 1
    drawn = shards.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_slot"))
    drawn = drawn.withColumn("_u", F.pmod(_draw(seed, "source", F.col("shard"), F.col("_slot")), F.lit(max(1, total))))
    found = _found(drawn, sources.select("sid", "quota"), "quota", total, count)
    return found.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n"))


def _settled(drawn: DataFrame, sources: DataFrame, seed: int, count: int) -> DataFrame:
    """(shard, sid, _j): every number of every source's quota once, in the shard that drew it."""
    quotas = sources.select("sid", "quota")
    counts = running_start(drawn, "sid", ["shard"], "n", "_start", _chunks(drawn.count()))
    numbered = counts.join(quotas, "sid").select(
        "shard", "sid", "quota", F.explode(F.sequence(F.col("_start"), F.col("_start") + F.col("n") - 1)).alias("_j")
    )
    kept = numbered.filter("_j < quota").select("shard", "sid", "_j")
    # slots of sources that were drawn too often, in a random order, go to those drawn too seldom
    got = drawn.groupBy("sid").agg(F.sum("n").alias("_got"))
    short = quotas.join(got, "sid", "left").withColumn("_got", F.coalesce("_got", F.lit(0)))
    short = stored(short.withColumn("_short", F.greatest(F.lit(0), F.col("quota") - F.col("_got"))))
    missing = _dealt(short, "_short", count).select("sid", (F.col("_got") + F.col("_at")).alias("_j"), F.col("_u").alias("_rank"))
    free = numbered.filter("_j >= quota").withColumn("_hash", _draw(seed, "free", F.col("sid"), F.col("_j")))
    free = free.withColumn("_all", F.lit(0)).withColumn("_one", F.lit(1))
    free = running_start(free, "_all", ["_hash", "sid", "_j"], "_one", "_rank", 64)
    moved = missing.join(free.select("shard", "_rank").hint("merge"), "_rank").select("shard", "sid", "_j")
    return kept.unionByName(moved)


def mixed_documents(docs: DataFrame, made: Mix | None = None, **options) -> DataFrame:
    """The mix as rows like ``docs``: a document once for each round that takes words of it.

    The text is the words that the round takes, the whole text unchanged if it takes them all;
    other columns are repeated, ``n_chars`` follows the text.  Rows equal in doc_id and text take
    their other columns from one of them.
    """
    made = made or mix(docs, **options)
    key, tie, same, runs = (fresh(docs, x) for x in ("_key", "_text_hash", "_same", "_runs"))
    taken = made.spans().groupBy("_row", "epoch").agg(
        F.array_sort(F.collect_list(F.struct("first", "words"))).alias("_runs"), F.sum("words").alias("_words")
    )
    taken = taken.join(made.docs.select("_row", "doc_id", "_tie", "size"), "_row").select(
        F.col("doc_id").alias(key), F.col("_tie").alias(same), F.when(F.col("_words") < F.col("size"), F.col("_runs")).alias(runs)
    )
    tagged = docs.withColumn(tie, F.xxhash64("text"))
    twins = made.docs.groupBy(F.col("doc_id").alias(key), F.col("_tie").alias(same)).count().filter("count > 1").drop("count")
    if twins.limit(1).count():
        twin = tagged["doc_id"].eqNullSafe(twins[key]) & (tagged[tie] == twins[same])
        once = tagged.join(twins, twin, "left_semi").dropDuplicates(["doc_id", tie])
        tagged = tagged.join(twins, twin, "left_anti").unionByName(once)
    joined = tagged.join(taken, tagged["doc_id"].eqNullSafe(taken[key]) & (tagged[tie] == taken[same]))
    whole = col(runs).isNull()

    def parts(words: Column) -> Column:
        return F.flatten(F.transform(col(runs), lambda r: F.slice(words, (r["first"] + 1).cast("int"), r["words"].cast("int"))))

    # the words are named once, or each run would split the whole text again
    cut = F.get(F.transform(F.array(F.regexp_extract_all("text", F.lit(f"({WORD})"))), parts), F.lit(0))
    out = joined.withColumn("text", F.when(whole, F.col("text")).otherwise(F.array_join(cut, " ")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(length))
    return out.select(*[col(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).taken().drop("source")
