"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the largest capacity are cut into pieces of that length and a rest.  Pieces
are dealt by hash into groups of about ``group_rows`` rows, each packed by one task, largest first:

* a piece goes into the open bin with the least room that still holds it;
* where none does, a bin is opened at the capacity that costs least a word, given how many words
  are left to fill it: ``cost = overhead + capacity + capacity^2 / quadratic``, the price of a
  sequence with attention.  Large bins spread the overhead, small ones save attention, and near
  the end, when little is left, a bin is no larger than it can be filled;
* at last each bin is cut down to the smallest capacity that holds what it got.

Groups and ties go by doc_id, text and, among repeated rows, a number, so the bins do not depend on
how the input is split among files.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.llm.common import WORD, table, word_count
from linkloom.session import stored

CAPACITIES = (256, 512, 1024, 2048, 4096)
OVERHEAD = 128.0
QUADRATIC = 16384.0
GROUP_ROWS = 20_000


def bin_cost(capacity: int, overhead: float = OVERHEAD, quadratic: float = QUADRATIC) -> float:
    return overhead + capacity + capacity * capacity / quadratic


def best_fit(
    sizes: Sequence[int], capacities: Sequence[int] = CAPACITIES, overhead: float = OVERHEAD, quadratic: float = QUADRATIC
) -> tuple[list[int], list[int], list[int]]:
    """Bin of each size, its offset there, and the capacity of each bin.

    Sizes are from 1 to the largest capacity; equal ones are taken in the order given.
    """
    capacities = sorted(capacities)
    costs = [bin_cost(c, overhead, quadratic) for c in capacities]
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    filled: list[int] = []
    opened: list[int] = []  # capacity at opening
    rooms: list[int] = []  # the different amounts of room, in order
    at_room: dict[int, list[int]] = {}
    left = int(sum(sizes))
    for k in np.argsort(-np.asarray(sizes, dtype=np.int64), kind="stable").tolist():
        size = int(sizes[k])
        place = bisect_left(rooms, size)
        if place < len(rooms):
            room = rooms[place]
            chosen = at_room[room].pop()
            if not at_room[room]:
                del at_room[room]
                rooms.pop(place)
        else:
            fits = bisect_left(capacities, size)
            best = min(range(fits, len(capacities)), key=lambda i: costs[i] / min(capacities[i], left))
            chosen, room = len(filled), capacities[best]
            filled.append(0)
            opened.append(room)
        bins[k], offsets[k] = chosen, filled[chosen]
        filled[chosen] += size
        left -= size
        room = opened[chosen] - filled[chosen]
        if room:
            if room not in at_room:
                insort(rooms, room)
                at_room[room] = []
            at_room[room].append(chosen)
    return bins, offsets, [capacities[bisect_left(capacities, f)] for f in filled]


def _marked(sized: DataFrame) -> DataFrame:
    """Add ``_mark``, which tells the rows apart: ``_same``, and among its rows their number.

    Rows with one doc_id and text are counted by partition of ``_row`` first, so no task gets all copies of one.
    """
    sized = sized.withColumn("_from", F.shiftright("_row", 33))
    here = Window.partitionBy("_same", "_from").orderBy("_row")
    sized = sized.withColumn("_number", F.row_number().over(here))
    before = Window.partitionBy("_s").orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
    counts = sized.groupBy(F.col("_same").alias("_s"), F.col("_from").alias("_f")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_before", F.sum("_n").over(before)).filter("_before > 0").select("_s", "_f", "_before")
    found = sized.join(counts, (F.col("_same") == F.col("_s")) & (F.col("_from") == F.col("_f")), "left")
    number = F.col("_number") + F.coalesce("_before", F.lit(0))
    return found.withColumn("_mark", F.xxhash64("_same", number)).drop("_s", "_f", "_before", "_number", "_from", "_same")


def pack(
    docs: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    overhead: float = OVERHEAD,
    quadratic: float = QUADRATIC,
    group_rows: int = GROUP_ROWS,
    texts: bool = False,
) -> DataFrame:
    """(_row, doc_id, part, first_word, n_words, bin, capacity, place) of each piece of each row of ``docs``.

    ``first_word`` counts from 0 in the document, ``place`` in the bin.  A text without words, or
    null, is one row of 0 words in no bin.  Repeated rows are packed one by one.

    With ``texts``, each piece also has its own ``text``: that of the row, cut before words.
    """
    largest = max(capacities)
    read = ["doc_id", "text"] if texts else ["doc_id"]
    same = F.xxhash64("doc_id", "text")
    sized = stored(docs.select(F.monotonically_increasing_id().alias("_row"), *read, word_count(F.col("text")).alias("size"), same.alias("_same")))
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / largest))
    pieces = _marked(sized.filter("size > 0").select("_row", "_same", "doc_id", "size"))
    pieces = pieces.select("_row", "_mark", "doc_id", "size", F.explode(parts).alias("part"))
    words = F.least(F.lit(largest), F.col("size") - F.col("part") * largest).cast("long")
    pieces = pieces.select("_row", "_mark", "doc_id", "part", (F.col("part") * largest).alias("first_word"), words.alias("n_words"))
    needed = sized.agg(F.sum(F.ceil(F.col("size") / largest))).first()[0] or 0
    groups = max(1, math.ceil(needed / group_rows))
    pieces = pieces.withColumn("_group", F.pmod(F.xxhash64("_mark", "part"), F.lit(groups)))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_mark", "part"])
        bins, offsets, made = best_fit(rows["n_words"].tolist(), capacities, overhead, quadratic)
        group = int(rows["_group"].iloc[0])
        return rows[["_row", "part", "first_word", "n_words"]].assign(
            doc_id=rows["doc_id"], bin=[f"{group}-{b}" for b in bins], capacity=np.asarray(made)[bins], place=offsets
        )

    schema = f"_row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, part long, first_word long, n_words long, bin string, capacity long, place long"
    names = [f.split()[0] for f in schema.split(", ")]
    packed = pieces.groupBy("_group").applyInPandas(lambda rows: fill(rows)[names].astype({"doc_id": object}), schema)
    without = sized.filter("size = 0").selectExpr(
        "_row", "doc_id", "0L as part", "0L as first_word", "0L as n_words", "cast(null as string) as bin", "cast(null as long) as capacity", "cast(null as long) as place"
    )
    packed = packed.unionByName(without)
    if not texts:
        return packed
    cut = sized.select("_row", F.explode(_cut(largest)).alias("piece"))
    cut = cut.select(F.col("_row").alias("_r"), F.col("piece.part").alias("_p"), F.col("piece.text").alias("text"))
    return packed.join(cut, (F.col("_row") == F.col("_r")) & (F.col("part") == F.col("_p"))).drop("_r", "_p")


def _cut(largest: int) -> Column:
    """[(part, text)] of ``text`` with ``size`` words; all but the last part have ``largest`` words.

    A part keeps the white space between its words.  What fits one part is left as it is.
    """
    whole = F.array(F.struct(F.lit(0).cast("long").alias("part"), F.col("text").alias("text")))
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / largest))

    def piece(words: Column, part: Column) -> Column:
        text = F.array_join(F.slice(words, (part * largest + 1).cast("int"), F.lit(largest)), "")
        return F.struct(part.alias("part"), text.alias("text"))

    # the words are named once, or each part would split the whole text again
    words = F.array(F.regexp_extract_all("text", F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)")))
    several = F.get(F.transform(words, lambda w: F.transform(parts, lambda p: piece(w, p))), F.lit(0))
    return F.when(F.col("size") <= largest, whole).otherwise(several)


def sequences(docs: DataFrame, packed: DataFrame | None = None, **options) -> DataFrame:
    """(bin, capacity, n_words, doc_ids, text): the packed sequences, their pieces in order.

    Words are joined by one space.  ``docs`` must hold each doc_id once.
    """
    packed = pack(docs, **options) if packed is None else packed
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"))
    pieces = packed.filter("bin is not null").join(docs.select("doc_id", "text"), "doc_id")
    text = F.array_join(F.slice(words, (F.col("first_word") + 1).cast("int"), F.col("n_words").cast("int")), " ")
    pieces = pieces.select("bin", "capacity", F.struct("place", "doc_id", "n_words", text.alias("text")).alias("piece"))
    made = pieces.groupBy("bin", "capacity").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    return made.select(
        "bin",
        "capacity",
        F.aggregate("pieces.n_words", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_words"),
        F.col("pieces.doc_id").alias("doc_ids"),
        F.array_join("pieces.text", " ").alias("text"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("_row")
