"""Records of CSV files whose quoted fields may hold line breaks, read by many tasks a file.

Spark reads such a file either line by line, which cuts records, or whole, in one task.  Here the
lines are read in splits and put together again:

* For each line two questions are answered from its text alone: if a record begins with it, does it
  end inside a quoted field; and if it begins inside one, does it end inside one.  A quote within
  an unquoted field is no quote, as in Spark's own reader.
* Only lines with quotes change anything.  What a split does to the state is a function of one bit, and a
  prefix over the splits of a file (a row each) tells in which state each split begins.
* So the lines at which a record with line breaks begins and ends are known.  Their lines, and
  those between, are numbered and joined to their record; all other lines are records as they stand.

No file is read by one task unless it cannot be split (gzip).  A quote that is never closed ends
with its line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.operators.joins import broadcast_if_small
from linkloom.session import stored

_INSIDE = r'(?:[^"]++|"")*+'
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|)'
_ENDS_OPEN = rf'(?:{_FIELD},)*+"{_INSIDE}\z'
#: A record begins here and the line ends inside a quoted field.
OPENS = rf"^{_ENDS_OPEN}"
#: The line begins inside a quoted field and ends inside one: the same, or another after it.
STAYS = rf'^{_INSIDE}(?:\z|"[^,]*+,{_ENDS_OPEN})'

_BLOCK = ["file", "block"]


def _lines(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(file, block, at, value): the lines of a split are numbered by ``at`` without gaps."""
    text = spark.read.option("pathGlobFilter", glob).option("lineSep", "\n").text(path)
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return text.select(*place, F.monotonically_increasing_id().alias("at"), "value")


def _after(last: Column, turns: Column, start: Column) -> Column:
    """The state after ``turns`` changes, from the last line that fixed it or from the start."""
    fixed = last["state"] != ((turns - last["turns"]) % 2 == 1)
    return F.when(last.isNotNull(), fixed).otherwise(start != (turns % 2 == 1))


def _edges(lines: DataFrame) -> DataFrame:
    """(file, block, at, opens): lines in which a quoted field with a line break begins, or ends."""
    tells = lines.filter(F.contains("value", F.lit('"'))).select(
        *_BLOCK, "at", F.col("value").rlike(OPENS).alias("opens"), F.col("value").rlike(STAYS).alias("stays")
    )
    tells = tells.filter("opens or not stays")
    in_order = Window.partitionBy(*_BLOCK).orderBy("at")
    turn = F.when(F.col("opens") & ~F.col("stays"), 1).otherwise(0)
    tells = tells.withColumn("turns", F.sum(turn).over(in_order))
    fixed = F.when(F.col("opens") == F.col("stays"), F.struct("at", F.col("opens").alias("state"), "turns"))
    tells = stored(tells.withColumn("last", F.max(fixed).over(in_order)))

    # what each split does to the state, and the state in which it begins
    ends = tells.groupBy(*_BLOCK).agg(F.max("turns").alias("own"), F.max("last").alias("last"))
    by_block = Window.partitionBy("file").orderBy("block")
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("turns", F.sum("own").over(by_block))
    state = F.col("last.state") != ((F.col("own") - F.col("last.turns")) % 2 == 1)
    fixed = F.when(F.col("last").isNotNull(), F.struct("block", state.alias("state"), "turns"))
    starts = ends.select(*_BLOCK, F.coalesce(F.sum("own").over(before), F.lit(0)).alias("sofar"), F.max(fixed).over(before).alias("fixed"))
    starts = starts.select(*_BLOCK, _after(F.col("fixed"), F.col("sofar"), F.lit(False)).alias("start"))

    # a row a split, so this side may be sent to all; measured all the same
    starts = broadcast_if_small({"starts": starts})["starts"]
    after = _after(F.col("last"), F.col("turns"), F.col("start"))
    states = tells.join(starts, _BLOCK).withColumn("after", after)
    was = F.coalesce(F.lag("after").over(in_order), F.col("start"))
    return states.withColumn("was", was).filter("was <> after").select(*_BLOCK, "at", F.col("after").alias("opens"))


def _glued(edges: DataFrame, extents: DataFrame) -> DataFrame:
    """(file, block, at, in_block, from_at): lines of records with line breaks, with the place of the record's first."""
    here = Window.partitionBy(*_BLOCK).orderBy("at")
    edges = edges.withColumn("next", F.lead("at").over(here))
    # of a record that is open at the end of its split the next edge is the first one of a later split
    firsts = edges.groupBy(*_BLOCK).agg(F.min("at").alias("first"))
    later = F.lead(F.struct("block", F.col("first").alias("at"))).over(Window.partitionBy("file").orderBy("block"))
    firsts = firsts.select(*_BLOCK, later.alias("later"))
    begun = edges.filter("opens")
    inside = begun.filter("next is not null").select(*_BLOCK, F.explode(F.sequence("at", "next")).alias("line"), F.col("block").alias("in_block"), F.col("at").alias("from_at"))
    across = begun.filter("next is null").join(firsts, _BLOCK).filter("later is not null")
    across = across.select(F.col("file").alias("_file"), F.col("block").alias("in_block"), F.col("at").alias("from_at"), "later")
    touched = extents.join(across, (F.col("file") == F.col("_file")) & F.col("block").between(F.col("in_block"), F.col("later.block")))
    low = F.when(F.col("block") == F.col("in_block"), F.col("from_at")).otherwise(F.col("low"))
    high = F.when(F.col("block") == F.col("later.block"), F.col("later.at")).otherwise(F.col("high"))
    across = touched.select(*_BLOCK, F.explode(F.sequence(low, high)).alias("line"), "in_block", "from_at")
    return inside.unionByName(across).withColumnRenamed("line", "at")


def read_records(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(file, record): the text of each record of the files but their first, the header; blank lines are none."""
    lines = _lines(spark, path, glob)
    extents = stored(lines.groupBy(*_BLOCK).agg(F.min("at").alias("low"), F.max("at").alias("high")))
    small = broadcast_if_small({"glued": stored(_glued(stored(_edges(lines)), extents)), "heads": extents.filter("block = 0").select("file", "low")})
    joined = lines.join(small["glued"], [*_BLOCK, "at"], "left")

    alone = joined.filter("from_at is null").select("file", "block", "at", "value")
    held = joined.filter("from_at is not null").groupBy("file", F.col("in_block").alias("block"), F.col("from_at").alias("at"))
    parts = F.array_sort(F.collect_list(F.struct(F.col("block").alias("b"), F.col("at").alias("a"), "value")))
    held = held.agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    heads = small["heads"].select(F.col("file").alias("_file"), F.col("low").alias("_low"))
    is_head = (F.col("file") == F.col("_file")) & (F.col("block") == 0) & (F.col("at") == F.col("_low"))
    records = alone.unionByName(held).join(heads, is_head, "left_anti")
    return records.select("file", F.regexp_replace("value", r"\r\z", "").alias("record")).filter(F.trim("record") != "")


def read_positional(spark: SparkSession, path: str, columns: Sequence[str], glob: str = "*.csv") -> DataFrame:
    """``columns`` and ``file``, by position; missing and further fields are tolerated."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    rows = read_records(spark, path, glob).select("file", F.from_csv("record", schema, options).alias("r"))
    return rows.select("r.*", F.url_decode(F.substring_index("file", "/", -1)).alias("file"))
