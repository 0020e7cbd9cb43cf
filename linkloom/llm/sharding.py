"""Sharding by extendible hashing.

The directory is indexed by the first bits of the md5 of doc_id.  A shard is a prefix; only shards
above the byte limit split, on one more bit, until all fit.  The outcome is the same whatever the
order of the splits: a document's shard is its shortest prefix whose documents fit together.  So
the bytes are summed once for prefixes a little longer than needed, and rolled up bit by bit;
only where even those are too full are all ``BITS`` looked at.

Rows with one and the same hash (repeated ids) cannot be told apart by bits.  Where they alone
pass the limit their bucket gets overflow pages that fit.  Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import col, fresh, running_start, table
from linkloom.session import stored

SHARD_BYTES = 16 << 20
#: A small corpus gets smaller shards, so that it still makes about so many, but none below LEAST_BYTES.
SHARDS = 64
LEAST_BYTES = 64 << 10
BITS = 32
_SPARE_BITS = 3


def _leaves(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """(cell, depth, bytes): the least depth from ``low`` to ``high`` at which each cell's prefix fits.

    ``cells`` (cell, bytes) are prefixes of ``high`` bits; depth is null where not even those fit.
    """
    levels = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
    sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("total")).filter(F.col("total") <= limit)
    fits = levels.join(sums.hint("merge"), ["depth", "prefix"]).groupBy("cell").agg(F.min(F.struct("depth", "total")).alias("leaf"))
    return cells.select("cell").join(fits, "cell", "left").select("cell", F.col("leaf.depth").alias("depth"), F.col("leaf.total").alias("bytes"))


def directory(sized: DataFrame, limit: int, total: int) -> tuple[int, DataFrame, DataFrame]:
    """Bits and rows of the directory of ``sized`` (hash, bytes), ``total`` bytes, and the rows below its full entries.

    The first table is (cell, depth, bytes), the second (hash, depth, bytes) for cells that do not
    fit; a null depth there means overflow pages.
    """
    bits = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + _SPARE_BITS)
    cell = F.shiftright("hash", BITS - bits)
    cells = stored(sized.groupBy(cell.alias("cell")).agg(F.sum("bytes").alias("bytes")))
    top = stored(_leaves(cells, 0, bits, limit))
    full = top.filter("depth is null").select("cell")
    rest = sized.withColumn("cell", cell).join(full, "cell", "left_semi")
    rest = rest.groupBy(F.col("hash").alias("cell")).agg(F.sum("bytes").alias("bytes"))
    return bits, top, stored(_leaves(rest, bits + 1, BITS, limit)) if bits < BITS else top.limit(0)


def assign(docs: DataFrame, limit: int = SHARD_BYTES, shards: int = 1) -> DataFrame:
    """``docs`` with shard, depth, n_bytes and shard_bytes.

    ``limit`` is lowered to the corpus' bytes over ``shards``, but not below ``LEAST_BYTES``.

    ``shard`` is ``b`` and the prefix's bits, of an overflow page also its name; ``n_bytes`` the
    length of the text in UTF-8, 0 for null.  A null doc_id hashes like the empty text.  A text
    longer than the limit ends alone or with empty ones in a shard above the limit.
    """
    names = {n: fresh(docs, n) for n in ("shard", "depth", "n_bytes", "shard_bytes")}
    h, c, tie = fresh(docs, "_hash"), fresh(docs, "_cell"), fresh(docs, "_tie")
    size = names["n_bytes"]
    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10)
    rows = docs.withColumn(h, hashed.cast("long")).withColumn(size, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    sized = stored(rows.select(col(h).alias("hash"), col(size).alias("bytes")))
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    if shards > 1:
        limit = min(limit, max(LEAST_BYTES, total // shards))
    bits, top, below = directory(sized, limit, total)

    def found(left: DataFrame, entries: DataFrame, key: str, how: str) -> DataFrame:
        entries = entries.select(F.col("cell").alias("_entry"), F.col("depth").alias("_depth"), F.col("bytes").alias("_bytes"))
        return left.join(entries, left[key] == entries["_entry"], how).drop("_entry")

    def named(df: DataFrame) -> DataFrame:
        bit_text = F.expr(f"case when _depth = 0 then '' else lpad(bin(shiftright(`{h}`, {BITS} - _depth)), _depth, '0') end")
        out = df.withColumn(names["shard"], F.concat(F.lit("b"), bit_text)).withColumn(names["depth"], F.col("_depth").cast("int"))
        return out.withColumn(names["shard_bytes"], F.col("_bytes").cast("long"))

    wanted = [col(x) for x in docs.columns] + [col(names[n]) for n in ("shard", "depth", "n_bytes", "shard_bytes")]
    if below.limit(1).count() == 0:
        return named(found(rows.withColumn(c, F.shiftright(col(h), BITS - bits)), top, c, "inner")).select(*wanted)
    rows = rows.withColumn(c, F.shiftright(col(h), BITS - bits))
    fitting = named(found(rows, top.filter("depth is not null"), c, "inner")).select(*wanted)
    deeper = named(found(rows, below.filter("depth is not null"), h, "inner")).select(*wanted)
    over = below.filter("depth is null").select(F.col("cell").alias("_entry"))
    paged = rows.join(over, rows[h] == over["_entry"]).drop("_entry").withColumn(tie, F.xxhash64("text"))
    paged = running_start(paged, h, [tie, size], size, "_start", max(1, math.ceil(sized.count() / 50_000)))
    # half-full pages hold one more text of up to half the limit; a longer one has its own page
    page = F.when(col(size) > limit // 2, F.concat(F.lit("t"), F.col("_start").cast("string"))).otherwise(
        F.concat(F.lit("p"), F.floor(F.col("_start") / max(1, limit // 2)).cast("string"))
    )
    paged = paged.withColumn("_page", page)
    pages = paged.groupBy(col(h).alias("_h"), F.col("_page").alias("_p")).agg(F.sum(size).alias("_bytes"))
    paged = paged.join(pages, (paged[h] == pages["_h"]) & (paged["_page"] == pages["_p"])).withColumn("_depth", F.lit(BITS))
    paged = named(paged).withColumn(names["shard"], F.concat(col(names["shard"]), F.lit("."), F.col("_page")))
    return fitting.unionByName(deeper).unionByName(paged.select(*wanted))


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Write each shard's rows to a folder of its own; no task holds more than whole shards."""
    assigned = assign(docs, limit)
    name = assigned.columns[len(docs.columns)]
    assigned.repartition(name).write.partitionBy(name).parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=SHARDS).drop("text")


SQL = f"""
with sized as (
    select doc_id, cast(strlen(coalesce(text, '')) as bigint) as n_bytes,
           cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 8) as bigint) as h
    from documents
), bound as (
    select least({SHARD_BYTES}, greatest({LEAST_BYTES}, sum(n_bytes) // {SHARDS})) as most from sized
), levels as (
    select s.*, d.depth, s.h >> ({BITS} - d.depth) as prefix
    from sized s, (select unnest(range(0, {BITS + 1})) as depth) d
), sums as (
    select depth, prefix, sum(n_bytes) as total from levels group by depth, prefix
    having sum(n_bytes) <= (select most from bound)
), leaves as (
    select l.doc_id, l.h, l.n_bytes, l.depth, l.prefix, u.total,
           row_number() over (partition by l.doc_id order by l.depth) as k
    from levels l join sums u on l.depth = u.depth and l.prefix = u.prefix
)
select doc_id, 'b' || case when depth = 0 then '' else lpad(format('{{:b}}', prefix), cast(depth as integer), '0') end as shard,
       cast(depth as integer) as depth, n_bytes, cast(total as bigint) as shard_bytes
from leaves where k = 1
"""
