"""Shards by extendible hashing: a directory over hash prefixes in which only crowded buckets split.

A bucket is a prefix of the hash bits; while its rows exceed the byte limit it splits on the next
bit. The directory follows from byte sums of prefixes: a row belongs to its shortest prefix that fits.
Sums are taken at a fine prefix first, and only prefixes that are still crowded there go deeper.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kolumna.llm.common import saved, sealed

HASH_BITS = 60
#: Bits by which the fine prefixes of a level are longer than the directory is expected to be.
SPARE_BITS = 4
#: Equal rows cannot be split by their hash; they are dealt into pages, by tasks of about this many.
PAGE_ROWS = 50_000


def row_hash(id_column: str, text_column: str) -> Column:
    """60 hash bits of a row, from its id and text."""
    named = F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("long")


def n_bytes(text_column: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text_column).cast("string")), F.lit(0)).cast("long")


def _prefix(value: Column, bits: int) -> Column:
    return F.shiftright(value, HASH_BITS - bits) if bits else F.lit(0).cast("long")


def _level(sizes: DataFrame, limit: int, least: int, bits: int) -> DataFrame:
    """(node, depth) of the prefixes of ``bits`` bits in ``sizes`` (h, bytes, n): the depth from
    ``least`` on at which the bucket fits, null if it fits nowhere. A single row always fits."""
    fine = sizes.groupBy(_prefix(F.col("h"), bits).alias("node")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    fine = saved(fine, "fine")
    depths = F.sequence(F.lit(least), F.lit(bits))
    climbed = fine.select("node", "bytes", "n", F.explode(depths).alias("depth"))
    climbed = climbed.withColumn("bucket", F.expr(f"shiftright(node, {bits} - depth)"))
    fits = climbed.groupBy("depth", "bucket").agg(F.sum("bytes").alias("b"), F.sum("n").alias("m")).where((F.col("b") <= limit) | (F.col("m") <= 1))
    found = climbed.select("node", "depth", "bucket").join(fits.select("depth", "bucket"), ["depth", "bucket"])
    found = found.groupBy("node").agg(F.min("depth").alias("depth"))
    return saved(fine.select("node").join(found, "node", "left"), "directory")


def directory(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """Levels (bits, (node, depth)) of the directory for ``rows`` (h, bytes); a null depth points to the next level."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    sizes = rows.select("h", "bytes", F.lit(1).cast("long").alias("n"))
    levels: list[tuple[int, DataFrame]] = []
    least, bits = 0, min(HASH_BITS, SPARE_BITS + max(0, math.ceil(math.log2(max(1, total / limit)))))
    while True:
        nodes = _level(sizes, limit, least, bits)
        levels.append((bits, nodes))
        crowded = nodes.where("depth is null").select(F.col("node").alias("crowded"))
        if bits == HASH_BITS or crowded.isEmpty():
            return levels
        sizes = sizes.join(crowded, _prefix(F.col("h"), bits) == F.col("crowded"), "left_semi")
        least, bits = bits + 1, min(HASH_BITS, bits + 8)



def assigned(docs: DataFrame, limit: int, id_column: str = "doc_id", text_column: str = "text", shard: str = "shard", size: str = "n_bytes") -> DataFrame:
    """``docs`` with the bytes of its text and its shard, named by the prefix of hash bits.

    The texts of a shard hold ``limit`` bytes at most, unless it is a single row. Equal rows (same id
    and text) beyond the limit share all bits and get page numbers behind them. A null text has no
    bytes, a null id hashes as an empty one; an empty table stays empty; columns with a result's name
    are replaced. Without need to split there is one shard with an empty name.
    """
    docs, names, opened = sealed(docs, shard, size)
    return opened(_assigned(docs, limit, names[id_column], names[text_column], shard, size), size, shard)


def _assigned(docs: DataFrame, limit: int, id_column: str, text_column: str, shard: str, size: str) -> DataFrame:
    docs = docs.withColumns({"__h": row_hash(id_column, text_column), size: n_bytes(text_column)})
    levels = directory(docs.select(F.col("__h").alias("h"), F.col(size).alias("bytes")), limit)
    depth: Column = F.lit(None).cast("int")
    for k, (bits, nodes) in enumerate(levels):
        # The fine prefixes are a few times as many as the shards; Spark broadcasts them only while small.
        docs = docs.join(nodes.select(F.col("node").alias(f"__node{k}"), F.col("depth").alias(f"__depth{k}")), _prefix(F.col("__h"), bits) == F.col(f"__node{k}"), "left")
        depth = F.coalesce(depth, F.col(f"__depth{k}"))
    docs = docs.withColumn("__depth", F.coalesce(depth, F.lit(HASH_BITS)))
    named = docs.withColumn(shard, F.when(F.col("__depth") == 0, "").otherwise(F.expr(f"lpad(bin(shiftright(__h, {HASH_BITS} - __depth)), __depth, '0')")))
    bits, nodes = levels[-1]
    equal = nodes.where("depth is null")
    if not equal.isEmpty():
        named = paged(named, limit, size, shard, depth.isNull())
    return named


def paged(docs: DataFrame, limit: int, size: str, shard: str, crowded: Column) -> DataFrame:
    """Deal rows with all bits in common into pages: (task, page) behind the name. Hashes that differ in
    their texts' sizes do not meet here, as equal rows have equal sizes."""
    crowds = docs.where(crowded).groupBy("__h").agg(F.count("*").alias("__n")).withColumnRenamed("__h", "__crowd")
    docs = docs.join(crowds, F.col("__h") == F.col("__crowd"), "left").withColumn("__row", F.monotonically_increasing_id())
    few = docs.where("__crowd is null")
    many = docs.where("__crowd is not null").withColumn("__part", F.expr(f"pmod(xxhash64(__row), cast(ceil(__n / {PAGE_ROWS}) as bigint))"))
    place = F.row_number().over(Window.partitionBy("__h", "__part").orderBy("__row")) - 1
    page = F.floor(place / F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col(size), F.lit(1)))))
    many = many.withColumn(shard, F.concat(shard, F.lit("."), F.col("__part").cast("string"), F.lit("."), page.cast("string"))).drop("__part")
    return few.unionByName(many)


def shard_sql(limit: int) -> str:
    return f"""
with rows as (
    select doc_id, coalesce(strlen(text), 0) as bytes,
        cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, {HASH_BITS // 4}) as bigint) as h
    from documents
),
climbed as (select doc_id, bytes, h, d, h >> ({HASH_BITS} - d) as bucket from rows, (select unnest(range(0, {HASH_BITS + 1})) as d)),
fits as (select d, bucket from climbed group by d, bucket having sum(bytes) <= {limit} or count(*) <= 1),
leaf as (select doc_id, h, bytes, min(d) as d from climbed join fits using (d, bucket) group by doc_id, h, bytes)
select doc_id, cast(bytes as bigint) as n_bytes,
    case when d = 0 then '' else substr(lpad(bin(h), {HASH_BITS}, '0'), 1, d) end as shard
from leaf"""
