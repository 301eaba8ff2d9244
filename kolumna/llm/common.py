"""What the operators share: readers, record batches of texts, running totals, connected classes."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kolumna.session import prepare, written

#: Bytes in a record batch handed to Python, so that a batch of long texts still fits a worker.
BATCH_BYTES = 1 << 20

#: Words are runs of anything but these six ASCII blanks.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table; its record batches are bounded by bytes."""
    return batched(prepare(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def batched(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def sealed(df: DataFrame, *replaced: str) -> tuple[DataFrame, dict[str, str], Callable[..., DataFrame]]:
    """``df`` without the columns of ``replaced`` and with plain names for all others, these names, and a
    function that takes a result back to the own names, followed by new columns.

    Between the two no name of a caller meets one of an operator, whatever dots or underscores it has.
    """
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    gone = {name.lower() for name in replaced}
    kept = [(name, f"c{i}") for i, name in enumerate(df.columns) if name.lower() not in gone]

    def opened(result: DataFrame, *new: str) -> DataFrame:
        return result.select(*[F.col(inner).alias(name) for name, inner in kept], *new)

    return plain.select(*[inner for _, inner in kept]), dict(kept), opened


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch that returns a dict of columns or a batch."""
    fields = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(function(batch), schema=fields)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


_BASE = 0x9E3779B97F4A7C15
_SYMBOLS = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(n, base, dtype=np.uint64)
        factors[:1] = 1
        made.append(np.multiply.accumulate(factors))
    return made[0], made[1]


def prefix_hashes(data: np.ndarray, up: np.ndarray) -> np.ndarray:
    """s, so that (s[e] - s[b]) * down[b] is a hash of data[b:e] that does not depend on its place."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_SYMBOLS[data] * up[: len(data)], out=sums[1:])
    return sums


def mixed_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Written to the folder that driver and executors share and read back: cuts lineage, so that a
    lost executor costs one stage only."""
    return written(df, name)


def running_total(
    df: DataFrame, groups: list[str], order: list[Column], spread: Column, amount: str, total: str, buckets: int
) -> DataFrame:
    """Add ``total``: the sum of ``amount`` over the rows before this one in its group, by ``order``.

    ``spread`` in [0, 1) is even and never decreases in that order; it cuts every group into
    ``buckets``, so that the largest group is ordered by many tasks. Bucket sums are added up in two steps, so
    that only about the square root of their number meets in one window.
    """
    across = max(1, math.isqrt(buckets))
    cut = df.withColumn("__bucket", F.least(F.floor(spread * buckets), F.lit(buckets - 1)).cast("long"))
    sums = cut.groupBy(*groups, "__bucket").agg(F.sum(amount).alias("__amount"))
    sums = sums.withColumn("__shelf", F.floor(F.col("__bucket") / across))
    shelves = sums.groupBy(*groups, "__shelf").agg(F.sum("__amount").alias("__amount"))

    def before(order: str, *parts: str) -> Column:
        window = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("__amount").over(window), F.lit(0))

    named = [F.col(g).alias(f"__{g}") for g in groups]
    starts = sums.select(*named, "__bucket", "__shelf", before("__bucket", *groups, "__shelf").alias("__in_shelf"))
    shelves = shelves.select(*groups, F.col("__shelf").alias("__s"), before("__shelf", *groups).alias("__shelf_start"))
    starts = starts.join(shelves, (F.col("__shelf") == F.col("__s")) & _all(F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups))
    starts = starts.select(*[f"__{g}" for g in groups], F.col("__bucket").alias("__b"), (F.col("__shelf_start") + F.col("__in_shelf")).alias("__start"))
    inside = Window.partitionBy(*groups, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = cut.withColumn("__inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    same = (F.col("__bucket") == F.col("__b")) & _all(F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups)
    return own.join(starts, same).select(*df.columns, (F.col("__start") + F.col("__inside")).alias(total))


def _all(conditions: Iterable[Column]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def connected(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, label) of every node of ``edges`` (a long, b long): label is the smallest node reachable.

    Alternates two steps until the stars stand still: hang every larger neighbour on the smallest
    one, then hang all smaller ones on it. Rounds grow with the logarithm of the longest chain. Per
    node only a minimum is aggregated; no class is ever gathered. Every step is written: a lost executor
    costs one step, and the minima are shuffled anew for their join, so that Spark can split the node in
    the middle of a large star.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, state = saved(edges, name), None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        least = saved(least, name)
        large = both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        large = saved(large, name)
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n"), name)
        small = large.join(least, F.col("u") == F.col("n")).select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        edges = saved(small.distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"connected: not settled after {max_rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
