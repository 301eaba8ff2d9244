"""Value types per cell and the statistics of each type within a column.

Every function takes typed rows with a weight ``n``: either a frequency table, or plain cells with
n = 1. On plain cells no wide shuffle is needed at all, only one small row per task and column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kolumna.functions import value_types as vt
from kolumna.operators.cells import KEYS
from kolumna.operators.metadata import in_rank_order, ranked
from kolumna.operators.steps import computed

TYPE_KEYS = [*KEYS, "type"]
STAMP = "MM/dd/yyyy, HH:mm:ss"


def date_orders(rows: DataFrame) -> DataFrame:
    """(dataset, column_name, day_first) of the columns with a date-like name: whether more of their cells can be read
    day first only than month first only."""
    weight = F.col("n") if "n" in rows.columns else F.lit(1)
    dated = rows.where(vt.is_date_name(F.col("column_name")) & F.col("value").isNotNull())
    return dated.groupBy(*KEYS).agg((F.sum(weight * vt.order_vote(F.col("value"))) > 0).alias("day_first"))


def with_types(rows: DataFrame, first_year: int = 1850, last_year: int = 2019, order_by_column: bool = False) -> DataFrame:
    """Add ``type`` and the value read as that type.

    In a column with a date-like name a value is a DATE/TIME within the years, or has no type.
    Elsewhere it is REAL, else INTEGER, else TEXT. Nulls have no type. Zero is REAL when written
    with a point. Integers beyond 38 digits have no exact ``whole`` value but a ``number``
    (``long_integers`` has exact figures). Dates such as 03/04/2015 are read month first, 13/04/2015 day first;
    with ``order_by_column`` a column's cells vote on one order for all that can be read both ways.
    """
    if "n" not in rows.columns:
        rows = rows.withColumn("n", F.lit(1).cast("bigint"))
    value = F.col("value")
    plain = vt.plain_number(value)
    date_name = vt.is_date_name(F.col("column_name"))
    if order_by_column:
        rows = rows.join(date_orders(rows), KEYS, "left")
    day_first = F.coalesce("day_first", F.lit(False)) if order_by_column else None
    dated = computed(rows, moment=F.when(date_name, vt.date(value, day_first)))
    kind = (
        F.when(value.isNull(), None)
        .when(date_name, F.when(vt.in_years(F.col("moment"), first_year, last_year), vt.DATE))
        .when(vt.is_real(value), vt.REAL)
        .when(vt.is_integer(value), vt.INTEGER)
        .otherwise(vt.TEXT)
    )
    typed = computed(dated, type=kind)
    numeric = F.col("type").isin(vt.REAL, vt.INTEGER)
    return typed.select(
        *KEYS,
        "value",
        "n",
        "type",
        F.when(numeric, plain.try_cast("double")).alias("number"),
        F.when(F.col("type") == vt.INTEGER, plain.try_cast("decimal(38,0)")).alias("whole"),
        F.when(F.col("type") == vt.DATE, F.col("moment")).alias("moment"),
    )


def summaries(typed: DataFrame) -> DataFrame:
    """The figures of every type in every column, in one pass.

    Values without a type form a row with a null type. Values of equal weight are summarised by Spark's own stable aggregates; a column has few
    different weights (at most the square root of twice its cells), and those summaries are then
    merged around the common mean.
    """
    same_weight = typed.groupBy(*TYPE_KEYS, "n").agg(
        F.count("*").alias("values"),
        F.count("type").alias("typed"),
        F.avg("number").alias("part_mean"),
        F.stddev_pop("number").alias("part_stddev"),
        F.sum(F.length("value")).alias("part_length"),
        *[f(c).alias(f"{f.__name__}_{c}") for f in (F.max, F.min) for c in ("number", "whole", "moment")],
    )
    weight = F.col("weight")
    column = Window.partitionBy(*TYPE_KEYS)
    around = same_weight.withColumn("weight", F.col("n") * F.col("values")).withColumn(
        "mean", F.sum(weight * F.col("part_mean")).over(column) / F.sum("weight").over(column)
    )
    spread = F.col("part_stddev") * F.col("part_stddev") + F.pow(F.col("part_mean") - F.col("mean"), 2)
    return around.groupBy(*TYPE_KEYS).agg(
        F.sum("weight").alias("count"),
        F.sum("typed").alias("count_typed"),
        F.max("mean").alias("mean"),
        F.sqrt(F.sum(weight * spread) / F.sum("weight")).alias("stddev"),
        (F.sum(F.col("n") * F.col("part_length")) / F.sum("weight")).alias("average_length"),
        *[F.max(c).alias(c) for c in ("max_number", "max_whole", "max_moment")],
        *[F.min(c).alias(c) for c in ("min_number", "min_whole", "min_moment")],
    )


def integer_stats(typed: DataFrame) -> DataFrame:
    extremes = [F.col("max_whole").alias("max_value"), F.col("min_whole").alias("min_value")]
    rows = summaries(typed).where(F.col("type") == vt.INTEGER)
    return rows.select(*KEYS, "count", *extremes, "mean", "stddev")


def real_stats(typed: DataFrame) -> DataFrame:
    extremes = [F.col("max_number").alias("max_value"), F.col("min_number").alias("min_value")]
    rows = summaries(typed).where(F.col("type") == vt.REAL)
    return rows.select(*KEYS, "count", *extremes, "mean", "stddev")


def date_stats(typed: DataFrame) -> DataFrame:
    """Count, latest and earliest moment as text."""
    rows = summaries(typed).where(F.col("type") == vt.DATE)
    return rows.select(*KEYS, "count", *_date_extremes())


def _date_extremes() -> list[Column]:
    return [F.date_format(f"{end}_moment", STAMP).alias(f"{end}_value") for end in ("max", "min")]


def text_lengths(typed: DataFrame) -> DataFrame:
    """Count and mean length over all TEXT cells."""
    rows = summaries(typed).where(F.col("type") == vt.TEXT)
    return rows.select(*KEYS, "count", "average_length")


def text_extremes(typed_frequencies: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` shortest and ``k`` longest different TEXT values; equal lengths in value order."""
    texts = typed_frequencies.where(F.col("type") == vt.TEXT).select(*KEYS, "value", F.length("value").alias("size"))
    short = ranked(texts, k, F.asc("size"), F.asc("value"))
    long = ranked(texts, k, F.desc("size"), F.asc("value"))
    shortest = short.groupBy(*KEYS).agg(in_rank_order(F.col("value")).alias("shortest_values"))
    longest = long.groupBy(*KEYS).agg(in_rank_order(F.col("value")).alias("longest_values"))
    return shortest.join(longest, KEYS)


def text_stats(typed_frequencies: DataFrame, k: int = 5) -> DataFrame:
    return text_lengths(typed_frequencies).join(text_extremes(typed_frequencies, k), KEYS)


def type_stats(typed_frequencies: DataFrame) -> DataFrame:
    """One row per column and type found in it; what a type does not have is null.

    Numbers and dates have their extremes in fields of their own type.
    """
    kind = F.col("type")
    latest, earliest = _date_extremes()
    figures = summaries(typed_frequencies).where(F.col("count_typed") > 0).select(
        *TYPE_KEYS,
        "count",
        F.col("max_number").alias("max_value"),
        F.col("min_number").alias("min_value"),
        latest.alias("max_date"),
        earliest.alias("min_date"),
        "mean",
        "stddev",
        F.when(kind == vt.TEXT, F.col("average_length")).alias("average_length"),
    )
    extremes = text_extremes(typed_frequencies).withColumn("type", F.lit(vt.TEXT))
    return figures.join(extremes, TYPE_KEYS, "left")


def data_types(stats: DataFrame) -> DataFrame:
    """The type rows of a column as one array, in type order (at most four entries)."""
    fields = [c for c in stats.columns if c not in KEYS]
    return stats.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("data_types"))
