"""Counts, empties, distinct values and most frequent values of every column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kolumna.operators.cells import KEYS, quoted


def is_empty(value: Column) -> Column:
    """Null, or text that reads as NaN."""
    return value.isNull() | F.lower(F.trim(value)).isin("nan", "+nan", "-nan")


def cell_counts(frequencies: DataFrame) -> DataFrame:
    """Distinct, non-empty, empty and all cells per column in one pass over the frequencies.

    Both nulls and NaN are empty, so the two counts add up to all cells. Nulls are no distinct
    value, NaN is one.
    """
    n = F.col("n")
    empty = is_empty(F.col("value"))
    return frequencies.groupBy(*KEYS).agg(
        F.count("value").alias("number_distinct_values"),
        F.sum(F.when(empty, 0).otherwise(n)).alias("number_non_empty_cells"),
        F.sum(F.when(empty, n).otherwise(0)).alias("number_empty_cells"),
        F.sum(n).alias("number_cells"),
    )


def cell_count_errors(counts: DataFrame) -> DataFrame:
    """Columns whose empty and non-empty cells do not add up to all cells: none, if all is well."""
    parts = F.col("number_non_empty_cells") + F.col("number_empty_cells")
    return counts.where(parts != F.col("number_cells"))


def ranked(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each column. Spark cuts each task's rows to k per column before the
    shuffle, so a large column does not meet in one task."""
    window = Window.partitionBy(*KEYS).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def in_rank_order(value: Column) -> Column:
    """Collect at most k ranked values per column as an array in rank order; nulls are left out."""
    pairs = F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct("rank", value.alias("v")))))
    return F.transform(pairs, lambda pair: pair["v"])


def frequent_values(frequencies: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values per column; ties in value order; [] for an all-null column."""
    order = [F.col("value").isNull(), F.desc("n"), F.asc("value")]
    top = ranked(frequencies, k, *order)
    return top.groupBy(*KEYS).agg(in_rank_order(F.col("value")).alias("frequent_values"))


def frequent_value_counts(frequencies: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values per column, each written ``value->count``."""
    top = ranked(frequencies, k, F.col("value").isNull(), F.desc("n"), F.asc("value"))
    text = F.when(F.col("value").isNotNull(), F.concat_ws("->", "value", F.col("n").cast("string")))
    return top.groupBy(*KEYS).agg(in_rank_order(text).alias(f"frequent_values->counts_(top_{k})"))


def wide_distinct_counts(df: DataFrame, dataset: str) -> DataFrame:
    """Distinct counts straight from the wide table, to check the long way against."""
    counts = df.agg(*[F.count_distinct(F.col(quoted(c)).cast("string")).alias(c) for c in df.columns])
    long = counts.unpivot([], [F.col(quoted(c)) for c in df.columns], "column_name", "number_distinct_values")
    return long.select(F.lit(dataset).alias("dataset"), "column_name", "number_distinct_values")
