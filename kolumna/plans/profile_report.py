"""The column profile from cells to records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolumna.operators import itemsets, metadata, profile
from kolumna.operators.cells import KEYS, value_frequencies
from kolumna.session import written


def column_metadata(frequencies: DataFrame, k: int = 5) -> DataFrame:
    """One record per column: counts, empties, distinct values and most frequent values."""
    counts = metadata.cell_counts(frequencies).drop("number_cells")
    return counts.join(metadata.frequent_values(frequencies, k), KEYS, "left")


def column_records(frequencies: DataFrame, first_year: int = 1850, last_year: int = 2019) -> DataFrame:
    """One record per column with its metadata, type statistics and itemset.

    Values without a type, such as those of a date column outside the years, are in none of the
    statistics; ``number_untyped_cells`` counts them. Several aggregates read the typed values, so these are written
    once: a value is counted and typed once.
    """
    typed = written(profile.with_types(frequencies, first_year, last_year), "typed-frequencies")
    frequencies = typed.select(*KEYS, "value", "n")
    stats = profile.type_stats(typed)
    untyped = typed.groupBy(*KEYS).agg(
        F.sum(F.when(F.col("type").isNull() & F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("number_untyped_cells")
    )
    return (
        column_metadata(frequencies)
        .join(profile.data_types(stats), KEYS, "left")
        .join(itemsets.column_itemsets(stats), KEYS, "left")
        .join(untyped, KEYS, "left")
        .withColumn("itemset", F.coalesce("itemset", F.lit("")))
    )


def run(cell_rows: DataFrame, first_year: int = 1850, last_year: int = 2019) -> DataFrame:
    """The records of all columns of all datasets.

    The typed frequency table feeds eight aggregates, so it is written once to the shared folder: the
    source is read once and a lost executor costs no second count.
    """
    return column_records(value_frequencies(cell_rows), first_year, last_year)
