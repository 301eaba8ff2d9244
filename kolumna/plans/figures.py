"""Figures that a job counts while it reads: no scan of their own.

Metrics are observed on the plan that reads the data, so they are there as soon as it has been written, and
count what that reading has seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kolumna.operators import reference_sets
from kolumna.operators.cells import value_frequencies
from kolumna.plans.profile_report import column_records
from kolumna.session import written
from kolumna.sources.files import within_size


def observed(df: DataFrame, name: str, **figures: Column) -> tuple[DataFrame, DataFrame, Observation]:
    """``df`` written and read back, and what was observed while it was computed."""
    seen = Observation(name)
    return written(df.observe(seen, *[column.alias(figure) for figure, column in figures.items()]), name), seen


def rows(spark: SparkSession, *seen: Observation) -> DataFrame:
    """(figure, value): nulls, as sums of nothing are, count as 0."""
    found = [(figure, int(value or 0)) for one in seen for figure, value in one.get.items()]
    return spark.createDataFrame(found, "figure string, value bigint")


def profile(cell_rows: DataFrame, first_year: int = 1850, last_year: int = 2019) -> tuple[DataFrame, DataFrame]:
    """The records of ``profile_report.run``, written, and the figures of the same run: cells read, those without a value,
    different values, columns, and cells without a type."""
    cells = Observation("cells")
    counted = value_frequencies(cell_rows.observe(cells, F.count(F.lit(1)).alias("cells"), F.count_if(F.col("value").isNull()).alias("null_cells")))
    frequencies, values = observed(counted, "frequencies", different_values=F.count("value"))
    records, columns = observed(
        column_records(frequencies, first_year, last_year), "records",
        columns=F.count(F.lit(1)), untyped_cells=F.sum("number_untyped_cells"),
    )
    return records, rows(cell_rows.sparkSession, cells, values, columns)


def chosen_files(files: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The files below the limit, written, and how many files and bytes were listed and left out; one listing."""
    listed = Observation("files")
    over = F.lit(False) if limit is None else F.col("length") >= limit
    seen = files.observe(
        listed, F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.count_if(over).alias("files_left_out"),
        F.sum(F.when(over, F.col("length"))).alias("bytes_left_out"),
    )
    return written(within_size(seen, limit), "chosen-files"), rows(files.sparkSession, listed)


def labelled_values(sheet: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The labelled values of a sheet, written, and how many of its rows have a list that cannot be read; one reading."""
    read = Observation("sheet")
    unread = reference_sets.is_unread(sheet)
    found = reference_sets.labelled_values(sheet.observe(read, F.count(F.lit(1)).alias("sheet_rows"), F.count_if(unread).alias("unread_lists")))
    return written(found, "labelled"), rows(sheet.sparkSession, read)
