"""Cells (dataset, column_name, value) and value frequencies (…, n): the base of all profiles."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["dataset", "column_name"]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cells(df: DataFrame, dataset: str, columns: list[str] | None = None) -> DataFrame:
    """Wide to long: one row per cell, every value as text cast from the column's own type.

    Only the listed columns are read. Nulls stay. Names are quoted, so dots are part of the name.
    """
    names = df.columns if columns is None else columns
    wide = df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in names])
    return wide.unpivot([], [F.col(quoted(c)) for c in names], "column_name", "value").select(
        F.lit(dataset).alias("dataset"), "column_name", "value"
    )


def all_cells(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]] | None = None) -> DataFrame:
    """The cells of many tables in one DataFrame, of the listed ``columns`` only if they are given:
    the others are not read at all."""
    chosen = {name: None for name in tables} if columns is None else columns
    return reduce(DataFrame.unionByName, [cells(tables[name], name, names) for name, names in chosen.items()])


def listed_columns(rows: DataFrame) -> dict[str, list[str]]:
    """The columns to read of each dataset, from resolved names (dataset, column_name): one row per
    column, known before any data is read."""
    found: dict[str, list[str]] = {}
    for row in rows.select(*KEYS).distinct().orderBy(*KEYS).collect():
        found.setdefault(row.dataset, []).append(row.column_name)
    return found


def column_cells(cell_rows: DataFrame, column_name: str) -> DataFrame:
    return cell_rows.where(F.col("column_name") == column_name)


def column_names(cell_rows: DataFrame) -> DataFrame:
    return cell_rows.select(*KEYS).distinct()


def value_frequencies(cell_rows: DataFrame) -> DataFrame:
    """How often each value occurs in its column; null is a value of its own.

    The one wide shuffle of a profile: copies are counted before it, and the key holds the value, so
    neither a large dataset nor a hot value lands in one task.
    """
    return cell_rows.groupBy(*KEYS, "value").agg(F.count("*").alias("n"))


def aggregate_columns(
    cell_rows: DataFrame,
    name: str,
    function: Callable[[Column], Column],
    other_keys: tuple[str, ...] = (),
) -> DataFrame:
    """Any aggregate over each column's values, optionally by further keys."""
    return cell_rows.groupBy(*KEYS, *other_keys).agg(function(F.col("value")).alias(name))
