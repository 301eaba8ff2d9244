"""Semantic typing of listed columns from tables to records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolumna.functions.rules import OWN_TYPE_ONLY, RULES
from kolumna.operators import semantics
from kolumna.operators.cells import KEYS, all_cells, listed_columns, value_frequencies
from kolumna.operators.matching import nearest
from kolumna.operators.reference_sets import resolve_columns
from kolumna.session import written
from kolumna.sources.tables import schema_report


def column_types(columns: DataFrame, column_refs: DataFrame) -> DataFrame:
    """The semantic type of each (dataset, column_name) by the column's name."""
    names = columns.select("column_name").distinct().withColumn("text", F.col("column_name"))
    typed = nearest(names, column_refs, ["column_name"])
    return columns.select(*KEYS).distinct().join(
        typed.select("column_name", F.col("s_type").alias("column_type")), "column_name"
    )


def typed_cells(
    tables: Mapping[str, DataFrame],
    listed: DataFrame,
    column_refs: DataFrame,
    value_refs: DataFrame,
    rules=RULES,
    own_type_only=OWN_TYPE_ONLY,
) -> DataFrame:
    """Frequencies of the listed columns with the semantic type of each value.

    Headers are known from the tables' schemas, so names are resolved first and only the resolved
    columns are read; every different value is matched once. The types of the columns and the
    frequencies are used by several steps, so each is written once.
    """
    first = next(iter(tables.values()))
    resolved = resolve_columns(listed, schema_report(first.sparkSession, tables)).select(*KEYS).distinct()
    resolved = written(resolved, "resolved")
    types = written(column_types(resolved, column_refs), "column-types")
    cell_rows = all_cells(tables, listed_columns(resolved))
    frequencies = written(value_frequencies(cell_rows), "frequencies")
    return semantics.cell_types(frequencies, types, value_refs, rules, own_type_only)


def run(tables, listed, column_refs, value_refs, rules=RULES, own_type_only=OWN_TYPE_ONLY) -> DataFrame:
    """The semantic records of the listed columns; the counts are written once."""
    typed = typed_cells(tables, listed, column_refs, value_refs, rules, own_type_only)
    return semantics.semantic_records(written(semantics.type_counts(typed), "type-counts"))
