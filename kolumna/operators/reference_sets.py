"""Labelled samples, reference sets built from them, and the resolution of listed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kolumna.operators.cells import KEYS
from kolumna.operators.matching import nearest
from kolumna.operators.metadata import frequent_value_counts


def split_labels(labels: Column) -> Column:
    """Labels of a list ``"a, b"``; a comma at its end does not count."""
    return F.split(F.regexp_replace(F.trim(labels), r"^,+|,+$", ""), ", ")


def value_count(text: Column) -> tuple[Column, Column]:
    """Value and count of ``value->count``; the value may hold arrows itself."""
    shape = r"(?s)^(.*)->(\d+)$"
    return F.regexp_extract(text, shape, 1), F.regexp_extract(text, shape, 2).try_cast("bigint")


def listed_pairs(sheet: DataFrame, counts: str) -> Column:
    """The list of ``value->count`` of a sheet row: an array, or the text of a list as JSON or Python
    writes it (single quotes, two-digit escapes, None). Null where the text is no list."""
    field = F.col(f"`{counts}`")
    if sheet.schema[counts].dataType.simpleString() != "string":
        return field
    text = F.regexp_replace(field, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    text = F.regexp_replace(text, r"(?<=[\[,])\s*None\s*(?=[,\]])", "null")
    return F.coalesce(F.from_json(field, "array<string>"), F.from_json(text, "array<string>"))


def labelled_values(sheet: DataFrame, counts: str = "frequent_values->counts_(top_10)") -> DataFrame:
    """One row per label and sampled value of a labelled sheet.

    A row without values, or whose list cannot be read (see ``unread_lists``), keeps its labels with
    a null value.
    """
    value, count = value_count(F.col("pair"))
    labels = F.explode(split_labels(F.col("col_name"))).alias("true_label")
    rows = sheet.select("ds_path", "col_name_ta", labels, listed_pairs(sheet, counts).alias("pairs"))
    return rows.select("*", F.explode_outer("pairs").alias("pair")).select(
        "ds_path", "col_name_ta", "true_label", value.alias("frequent_value"), count.alias("count")
    )


def unread_lists(sheet: DataFrame, counts: str = "frequent_values->counts_(top_10)") -> DataFrame:
    """The rows of a sheet whose list of values cannot be read, to be reported."""
    return sheet.where(is_unread(sheet, counts))


def is_unread(sheet: DataFrame, counts: str = "frequent_values->counts_(top_10)") -> Column:
    return F.col(f"`{counts}`").isNotNull() & listed_pairs(sheet, counts).isNull()


def reference_set(labelled: DataFrame, kind: str, k: int = 20) -> DataFrame:
    """The ``k`` values (or column names) of each label with the largest sum of counts."""
    sums = labelled.where(F.col(kind).isNotNull()).groupBy("true_label", kind).agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("count")
    )
    window = Window.partitionBy("true_label").orderBy(F.desc("count"), F.asc(kind))
    return sums.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def reference_lists(rows: DataFrame, kind: str) -> DataFrame:
    """Each label with its values as one list, in rank order."""
    pairs = F.sort_array(F.collect_list(F.struct("rank", F.col(kind).alias("v"))))
    return rows.groupBy("true_label").agg(F.transform(pairs, lambda p: p["v"]).alias("targets"))


def resolve_columns(listed: DataFrame, headers: DataFrame) -> DataFrame:
    """The real header for each listed column name of a dataset.

    ``listed`` has (dataset, col_name_ta), ``headers`` (dataset, column_name, position). The nearest
    header is taken however far it is; ``distance`` tells.
    """
    rows = listed.select("dataset", "col_name_ta").distinct().withColumn("text", F.col("col_name_ta"))
    targets = headers.select(
        "dataset",
        F.lit("").alias("s_type"),
        F.lit(1).alias("type_order"),
        F.col("column_name").alias("target"),
        F.col("position").alias("target_order"),
    )
    found = nearest(rows, targets, ["dataset", "col_name_ta"], ["dataset"])
    return found.select("dataset", "col_name_ta", F.col("target").alias("column_name"), "distance", "adjusted")


def missing_columns(listed: DataFrame, resolved: DataFrame, max_distance: float | None = None) -> DataFrame:
    """Listed columns without a header: their dataset has none, or it is farther than the limit."""
    near = resolved if max_distance is None else resolved.where(F.col("distance") <= max_distance)
    missing = listed.join(near, ["dataset", "col_name_ta"], "left_anti")
    return missing.select(F.col("dataset").alias("ds_name"), "col_name_ta").distinct()


def label_sample(listed: DataFrame, resolved: DataFrame, frequencies: DataFrame, k: int = 10) -> DataFrame:
    """The most frequent values of every listed column, with where they come from; a column
    without cells has an empty list."""
    tops = frequent_value_counts(frequencies.join(resolved.select(*KEYS).distinct(), KEYS), k)
    name = f"frequent_values->counts_(top_{k})"
    rows = listed.join(resolved.select("dataset", "col_name_ta", "column_name"), ["dataset", "col_name_ta"])
    return rows.join(tops, KEYS, "left").select(
        F.col("dataset").alias("ds_path"),
        "col_name_ta",
        F.col("column_name").alias("col_name"),
        F.coalesce(F.col(f"`{name}`"), F.array().cast("array<string>")).alias(name),
    )
