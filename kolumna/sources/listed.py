"""Catalogs of listed columns, labelled sheets, reference sets and result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kolumna.sources.files import READ_OPTIONS

SHEET = ["ds_path", "col_name_ta", "col_name", "frequent_values->counts_(top_10)"]
RESULTS = "column_name string, semantic_types array<struct<semantic_type: string, label: string, count: bigint>>"


def parse_catalog(lines: DataFrame, folder: str) -> DataFrame:
    """(ds_path, dataset, col_name_ta, listed) from names ``id.column.suffix.suffix``.

    Repeated names are repeated rows.
    """
    shape = r"^([^.]+)\.(.*)\.[^.]+\.[^.]+$"
    dataset = F.concat(F.regexp_extract("value", shape, 1), F.lit(".tsv.gz"))
    return lines.select(
        F.concat(F.lit(folder.rstrip("/") + "/"), dataset).alias("ds_path"),
        dataset.alias("dataset"),
        F.regexp_extract("value", shape, 2).alias("col_name_ta"),
        F.col("value").alias("listed"),
    )


def read_catalog(spark: SparkSession, path: str, folder: str) -> DataFrame:
    return parse_catalog(spark.read.text(path), folder)


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, **READ_OPTIONS)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A labelled sheet, columns by name; its list of ``value->count`` is the text of a JSON array."""
    return _csv(spark, path).select(*[F.col(f"`{c}`") for c in SHEET])


def read_reference_set(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A reference set of values (kind ``frequent_value``) or column names (``col_name_ta``)."""
    count, rank = F.col("count").cast("bigint").alias("count"), F.col("rank").cast("int").alias("rank")
    return _csv(spark, path).select("true_label", kind, count, rank)


def read_results(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Semantic results: one record per line, or (``multi_line``) a file that holds an array."""
    return spark.read.json(path, schema=RESULTS, multiLine=multi_line)
