"""What a set of tables looks like, and the cells of many tables of files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from kolumna.operators.cells import KEYS, quoted
from kolumna.session import written
from kolumna.sources.files import READ_OPTIONS, base_name


def schema_report(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: dataset, column_name, position (from 1), type. Schemas only, no data."""
    rows = [
        (name, field.name, i, field.dataType.simpleString())
        for name, df in tables.items()
        for i, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, "dataset string, column_name string, position int, type string")


#: Footers that are looked at together.
LOOKS = 16


def by_schema(spark: SparkSession, paths: Iterable[str]) -> dict[StructType, list[str]]:
    """The Parquet files of each schema (names, types and their order); footers only, no data.

    Files are looked at many at a time, as each look is a short job of its own.
    """
    def schema(path: str) -> tuple[str, StructType]:
        fields = spark.read.parquet(path).schema.fields
        return path, StructType([StructField(f.name, f.dataType) for f in fields])

    found: dict[str, tuple[StructType, list[str]]] = {}
    with ThreadPoolExecutor(LOOKS) as pool:
        for path, kind in pool.map(schema, paths):
            found.setdefault(kind.json(), (kind, []))[1].append(path)
    return {kind: group for kind, group in found.values()}


def file_headers(spark: SparkSession, paths: Iterable[str], dataset: Callable[[Column], Column] = base_name, separator: str = "\t") -> DataFrame:
    """(dataset, column_name, position) of delimited files, from their first records; many files are looked at at a time.

    Files of one dataset give the columns of each once, at the first place where one of them has it. Repeated names and
    columns without a name are called as Spark's reader does.
    """
    def header(path: str) -> list[tuple[str, str, int]]:
        names = spark.read.csv(path, sep=separator, header=True, **READ_OPTIONS).columns
        return [(path, name, i) for i, name in enumerate(names, 1)]

    with ThreadPoolExecutor(LOOKS) as pool:
        rows = [row for found in pool.map(header, paths) for row in found]
    headers = spark.createDataFrame(rows, "path string, column_name string, position int")
    return headers.groupBy(dataset(F.col("path")).alias("dataset"), "column_name").agg(F.min("position").alias("position"))


def file_cells(spark: SparkSession, paths: Iterable[str], dataset: Callable[[Column], Column] = base_name) -> DataFrame:
    """The cells (dataset, column_name, value) of many Parquet files, with one scan for each schema.

    Thousands of datasets of a few schemas are a plan of a few branches. ``dataset`` names a file's dataset by
    its path; files of one dataset may differ in their columns, then each has the cells of its own ones.
    A file without columns has no cells.
    """
    branches = [spark.createDataFrame([], "dataset string, column_name string, value string")]
    for kind, group in by_schema(spark, paths).items():
        names = kind.names
        if not names:
            continue
        rows = spark.read.schema(kind).parquet(*group)
        # Positions in place of names, which may hold dots or one another's letters in another case.
        wide = rows.select(
            dataset(F.col("_metadata.file_path")).alias("dataset"), *[F.col(quoted(name)).cast("string").alias(str(i)) for i, name in enumerate(names)]
        )
        long = wide.unpivot("dataset", [F.col(quoted(str(i))) for i in range(len(names))], "place", "value")
        name = F.get(F.array(*[F.lit(n) for n in names]), F.col("place").cast("int"))
        branches.append(long.select("dataset", name.alias("column_name"), "value"))
    return reduce(DataFrame.unionByName, branches)


def record_frequencies(spark: SparkSession, paths: list[str], dataset: Callable[[Column], Column] = base_name) -> DataFrame:
    """Value frequencies of files of JSON records, in one scan whatever their schemas.

    Each record is one VARIANT; its fields are exploded to cells. A dataset has the fields of all its records as
    columns, and null cells for the records without them. Texts stand for themselves, other values as JSON
    writes them, nested ones included. Lines that are no JSON object are records without fields.
    """
    rows = spark.read.option("singleVariantColumn", "record").json(paths).select(dataset(F.col("_metadata.file_path")).alias("dataset"), "record")
    objects = F.when(F.schema_of_variant("record").startswith("OBJECT"), F.col("record"))
    fields = rows.withColumn("record", objects).lateralJoin(spark.tvf.variant_explode_outer(F.col("record").outer())).select(
        "dataset", F.col("key").alias("column_name"), F.try_variant_get("value", "$", "string").alias("value"),
        (F.coalesce("pos", F.lit(0)) == 0).cast("long").alias("first"),  # one in each record, also in one without fields
    )
    counted = written(fields.groupBy(*KEYS, "value").agg(F.count("*").alias("n"), F.sum("first").alias("firsts")), "record-frequencies")
    records = counted.groupBy("dataset").agg(F.sum("firsts").alias("records"))
    named = counted.where("column_name is not null")
    columns = named.groupBy(*KEYS).agg(F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("filled"))
    empties = columns.join(records, "dataset").select(*KEYS, F.lit(None).cast("string").alias("value"), (F.col("records") - F.col("filled")).alias("n"))
    return named.where("value is not null").select(*KEYS, "value", "n").unionByName(empties.where("n > 0"))
