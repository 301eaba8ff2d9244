"""Dataset files: listing, choosing, and reading many tab-separated files as value frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kolumna.operators.cells import KEYS
from kolumna.operators.steps import computed
from kolumna.session import written
from kolumna.sources.records import separators, wide_records

# The index file that is no dataset, and the size in bytes from which files may be skipped.
INDEX_FILE = "datasets.tsv.gz"
SIZE_LIMIT = 600_000_000

#: How delimited text is written and read: quotes inside quotes are doubled, cells may hold line
#: breaks and keep their outer blanks.
TEXT_OPTIONS = {
    "quote": '"', "escape": '"', "lineSep": "\n", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
READ_OPTIONS = {**TEXT_OPTIONS, "multiLine": True, "maxCharsPerColumn": -1}


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of all files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length")


def file_states(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, modified) of all files below a folder, with paths as readers give them in ``_metadata``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select(F.col("_metadata.file_path").alias("path"), F.col("length"), F.col("modificationTime").alias("modified"))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def dataset_files(files: DataFrame) -> DataFrame:
    name = base_name(F.col("path"))
    return files.where(name.endswith(".gz") & (name != INDEX_FILE))


def within_size(files: DataFrame, limit: int | None = None) -> DataFrame:
    """The files below a limit in bytes, all by default; ``oversized`` has the others."""
    return files if limit is None else files.where(F.col("length") < limit)


def oversized(files: DataFrame, limit: int | None = None) -> DataFrame:
    """The files that ``within_size`` leaves out, to be reported with its result."""
    return files.where(F.lit(False) if limit is None else F.col("length") >= limit)


def by_size(files: DataFrame) -> DataFrame:
    return files.orderBy("length", "path")


def shuffled(files: DataFrame, seed: int) -> DataFrame:
    """In an order that depends on the seed and the paths alone, however the listing is partitioned."""
    return files.orderBy(F.xxhash64(F.lit(seed), "path"), "path")


def first_files(files: DataFrame, n: int) -> DataFrame:
    return by_size(files).limit(n)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """One tab-separated file with a header as a wide table with inferred types."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=True, **READ_OPTIONS)


def cells_of_records(rows: DataFrame, width: int | None = None, separator: str = "\t") -> DataFrame:
    """(file, row, cells) of ``rows`` (file, row, record): an array of text for each record, an empty cell is null.

    No record has more than ``width`` cells, which its separators tell if it is not given.
    """
    if width is None:
        width = 1 + (rows.agg(F.max(separators(F.col("record"), separator))).first()[0] or 0)
    names = [f"c{i}" for i in range(width)]
    options = {**TEXT_OPTIONS, "sep": separator, "maxCharsPerColumn": -1, "maxColumns": width + 1}
    parsed = F.from_csv("record", ", ".join(f"{n} string" for n in names), {k: str(v) for k, v in options.items()})
    return computed(rows, parsed=parsed).select("file", "row", F.array(*[F.col(f"parsed.{n}") for n in names]).alias("cells"))


def tsv_frequencies(spark: SparkSession, paths: list[str], dataset: Column | None = None) -> DataFrame:
    """Value frequencies of all columns of many files, in one wide shuffle.

    Files may differ in their columns, and none is cut off. They are read once, as lines, a large one that is
    not compressed by many tasks. Values are raw text, an empty cell is null. The header of a file is
    its first record: the header cells are found among the counted values, which are written once, and
    taken out again. ``dataset`` (of ``file``) names the dataset, by default the file's name; files of one
    dataset are added up. Names that occur twice in a header get their position, columns without a name
    are called ``_c`` + position.
    """
    found, width, heads = wide_records(spark, paths)
    rows = cells_of_records(found, width).join(F.broadcast(heads), "file", "left")
    marked = F.concat(F.array(F.lit("")), F.col("cells"))
    exploded = rows.select("file", (F.col("row") == F.col("head")).alias("head"), F.posexplode(marked).alias("place", "value"))
    exploded = exploded.withColumn("pos", F.col("place") - 1)
    # A count and a flag are aggregated by hashing: no task sorts its cells.
    counted = exploded.where(F.col("value").isNotNull()).groupBy("file", "pos", "value").agg(
        F.count("*").alias("n"), F.max("head").alias("in_head")
    )
    counted = written(counted, "counted")
    # The constant cell in front counts the rows of each file. Tables of files and columns go to the values, never
    # the values to them: by file or column a large one would meet in one task.
    is_marker = F.col("pos") == -1
    in_head = F.col("in_head")
    files = counted.where(is_marker).select("file", (F.col("n") - 1).alias("rows"))
    known = counted.where(~is_marker)
    filled = known.groupBy("file", "pos").agg(F.sum(F.col("n") - in_head.cast("int")).alias("filled"))
    headers = known.where(in_head).select("file", "pos", F.col("value").alias("header"))
    columns = filled.join(files, "file").join(headers, ["file", "pos"], "left")
    repeated = columns.groupBy("file", F.lower("header").alias("name")).agg(F.count("*").alias("times"))
    repeated = repeated.where(F.col("name").isNotNull() & (F.col("times") > 1)).withColumnRenamed("file", "f")
    same = (F.col("file") == F.col("f")) & (F.lower("header") == F.col("name"))
    position = F.col("pos").cast("string")
    name = F.when(F.col("header").isNull(), F.concat(F.lit("_c"), position)).when(
        F.col("times") > 1, F.concat("header", position)
    )
    named = columns.join(repeated, same, "left").select(
        "file", "pos", "rows", "filled", name.otherwise(F.col("header")).alias("column_name")
    )
    values = known.withColumn("n", F.col("n") - in_head.cast("int")).where(F.col("n") > 0)
    values = values.join(F.broadcast(named.select("file", "pos", "column_name")), ["file", "pos"])
    empties = named.select(
        "file", "column_name", F.lit(None).cast("string").alias("value"), (F.col("rows") - F.col("filled")).alias("n")
    ).where(F.col("n") > 0)
    label = base_name(F.col("file")) if dataset is None else dataset
    every = values.select("file", "column_name", "value", "n").unionByName(empties)
    result = every.select(label.alias("dataset"), "column_name", "value", "n")
    return result if dataset is None else result.groupBy(*KEYS, "value").agg(F.sum("n").alias("n"))
