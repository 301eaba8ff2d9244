"""A profile of a folder that is kept up to date: a run reads the files that are new or changed.

Beside the records lies the state of the profile: the value frequencies of every version of a file, and a manifest
of the files (path, length, time) each dataset was profiled from. A run compares the folder with the
manifest and takes the datasets that differ, the smallest first, batch by batch: unread files become
state, the datasets' records are computed from state alone and replace the old ones, and the manifest follows
last. A run that ends early goes on with the rest; records of a half-finished batch are not shown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kolumna.plans.profile_report import column_records
from kolumna.session import written
from kolumna.sinks.files import write_profile
from kolumna.sources import files

#: A batch ends at so many bytes of unread files, or so many datasets.
BATCH_BYTES, BATCH_DATASETS = 1 << 38, 1000

MANIFEST = "file string, length bigint, modified timestamp, part string, dataset string"
STATE = "column_name string, value string, n bigint, dataset string, part string"
REPORT = "dataset string, batch int, files_read bigint, bytes_read bigint, files bigint"


def folder_files(spark: SparkSession, folder: str, dataset: Callable[[Column], Column] = files.base_name) -> DataFrame:
    """The dataset files below a folder as a manifest has them; ``part`` names a version of a file."""
    found = files.dataset_files(files.file_states(spark, folder)).select(F.col("path").alias("file"), "length", "modified")
    part = F.lower(F.hex(F.xxhash64("file", "length", "modified")))
    return found.withColumns({"part": part, "dataset": dataset(F.col("file"))})


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of this module; none is written before the first run."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """The files that the profile under ``out`` was computed from. A dataset whose files are gone has none."""
    return _read(spark, f"{out}/manifest", MANIFEST).where("file is not null")


def _overwrite(df: DataFrame, path: str, *folders: str) -> None:
    """Replace the folders that ``df`` has rows for, and no other."""
    spread = df.hint("rebalance", *folders)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def changes(now: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The files of ``now`` that are not in ``before``, and the datasets with files added, changed or gone:
    (dataset, files, files_read, bytes_read)."""
    version = ["dataset", "part"]
    unread = now.join(before, version, "left_anti")
    gone = before.join(now, version, "left_anti").select("dataset", F.lit(0).alias("read"), F.lit(0).cast("long").alias("length"), F.lit(0).alias("here"))
    touched = unread.select("dataset", F.lit(1).alias("read"), "length", F.lit(0).alias("here")).unionByName(gone)
    here = now.join(touched, "dataset", "left_semi").select("dataset", F.lit(0).alias("read"), F.lit(0).cast("long").alias("length"), F.lit(1).alias("here"))
    counted = touched.unionByName(here).groupBy("dataset").agg(
        F.sum("here").alias("files"), F.sum("read").alias("files_read"), F.sum("length").alias("bytes_read")
    )
    return unread, counted


def batches(changed: DataFrame, batch_bytes: int, batch_datasets: int) -> Iterator[list]:
    """Datasets to profile together, by unread bytes, the smallest first."""
    batch, size = [], 0
    for row in changed.orderBy("bytes_read", "dataset").toLocalIterator():
        if batch and (size + row.bytes_read > batch_bytes or len(batch) == batch_datasets):
            yield batch
            batch, size = [], 0
        batch.append(row)
        size += row.bytes_read
    if batch:
        yield batch


def update(
    spark: SparkSession, folder: str, out: str, dataset: Callable[[Column], Column] = files.base_name,
    batch_bytes: int = BATCH_BYTES, batch_datasets: int = BATCH_DATASETS, max_batches: int | None = None,
) -> DataFrame:
    """Bring the profile under ``out`` up to the files in ``folder``; returns what was done, by dataset.

    ``dataset`` names the dataset of a file's path. Files of unchanged length and time are not read again, also
    where another file of their dataset has changed. With ``max_batches`` the run ends there, and the next one
    goes on.
    """
    now = written(folder_files(spark, folder, dataset), "files")
    unread, changed = changes(now, manifest(spark, out))
    unread, changed = written(unread, "unread"), written(changed, "changed")
    report = []
    for number, batch in enumerate(batches(changed, batch_bytes, batch_datasets)):
        if number == max_batches:
            break
        names = [row.dataset for row in batch]
        mine = F.col("dataset").isin(names)
        _profile(spark, out, now.where(mine), unread.where(mine), names)
        report += [(row.dataset, number, row.files_read, row.bytes_read, row.files) for row in batch]
    return spark.createDataFrame(report, REPORT)


def _profile(spark: SparkSession, out: str, now: DataFrame, unread: DataFrame, names: list[str]) -> None:
    paths = [row.file for row in unread.select("file").collect()]  # as many as the reader is given anyway
    if paths:
        counted = files.tsv_frequencies(spark, paths, F.col("file")).withColumnRenamed("dataset", "of")
        known = unread.select("file", "dataset", "part")
        state = counted.join(known, F.col("of") == F.col("file")).select("column_name", "value", "n", "dataset", "part")
        _overwrite(state, f"{out}/state", "dataset", "part")
    current = _read(spark, f"{out}/state", STATE).where(F.col("dataset").isin(names)).join(now.select("dataset", "part"), ["dataset", "part"], "left_semi")
    frequencies = written(current.groupBy("dataset", "column_name", "value").agg(F.sum("n").alias("n")), "frequencies")
    records = column_records(frequencies).join(versions(now), "dataset")
    write_profile(records, f"{out}/records")
    left = spark.createDataFrame([(name,) for name in names], "dataset string")
    _overwrite(left.join(now, "dataset", "left").select("file", "length", "modified", "part", "dataset"), f"{out}/manifest", "dataset")


def versions(rows: DataFrame) -> DataFrame:
    """(dataset, version) of a manifest: the version changes with every file."""
    return rows.groupBy("dataset").agg(F.concat_ws("-", F.count("*"), F.hex(F.bit_xor(F.xxhash64("part")))).alias("version"))


def profile(spark: SparkSession, out: str) -> DataFrame:
    """The records of the profile under ``out``, of the files in its manifest."""
    records = spark.read.json(f"{out}/records").withColumn("dataset", F.col("dataset").cast("string"))
    return records.join(versions(manifest(spark, out)), ["dataset", "version"], "left_semi").drop("version")
