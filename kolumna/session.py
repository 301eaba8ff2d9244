"""Session settings the jobs rely on, and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: cell text of timestamps must not depend on the machine."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``, which every executor can
    reach. Where that is unset, a temporary folder serves a local master, whose executors share the
    driver's disk; on a cluster the tables would be scattered over its machines, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"master {master}: set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="kolumna-")
    path = f"{base.rstrip('/')}/kolumna-{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps neither recompute it nor
    depend on executors that computed it."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete one table of ``written`` that nothing reads any more, before the job ends."""
    spark, files = table.sparkSession, table.inputFiles()
    paths, jvm = _written.get(spark.sparkContext.applicationId, []), spark.sparkContext._jvm
    for path in [p for p in paths if any(f"/{p.rstrip('/').rpartition('/')[2]}/" in f for f in files[:1])]:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        paths.remove(path)


def remove_written(spark: SparkSession) -> list[str]:
    """Delete the intermediate tables of this application, at the end of a job: results that still
    read them must have been written or collected. Returns the folders."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(hadoop).delete(folder, True)
    return paths
