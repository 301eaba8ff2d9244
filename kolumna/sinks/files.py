"""Writing profiles, itemsets, semantic results and sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kolumna.functions import value_types as vt
from kolumna.sources.files import TEXT_OPTIONS


def type_entry(entry: Column) -> Column:
    """A type's statistics with the fields of that type only; extremes share one name."""
    numbers = F.struct(*[entry[f].alias(f) for f in ("type", "count", "max_value", "min_value", "mean", "stddev")])
    dates = F.struct(
        entry["type"].alias("type"), entry["count"].alias("count"),
        entry["max_date"].alias("max_value"), entry["min_date"].alias("min_value"),
    )
    texts = F.struct(
        *[entry[f].alias(f) for f in ("type", "count", "shortest_values", "longest_values", "average_length")]
    )
    kind = entry["type"]
    text = F.when(kind == vt.TEXT, F.to_json(texts)).when(kind == vt.DATE, F.to_json(dates)).otherwise(F.to_json(numbers))
    return F.parse_json(text)


def write_profile(records: DataFrame, path: str) -> None:
    """Column records as JSON, one folder per dataset. Only the folders of the datasets written are
    replaced, so a run can be repeated or continued dataset by dataset."""
    shown = records.withColumn("data_types", F.transform("data_types", type_entry))
    shown.repartition("dataset").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset").json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays as JSON text, since CSV holds none."""
    flat = [
        F.to_json(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map")
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode("overwrite").csv(path, header=True, **TEXT_OPTIONS)


def write_tsv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Compressed tab-separated files, each with a header; without ``compression`` ("none") many tasks can read one."""
    df.write.mode("overwrite").csv(path, sep="\t", header=True, compression=compression, **TEXT_OPTIONS)
