"""Precision and recall of semantic types, report order, and the summary of a run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kolumna.operators.overlap import in_parts
from kolumna.session import written


def catalog_name(dataset, column_name):
    """The listed file name of a column: the dataset's name to its first point, column, suffix."""
    return F.concat(F.substring_index(dataset, ".", 1), F.lit("."), column_name, F.lit(".txt.gz"))


def truth(sheet: DataFrame) -> DataFrame:
    """(column_name, true_label) from a labelled sheet; commas inside labels are dropped."""
    labels = F.transform(F.split(F.trim("col_name"), ", "), lambda x: F.replace(x, F.lit(","), F.lit("")))
    return sheet.select(
        catalog_name(F.col("ds_path"), F.col("col_name_ta")).alias("column_name"), F.explode(labels).alias("true_label")
    )


def predictions(records: DataFrame) -> DataFrame:
    """(column_name, semantic_type) from result records; ``other`` is told by its label."""
    types = records.select("column_name", F.explode("semantic_types").alias("t"))
    named = F.when(F.col("t.semantic_type") == "other", F.col("t.label")).otherwise(F.col("t.semantic_type"))
    return types.select("column_name", named.alias("semantic_type"))


def aligned(truth_rows: DataFrame, predicted: DataFrame) -> DataFrame:
    """Every true label of a column beside every prediction for it; either side may be missing.

    Counted rows are joined, so many equal labels of a column are one row with their number. They are written, as
    their number tells into how many parts they are joined.
    """
    a = written(truth_rows.groupBy("column_name", "true_label").agg(F.count("*").alias("n_true")), "truth")
    b = written(predicted.groupBy("column_name", "semantic_type").agg(F.count("*").alias("n_predicted")), "predictions")
    rows = a.count() + b.count()
    both = in_parts(a, rows, "column_name").join(in_parts(b, rows, "column_name"), "column_name", "full_outer")
    n = F.coalesce("n_true", F.lit(1)) * F.coalesce("n_predicted", F.lit(1))
    return both.select("column_name", "true_label", "semantic_type", n.alias("n"))


def _share(rows: DataFrame, by: str) -> DataFrame:
    hit = F.col("true_label") == F.col("semantic_type")
    return rows.where(F.col(by).isNotNull()).groupBy(F.col(by).alias("semantic_type")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("hits"),
        F.sum(F.when(F.col("true_label").isNotNull(), F.col("n")).otherwise(0)).alias("all"),
    )


def precision(rows: DataFrame) -> DataFrame:
    """Matches among the aligned rows with a truth, per predicted type; 0 where there is none."""
    ratio = F.when(F.col("all") > 0, F.col("hits") / F.col("all")).otherwise(0.0)
    return _share(rows, "semantic_type").select("semantic_type", ratio.alias("precision"))


def recall(rows: DataFrame) -> DataFrame:
    """Matches among the aligned rows of each true type; 0 where there is none."""
    return _share(rows, "true_label").select("semantic_type", (F.col("hits") / F.col("all")).alias("recall"))


def in_listed_order(records: DataFrame, files: DataFrame) -> DataFrame:
    """Records of the listed files in the order of the list: ``files`` has (pos, path)."""
    order = files.select("pos", F.regexp_extract("path", r"([^/]*)$", 1).alias("dataset"))
    return records.join(order, "dataset").orderBy("pos")


def run_log_summary(log: DataFrame) -> DataFrame:
    """Per run: total, mean and longest time, and the output of the slowest step (the first of them).

    ``log`` has (run, step, seconds, output).
    """
    return log.groupBy("run").agg(
        F.count("*").alias("steps"),
        F.sum("seconds").alias("total"),
        F.avg("seconds").alias("mean"),
        F.max("seconds").alias("longest"),
        F.min_by("output", F.struct((-F.col("seconds")).alias("s"), "step")).alias("slowest_output"),
    )


def running_means(log: DataFrame, block: int = 100_000) -> DataFrame:
    """The mean time up to each step of a run.

    Steps are summed up in blocks of step numbers first, so that one very long run is spread over
    many tasks: a step's mean takes the sums of earlier blocks and the steps of its own.
    """
    blocks = F.floor(F.col("step") / block)
    tagged = log.withColumn("block", blocks)
    sums = tagged.groupBy("run", "block").agg(F.sum("seconds").alias("s"), F.count("*").alias("c"))
    earlier = Window.partitionBy("run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        "run", "block",
        F.coalesce(F.sum("s").over(earlier), F.lit(0.0)).alias("s_before"),
        F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("c_before"),
    )
    inside = Window.partitionBy("run", "block").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.select(
        "*", F.sum("seconds").over(inside).alias("s_here"), F.count("*").over(inside).alias("c_here")
    )
    joined = local.join(before, ["run", "block"])
    mean = (F.col("s_before") + F.col("s_here")) / (F.col("c_before") + F.col("c_here"))
    return joined.select(*log.columns, mean.alias("running_mean"))
