"""Which value types occur together in a column, and how common each combination is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolumna.functions import value_types as vt
from kolumna.operators.cells import KEYS

# The labels of an itemset, in their fixed order.
ITEM_LABELS = [(vt.REAL, "-REAL-"), (vt.DATE, "-DATE-"), (vt.INTEGER, "-INTEGER-"), (vt.TEXT, "-TEXT-")]


def column_itemsets(typed: DataFrame) -> DataFrame:
    """The combination of types in each column; '' where no value has a type.

    Takes typed rows, or rows of type statistics.
    """
    has = typed.groupBy(*KEYS).agg(
        *[F.max(F.coalesce(F.col("type") == kind, F.lit(False))).alias(kind) for kind, _ in ITEM_LABELS]
    )
    parts = [F.when(F.col(f"`{kind}`"), label).otherwise("") for kind, label in ITEM_LABELS]
    return has.select(*KEYS, F.concat(*parts).alias("itemset"))


def dataset_itemsets(itemsets: DataFrame) -> DataFrame:
    return itemsets.groupBy("dataset", "itemset").agg(F.count("*").alias("n"))


def total_itemsets(tally: DataFrame) -> DataFrame:
    return tally.groupBy("itemset").agg(F.sum("n").alias("n"))


def most_frequent_itemsets(total: DataFrame) -> DataFrame:
    """All combinations that share the highest count."""
    by_count = total.groupBy("n").agg(F.collect_list("itemset").alias("itemsets"))
    return by_count.orderBy(F.desc("n")).limit(1).select(F.explode("itemsets").alias("itemset"), "n")
