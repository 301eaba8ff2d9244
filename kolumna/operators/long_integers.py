"""Exact figures of INTEGER values of any length.

A number becomes a text that sorts as the number does: its sign, the length of its digits, the digits, and all of it
complemented if it is negative. Sums are kept in limbs of LIMB digits, each a sum over all rows of its own, and
carried once at the end, on one row for each column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kolumna.functions import value_types as vt
from kolumna.operators.cells import KEYS
from kolumna.operators.steps import computed

LIMB = 9
#: Digits of a length in the sorting text.
LENGTH_DIGITS = 10
#: Limbs that the carry of a sum of up to 10^18 rows can add.
SPARE_LIMBS = 3

_UP, _DOWN = "0123456789", "9876543210"


def digits(text: Column) -> Column:
    """The digits of an INTEGER text without its sign and leading zeros; zero is '0'."""
    bare = F.regexp_replace(vt.plain_number(text), r"^\s*[-+]?0*|\s+$", "")
    return F.when(bare == "", "0").otherwise(bare)


def sorting_text(negative: Column, bare: Column) -> Column:
    positive = F.concat(F.lpad(F.length(bare).cast("string"), LENGTH_DIGITS, "0"), bare)
    return F.when(negative & (bare != "0"), F.concat(F.lit("-"), F.translate(positive, _UP, _DOWN))).otherwise(F.concat(F.lit("0"), positive))


def shown(sorting: Column) -> Column:
    """The number of a sorting text."""
    rest = F.substr(sorting, F.lit(LENGTH_DIGITS + 2))
    return F.when(sorting.startswith("-"), F.concat(F.lit("-"), F.translate(rest, _DOWN, _UP))).otherwise(rest)


def limbs(bare: Column) -> Column:
    """Groups of LIMB digits, the lowest first."""
    count = F.ceil(F.length(bare) / LIMB).cast("int")
    padded = F.lpad(bare, count * LIMB, F.lit("0"))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substr(padded, (count - 1 - i) * LIMB + 1, F.lit(LIMB)).cast("bigint"))


def carried(sums: Column) -> Column:
    """(text, carry) of sums by limb, the lowest first: the digits of their number, and a carry of -1 if it is negative."""
    base, zero = F.lit(10**LIMB).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")
    start = F.struct(zero.alias("carry"), F.lit("").alias("text"))

    def step(state: Column, limb: Column) -> Column:
        total = (limb + state["carry"]).cast("decimal(38,0)")
        low = F.pmod(total, base).cast("decimal(38,0)")
        above = ((total - low) / base).cast("decimal(38,0)")
        return F.struct(above.alias("carry"), F.concat(F.lpad(low.cast("string"), LIMB, "0"), state["text"]).alias("text"))

    spare = F.array_repeat(zero, SPARE_LIMBS)
    return F.aggregate(F.concat(sums, spare), start, step)


def long_integer_stats(typed: DataFrame) -> DataFrame:
    """(dataset, column_name, count, max_value, min_value, total, mean) of the INTEGER values: extremes and total are exact
    texts of any length, the mean is their quotient as a double."""
    rows = typed.where(F.col("type") == vt.INTEGER).select(*KEYS, "value", "n")
    rows = computed(rows, bare=digits(F.col("value")), negative=F.trim("value").startswith("-"))
    keyed = rows.withColumn("sorting", sorting_text(F.col("negative"), F.col("bare")))
    extremes = keyed.groupBy(*KEYS).agg(F.sum("n").alias("count"), F.max("sorting").alias("most"), F.min("sorting").alias("least"))
    signed = F.when(F.col("negative"), -F.col("n")).otherwise(F.col("n")).cast("decimal(20,0)")
    parts = rows.select(*KEYS, signed.alias("n"), F.posexplode(limbs(F.col("bare"))).alias("i", "limb"))
    sums = parts.groupBy(*KEYS, "i").agg(F.sum(F.col("n") * F.col("limb").cast("decimal(10,0)")).cast("decimal(38,0)").alias("s"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "s")))
    totals = sums.groupBy(*KEYS).agg(F.transform(ordered, lambda x: x["s"]).alias("sums"))
    both = computed(totals, up=carried(F.col("sums")), down=carried(F.transform("sums", lambda s: (-s).cast("decimal(38,0)"))))
    negative = F.col("up.carry") < 0
    bare = F.regexp_replace(F.when(negative, F.col("down.text")).otherwise(F.col("up.text")), "^0+(?=[0-9])", "")
    total = F.concat(F.when(negative, "-").otherwise(""), bare)
    result = extremes.join(both.select(*KEYS, total.alias("total")), KEYS)
    return result.select(
        *KEYS, "count", shown(F.col("most")).alias("max_value"), shown(F.col("least")).alias("min_value"), "total",
        (F.col("total").cast("double") / F.col("count")).alias("mean"),
    )
