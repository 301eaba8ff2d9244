"""The semantic type of each value of a column whose own type is known, and the cells per type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kolumna.functions.rules import OWN_TYPE_ONLY, RULES, is_empty_literal, rule_types
from kolumna.operators import nearest_search
from kolumna.operators.cells import KEYS
from kolumna.operators.matching import DIGITS_KEPT, best_types
from kolumna.session import written

# The labels of the result; any other type is reported as "other" with its label.
LABELS = [
    "person_name", "business_name", "phone_number", "address", "street_name", "city", "neighborhood",
    "lat_lon_cord", "zip_code", "borough", "school_name", "color", "car_make", "city_agency",
    "area_of_study", "subject_in_school", "school_level", "college_name", "website",
    "building_classification", "vehicle_type", "location_type", "park_playground", "other",
]

# Average distance up to which the column's own type is taken, and the share of it
# that another type must reach to replace it.
ACCEPTED_AVERAGE = 0.9
IMPROVED_TO = 0.8


def value_types(
    values: DataFrame, refs: DataFrame, rules=RULES, own_type_only=OWN_TYPE_ONLY
) -> DataFrame:
    """The semantic type of each different (value, column_type).

    Empty-like values take the column's type. Other values are matched to the column's type first;
    only those too far from it are matched again, to the types their look suggests, or to all types
    if no rule fires. A better type must be clearly better.
    """
    keys = ["value", "column_type"]
    value, own = F.col("value"), F.col("column_type")
    pairs = values.select(*keys).distinct()
    full = pairs.where(~is_empty_literal(value)).withColumn("text", value)
    first = best_types(full.withColumn("allowed", F.array(own)), refs, keys, "allowed").select(
        *keys, F.col("average").alias("own_average")
    )
    rated = written(pairs.where(value.isNotNull()).join(first, keys, "left"), "own-types")
    far = F.col("own_average").isNull() | (F.round("own_average", DIGITS_KEPT) > ACCEPTED_AVERAGE)
    suggested = rule_types(value, own, rules, own_type_only)
    second_round = (
        rated.where(far & ~is_empty_literal(value))
        .withColumn("suggested", suggested)
        .withColumn("allowed", F.when(F.size("suggested") > 0, F.array_union("suggested", F.array(own))))
        .select(*keys, value.alias("text"), "allowed")
    )
    second = best_types(second_round, refs, keys, "allowed").select(
        *keys, F.col("s_type").alias("other_type"), F.col("average").alias("other_average")
    )
    better = F.col("own_average").isNull() | (
        F.round("other_average", DIGITS_KEPT) <= F.round(F.col("own_average") * IMPROVED_TO, DIGITS_KEPT)
    )
    chosen = F.when(F.col("other_type").isNotNull() & better, F.col("other_type")).otherwise(own)
    typed = rated.join(second, keys, "left").select(*keys, chosen.alias("s_type"))
    return typed.unionByName(pairs.where(value.isNull()).select(*keys, own.alias("s_type")))


def cell_types(frequencies: DataFrame, column_types: DataFrame, refs: DataFrame, rules=RULES, own_type_only=OWN_TYPE_ONLY) -> DataFrame:
    """Frequencies of the listed columns with each value's semantic type."""
    listed = frequencies.join(column_types.select(*KEYS, "column_type"), KEYS)
    types = value_types(listed, refs, rules, own_type_only)
    types = types.toDF("typed_value", "typed_column", "s_type")
    same = F.col("value").eqNullSafe(F.col("typed_value")) & (F.col("column_type") == F.col("typed_column"))
    return listed.join(types, same, "left").select(*KEYS, "value", "n", "column_type", "s_type")


def type_counts(typed: DataFrame) -> DataFrame:
    """Cells per semantic type in each column."""
    return typed.groupBy(*KEYS, "s_type").agg(F.sum("n").alias("n"))


def labelled(counts: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """Types in the label list stand for themselves, others become ``other`` with a label."""
    known = F.col("s_type").isin(labels)
    return counts.withColumn("semantic_type", F.when(known, F.col("s_type")).otherwise("other")).withColumn(
        "label", F.when(~known, F.col("s_type"))
    )


def semantic_records(counts: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """One record per column with its semantic types (one entry per type) in an array."""
    entry = F.struct("semantic_type", "label", F.col("n").alias("count"))
    return labelled(counts, labels).groupBy(*KEYS).agg(F.sort_array(F.collect_list(entry)).alias("semantic_types"))


def grown_reference(
    refs: DataFrame, matches: DataFrame, nearest: float = 0.10, farthest: float = 0.65, size: int = 30
) -> DataFrame:
    """The reference set with new targets: matched values close to a type's targets, but not nearly
    equal to one, fill each type up to ``size`` targets, the nearest first."""
    near = F.round("distance", DIGITS_KEPT)
    fresh = matches.where(near.between(nearest, farthest)).select(
        "s_type", F.col("value").alias("target"), near.alias("distance")
    )
    fresh = fresh.groupBy("s_type", "target").agg(F.min("distance").alias("distance"))
    fresh = fresh.join(refs.select("s_type", "target"), ["s_type", "target"], "left_anti")
    have = refs.groupBy("s_type", "type_order").agg(F.max("target_order").alias("have"))
    ranked = fresh.withColumn(
        "place", F.row_number().over(Window.partitionBy("s_type").orderBy("distance", "target"))
    ).where(F.col("place") <= size)
    added = ranked.join(have, "s_type").withColumn("target_order", (F.col("have") + F.col("place")).cast("int"))
    return refs.unionByName(
        added.where(F.col("target_order") <= size).select("s_type", "target", "target_order", "type_order")
    )


def grown_until_still(
    values: DataFrame, refs: DataFrame, nearest: float = 0.10, farthest: float = 0.65, size: int = 30, stages: int = 4
) -> DataFrame:
    """The reference set grown by ``values`` (text) round by round, until a round adds nothing.

    Values match what earlier rounds have added as well. In each round only the new targets meet the values, which
    keep their nearest target so far; a value is compared with a new target only where that one may be nearer.
    Every round is written; as types have room for ``size`` targets, the rounds end.
    """
    strings, fresh = nearest_search.start(values, refs, []), refs
    while True:
        strings = nearest_search.improved(strings, fresh, [], stages)
        matches = nearest_search.results(strings, []).withColumnRenamed("text", "value")
        grown = written(grown_reference(refs, matches, nearest, farthest, size), "grown")
        fresh = written(grown.join(refs.select("s_type", "target"), ["s_type", "target"], "left_anti"), "fresh")
        if fresh.isEmpty():
            return grown
        refs = grown
