"""Matching strings to a labelled reference set by Jaccard distance over 3-shingles.

Strings come as rows with any key columns and a string column; the reference set is a table
(s_type, target, type_order, target_order), see ``reference``. Distances are only computed where a
string and a target share a shingle: all others are 1, which needs no pair.

Strings and targets go by numbers while shingles are joined and counted; texts come back at the end. Every
step keeps the rows where the first shuffle on the number put them; the reference set is
broadcast after a check of its size and joined by shuffle beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kolumna.functions.text import normal_forms, shingle_set
from kolumna.operators.steps import computed
from kolumna.session import written

SHINGLE = 3
# How much a distance counts at each stage, from the raw text to the most general form.
STAGE_WEIGHTS = [0.90, 0.95, 0.97, 1.00]
DIGITS_KEPT = 12


def reference(rows: DataFrame, s_type: str, target: str, order: str | None = None) -> DataFrame:
    """A reference set in its order: types by name, targets by ``order`` (by default, by text)."""
    types = rows.select(F.col(s_type).alias("s_type")).distinct()
    types = types.withColumn("type_order", F.row_number().over(Window.orderBy("s_type")))
    within = Window.partitionBy("s_type").orderBy(*([order] if order else []), "target")
    kept = rows.select(F.col(s_type).alias("s_type"), F.col(target).alias("target"), *([order] if order else []))
    ordered = kept.withColumn("target_order", F.row_number().over(within)).select("s_type", "target", "target_order")
    return ordered.join(types, "s_type")


def _tokens(text: Column) -> Column:
    """Shingles to join on, and the whole text marked by a prefix longer than a shingle: equal
    strings have distance 0 even when too short for shingles."""
    return F.array_append(shingle_set(text, SHINGLE), F.concat(F.lit("=" * (SHINGLE + 1)), text))


def _by_stage(rows: DataFrame, text: str, keep: list[str], stages: int) -> DataFrame:
    """One row per stage: the stage's form of the text, its tokens and number of shingles."""
    forms = F.array(*[F.struct(F.lit(i).alias("stage"), f.alias("form")) for i, f in enumerate(normal_forms(F.col(text))[:stages])])
    staged = rows.select(*keep, F.inline(forms))
    return computed(staged, tokens=_tokens(F.col("form"))).withColumn("size", F.size("tokens") - 1)


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a number each: texts and keys stay here, and only numbers go with the shingles."""
    return written(rows.withColumn("_id", F.monotonically_increasing_id()), "strings")


def _similar(rows: DataFrame, refs: DataFrame, group: list[str], stages: int, allowed: str | None = None) -> DataFrame:
    """(_id, stage, type_order, target_order, distance) of all strings and targets that share a token.

    A string keeps one row with a null type at each stage at which it shares nothing. ``rows`` has
    one row per number, with ``text``; ``group`` are keys that the reference set has too. Targets go by
    their place in the reference set.
    """
    marker = "=" * (SHINGLE + 1)
    kept = ["_id", *group, *([allowed] if allowed else [])]
    mine = _by_stage(rows, "text", kept, stages).select(*kept, "stage", F.col("size").alias("size0"), F.explode_outer("tokens").alias("token"))
    theirs = _by_stage(refs, "target", refs.columns, stages).select(
        *[F.col(c).alias(f"ref_{c}") for c in group],
        "type_order",
        "target_order",
        *(["s_type"] if allowed else []),
        F.col("stage").alias("ref_stage"),
        F.col("size").alias("size1"),
        F.explode("tokens").alias("ref_token"),
    )
    meets = (F.col("token") == F.col("ref_token")) & (F.col("stage") == F.col("ref_stage"))
    for c in group:
        meets = meets & (F.col(c) == F.col(f"ref_{c}"))
    if allowed:
        meets = meets & (F.col(allowed).isNull() | F.array_contains(allowed, F.col("s_type")))
    met = mine.join(theirs, meets, "left")
    whole = F.col("token").startswith(marker) & (F.length("token") >= len(marker))
    carried = [F.first(allowed).alias(allowed)] if allowed else []
    pairs = met.groupBy("_id", "stage", "type_order", "target_order").agg(
        F.max("size0").alias("size0"),
        F.max("size1").alias("size1"),
        F.sum(F.when(whole, 0).otherwise(1)).alias("common"),
        F.max(whole).alias("equal"),
        *carried,
    )
    union = F.col("size0") + F.col("size1") - F.col("common")
    similarity = F.when(F.col("equal"), 1.0).when(F.col("common") == 0, 0.0).otherwise(F.col("common") / union)
    found = computed(pairs, distance=F.when(F.col("type_order").isNotNull(), 1.0 - similarity))
    return found.drop("size0", "size1", "common", "equal")


def _named(best: DataFrame, rows: DataFrame, refs: DataFrame, group: list[str]) -> DataFrame:
    """``best`` with the keys of its strings, and the type and target by their place, null where it has none."""
    targets = refs.select(
        *[F.col(c).alias(f"ref_{c}") for c in group], F.col("type_order").alias("ref_type"), F.col("target_order").alias("ref_target"),
        F.col("s_type").alias("found_type"), F.col("target").alias("found_target"),
    )
    same = (F.col("type_order") == F.col("ref_type")) & (F.col("target_order") == F.col("ref_target"))
    for c in group:
        same = same & (F.col(c) == F.col(f"ref_{c}"))
    return rows.join(best, "_id").join(targets, same, "left")


def _weight(stage: Column) -> Column:
    return F.get(F.array(*[F.lit(w) for w in STAGE_WEIGHTS]), stage)


def _staged(best: DataFrame, keys: list[str], score: Column) -> DataFrame:
    """The first stage with distance 0, else the stage of the smallest score, the earlier on a tie."""
    zero = F.col("distance") == 0
    order = F.struct(
        (~zero).alias("other"), F.when(zero, 0.0).otherwise(F.round(score, DIGITS_KEPT)).alias("score"), "stage"
    )
    fields = [c for c in best.columns if c not in keys]
    chosen = best.withColumn("adjusted", F.when(zero, 0.0).otherwise(score)).groupBy(*keys).agg(
        F.min_by(F.struct(*fields, "adjusted"), order).alias("m")
    )
    return chosen.select(*keys, "m.*")


def nearest(rows: DataFrame, refs: DataFrame, keys: list[str], group: list[str] | None = None, stages: int = 4) -> DataFrame:
    """For each string the nearest target: (keys, s_type, target, distance, adjusted, stage).

    At each stage the smallest distance wins, the first in reference order on a tie; then the stages
    are compared by weighted distance. A string that shares nothing with any target still gets the
    first one, at distance 1. With ``group``, strings meet the targets of their own group only.
    """
    group = group or []
    rows = _numbered(rows.select(*dict.fromkeys([*keys, *group, "text"])))
    hit = F.struct(F.round("distance", DIGITS_KEPT).alias("near"), "type_order", "target_order", "distance")
    found = _similar(rows, refs, group, stages).groupBy("_id", "stage").agg(F.min(F.when(F.col("type_order").isNotNull(), hit)).alias("m"))
    found = found.select("_id", "stage", "m.type_order", "m.target_order", F.coalesce("m.distance", F.lit(1.0)).alias("distance"))
    best = _named(_staged(found, ["_id"], F.col("distance") * _weight(F.col("stage"))), rows, refs, group)
    first = F.min_by(F.struct("s_type", "target"), F.struct("type_order", "target_order")).alias("first")
    if group:
        best = best.join(refs.groupBy(*group).agg(first), group)
    else:
        best = best.withColumn("first", refs.agg(first).scalar())
    return best.select(
        *keys,
        F.coalesce("found_type", "first.s_type").alias("s_type"),
        F.coalesce("found_target", "first.target").alias("target"),
        "distance",
        "adjusted",
        "stage",
    )


def nearest_containing(rows: DataFrame, refs: DataFrame, keys: list[str], stages: int = 4) -> DataFrame:
    """The nearest target among those that contain the string or lie within it; no row if none does.

    An equal raw text wins at once. A part shares its first three characters (all of them, if it is
    shorter) with the whole, so the join is on these, and containment is checked on the pairs met.
    """
    def grams(form: Column) -> Column:
        pieces = [F.regexp_extract_all(form, F.lit(r"(?s)(?=(.{%d}))" % k), F.lit(1)) for k in range(1, SHINGLE + 1)]
        return F.array_distinct(F.concat(F.array(F.lit("")), *pieces))

    def staged(df: DataFrame, text: str) -> DataFrame:
        forms = F.array(*[F.struct(F.lit(i).alias("stage"), f.alias("form")) for i, f in enumerate(normal_forms(F.col(text))[:stages])])
        return df.select("*", F.inline(forms))

    mine = staged(rows, "text").withColumnRenamed("form", "form0")
    theirs = staged(refs, "target").withColumnRenamed("form", "form1")
    mine_all = mine.select("*", F.explode(grams(F.col("form0"))).alias("gram"))
    mine_start = mine.select("*", F.substring("form0", 1, SHINGLE).alias("gram"))
    theirs_all = theirs.select("*", F.explode(grams(F.col("form1"))).alias("gram"))
    theirs_start = theirs.select("*", F.substring("form1", 1, SHINGLE).alias("gram"))
    on = ["stage", "gram"]
    inside = mine_all.join(theirs_start, on).where(F.col("form0").contains(F.col("form1")))
    around = mine_start.join(theirs_all, on).where(
        F.col("form1").contains(F.col("form0")) & ~F.col("form0").contains(F.col("form1"))
    )
    met = inside.unionByName(around)
    same = F.col("text") == F.col("target")
    a, b = shingle_set(F.col("form0"), SHINGLE), shingle_set(F.col("form1"), SHINGLE)
    sizes = computed(met, both=F.size(F.array_intersect(a, b)), either=F.size(F.array_union(a, b)))
    distance = F.when(same | (F.col("form0") == F.col("form1")), 0.0).when(F.col("either") == 0, 1.0)
    scored = computed(sizes, distance=distance.otherwise(1.0 - F.col("both") / F.col("either")))
    order = F.struct((~same).alias("other"), F.round("distance", DIGITS_KEPT).alias("d"), "type_order", "target_order")
    best = scored.groupBy(*keys, "stage").agg(F.min_by(F.struct("s_type", "target", "distance"), order).alias("m"))
    return _staged(best.select(*keys, "stage", "m.*"), keys, F.col("distance") * _weight(F.col("stage"))).select(
        *keys, "s_type", "target", "distance", "adjusted", "stage"
    )


def type_sizes(refs: DataFrame) -> Column:
    """All types as one small array in the order of their number of targets."""
    per_type = refs.groupBy("s_type", "type_order").agg(
        F.count("*").alias("targets"), F.min_by("target", "target_order").alias("first")
    )
    fields = F.struct("targets", "type_order", "s_type", "first")
    return per_type.agg(F.sort_array(F.collect_list(fields))).scalar()


def best_types(
    rows: DataFrame,
    refs: DataFrame,
    keys: list[str],
    allowed: str | None = None,
    by: str = "sum",
    weighted: bool = False,
    stages: int = 4,
) -> DataFrame:
    """For each string the best type over all its targets:
    (keys, s_type, target, distance, average, adjusted, stage).

    At each stage the first target at distance 0 decides; else the type with the smallest sum of
    distances (``by='avg'``: the smallest average). Stages are then compared by that type's average,
    with the stage weights if ``weighted``. ``rows`` has one row per key. ``allowed`` names an array column of ``rows`` with the
    types to consider; null means all. Distances are summed over targets that share a shingle only:
    each of the others adds 1. Types that no target brings up are ranked by their size.
    """
    rows = _numbered(rows.select(*dict.fromkeys([*keys, "text", *([allowed] if allowed else [])])))
    order = F.struct(F.round("distance", DIGITS_KEPT).alias("d"), "target_order")
    carried = [F.first(allowed).alias(allowed)] if allowed else []
    per_type = _similar(rows, refs, [], stages, allowed).groupBy("_id", "stage", "type_order").agg(
        F.sum(1 - F.col("distance")).alias("gain"),
        F.min("distance").alias("distance"),
        F.min_by("target_order", order).alias("target_order"),
        *carried,
    )
    hit = F.when(F.col("type_order").isNotNull(), F.struct("type_order", "gain", "distance", "target_order"))
    both = per_type.groupBy("_id", "stage").agg(F.collect_list(hit).alias("hits"), *carried)
    both = both.withColumn("types", type_sizes(refs))
    if allowed:
        considered = F.filter("types", lambda t: F.array_contains(allowed, t["s_type"]))
        both = both.withColumn("types", F.when(F.col(allowed).isNull(), F.col("types")).otherwise(considered))

    def scored(t: Column) -> Column:
        hit = F.get(F.filter("hits", lambda h: h["type_order"] == t["type_order"]), F.lit(0))
        total = t["targets"] - F.coalesce(hit["gain"], F.lit(0.0))
        average = total / t["targets"]
        distance = F.coalesce(hit["distance"], F.lit(1.0))
        rank = total if by == "sum" else average
        return F.struct(
            (distance > 0).alias("other"),
            F.when(distance == 0, 0.0).otherwise(F.round(rank, DIGITS_KEPT)).alias("rank"),
            t["type_order"].alias("type_order"),
            t["s_type"].alias("s_type"),
            hit["target_order"].alias("target_order"),
            t["first"].alias("first"),
            distance.alias("distance"),
            F.when(distance == 0, 0.0).otherwise(average).alias("average"),
        )

    best = computed(both, m=F.array_min(F.transform("types", scored))).where(F.col("m").isNotNull())
    stage_best = best.select("_id", "stage", *[f"m.{c}" for c in ("type_order", "s_type", "target_order", "first", "distance", "average")])
    score = F.col("average") * _weight(F.col("stage")) if weighted else F.col("average")
    chosen = _named(_staged(stage_best, ["_id"], score), rows, refs, [])
    return chosen.select(*keys, "s_type", F.coalesce("found_target", "first").alias("target"), "distance", "average", "adjusted", "stage")
