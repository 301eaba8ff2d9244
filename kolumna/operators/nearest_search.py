"""Nearest targets in a large reference set, found with bounds.

``matching.nearest`` meets all targets that share a shingle with a string, which suits a few hundred targets.
Here a string looks up its rarest shingles first, and more of them step by step: after k of its n
known shingles a target not met yet can share n - k at most, and once no such target can come before the
best one found, the string stops. The place of a shingle in both sorted lists bounds each pair in the
same way, so that few pairs are compared in full. Forms of the text are searched one after the other; a
string with a distance of 0 goes no further, others carry their best score as the bound of later forms.

Where all shingles are common, as in names that differ in a number, one shingle is met by a share of all targets.
So strings and targets with up to SHORT known shingles meet by whole subsets of them: a subset that a string asks for has
one answer, the first of the smallest targets that hold it, so rows grow with strings and targets, not with pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kolumna.functions.text import normal_forms, shingle_set
from kolumna.operators.matching import DIGITS_KEPT, SHINGLE, STAGE_WEIGHTS
from kolumna.operators.overlap import merged
from kolumna.operators.steps import computed
from kolumna.session import written

#: Slack for comparing a bound with a rounded score: a pair too many does no harm.
SLACK = 1e-9
#: Known shingles up to which strings and targets meet by subsets, of which a target has two to the power of these.
SHORT = 10
#: Subsets asked for that go to every task, about 100 bytes each.
FEW_SUBSETS = 400_000
#: Bits of a shingle's hash in the code of a subset; the number of shingles stands above the sum of SHORT hashes.
CODE_BITS, COUNT_AT = 52, 56
#: Stands for no limit of a target's size.
ANY_SIZE = (1 << 31) - 1


def _candidate(distance: Column, stage: int, target: str = "") -> Column:
    """A match as a struct; the smallest one is the nearest: a zero distance first, then the weighted
    distance, the earlier stage, the distance, the order of the reference set."""
    score = distance * F.lit(STAGE_WEIGHTS[stage])
    zero = distance == 0
    return F.struct(
        (~zero).alias("other"), F.when(zero, 0.0).otherwise(F.round(score, DIGITS_KEPT)).alias("score"), F.lit(stage).alias("stage"),
        F.round(distance, DIGITS_KEPT).alias("near"), F.col(f"{target}type_order").cast("int").alias("type_order"),
        F.col(f"{target}target_order").cast("int").alias("target_order"), F.col(f"{target}s_type").alias("s_type"), F.col(f"{target}target").alias("target"),
        distance.alias("distance"), F.when(zero, 0.0).otherwise(score).alias("adjusted"),
    )


def start(texts: DataFrame, refs: DataFrame, group: list[str]) -> DataFrame:
    """(id, text, group, best) of the different ``texts``: at first the first target, at distance 1."""
    first = F.min_by(_candidate(F.lit(1.0), 0), F.struct("type_order", "target_order")).alias("best")
    numbered = texts.select("text", *group).distinct().withColumn("id", F.monotonically_increasing_id())
    if group:
        return written(numbered.join(refs.groupBy(*group).agg(first), group), "strings")
    return written(numbered.withColumn("best", refs.agg(first).scalar()).where("best is not null"), "strings")


class Index:
    """The targets of one stage: the first of each form, and the first of each set of shingles that ``asked``
    (group, token) has some of, in order of rarity, with the size of the whole set."""

    def __init__(self, refs: DataFrame, asked: DataFrame, group: list[str], stage: int) -> None:
        self.group = group
        first = F.min(F.struct("type_order", "target_order", "s_type", "target")).alias("first")
        forms = refs.withColumn("form", normal_forms(F.col("target"))[stage]).groupBy(*group, "form").agg(first)
        self.forms = written(forms.withColumn("place", F.monotonically_increasing_id()), "forms")
        rows = computed(self.forms, tokens=shingle_set(F.col("form"), SHINGLE))
        counts = rows.select(*group, F.explode("tokens").alias("token")).groupBy(*group, "token").agg(F.count("*").alias("df"))
        self.rarity = written(counts.join(asked.distinct(), [*group, "token"], "left_semi"), "rarity")
        sorted_tokens = self.in_order(rows.select(*group, "place", F.explode("tokens").alias("token")), "place")
        sized = rows.select(*group, "place", "first", F.size("tokens").alias("size"))
        sets = sized.join(merged(sorted_tokens), "place").groupBy(*group, "size", "tokens").agg(F.min("first").alias("first"))
        named = sets.withColumnsRenamed({g: f"t_{g}" for g in group})
        self.targets = written(named.withColumn("place", F.monotonically_increasing_id()), "sorted-targets")
        self.short = self.targets.where(F.size("tokens") <= SHORT)
        self.long = self.targets.where(F.size("tokens") > SHORT)

    def places(self, targets: DataFrame) -> DataFrame:
        return targets.select(
            *[f"t_{g}" for g in self.group], "place", "size", F.size("tokens").alias("t_known"), F.posexplode("tokens").alias("j", "t_token")
        )

    def in_order(self, tokens: DataFrame, key: str) -> DataFrame:
        """(key, tokens): the tokens that the targets know, the rarest first."""
        known = tokens.join(self.rarity, [*self.group, "token"])
        ordered = F.array_sort(F.collect_list(F.struct("df", "token")))
        return known.groupBy(key).agg(F.transform(ordered, lambda t: t["token"]).alias("tokens"))

    def same_group(self) -> Column:
        same = F.lit(True)
        for g in self.group:
            same = same & (F.col(g) == F.col(f"t_{g}"))
        return same


def _hopeful(similarity: Column, stage: int) -> Column:
    """May a target of this similarity come before the best one?"""
    return (similarity >= 1.0) | ((1.0 - similarity) * F.lit(STAGE_WEIGHTS[stage]) <= F.col("best.score") + SLACK)


def _code(token: Column, group: list[Column]) -> Column:
    """One shingle as a number; those of a subset add up to its code, with their number in the upper bits."""
    return F.lit(1 << COUNT_AT) + F.pmod(F.xxhash64(token, *group), F.lit(1 << CODE_BITS))


def _codes(tokens: Column, group: list[Column]) -> Column:
    """The codes of all subsets of ``tokens``."""
    none = F.array(F.lit(0).cast("bigint"))
    return F.aggregate(F.transform(tokens, lambda t: _code(t, group)), none, lambda codes, c: F.concat(codes, F.transform(codes, lambda x: x + c)))


def subsets(active: DataFrame, index: Index, stage: int, low: int, high: int) -> DataFrame:
    """(id, group, n, part, held, limit): the subsets of short strings that leave out ``low`` to under ``high`` of their known
    shingles, if a target that shares just these may come before the best one; its size is up to ``limit`` then."""
    every = F.sequence(F.lit(1), F.pow(F.lit(2), F.col("known")).cast("int") - 1)
    left_out = lambda mask: F.col("known") - F.bit_count(mask)
    masks = F.filter(every, lambda mask: (left_out(mask) >= low) & (left_out(mask) < high))
    short = active.where(F.col("known").between(max(1, low + 1), SHORT))
    # No target is smaller than what it shares, nor than the smallest one.
    least = index.targets.groupBy(*[F.col(f"t_{g}").alias(g) for g in index.group]).agg(F.min("size").alias("smallest"))
    short = short.join(least, index.group) if index.group else short.crossJoin(F.broadcast(least))
    chosen = short.select("id", *index.group, "tokens", "n", "best", "smallest", F.explode(masks).alias("mask"))
    chosen = computed(chosen, held=F.bit_count("mask"))
    similarity = F.col("held") / (F.col("n") + F.greatest("smallest", "held") - F.col("held"))
    chosen = chosen.where(_hopeful(similarity.cast("double"), stage))
    part = F.array_join(F.filter("tokens", lambda t, i: F.getbit(F.col("mask"), i) == 1), "")
    needed = 1.0 - (F.col("best.score") + SLACK) / F.lit(STAGE_WEIGHTS[stage])
    limit = F.least(F.lit(float(ANY_SIZE)), F.floor(F.try_divide(F.col("held"), needed)) + F.col("held") - F.col("n") + 1)
    limit = F.greatest(F.col("held"), F.when(needed > 1e-6, limit).otherwise(ANY_SIZE).cast("int"))
    return chosen.select("id", *index.group, "n", part.alias("part"), "held", limit.alias("limit"))


def answered(asked: DataFrame, sizes: list, index: Index) -> DataFrame:
    """(part, group, answer): for each subset (part, group, held, limit) the first of the smallest short targets that
    hold it. Targets make codes of those subsets only that some string may ask for, by the largest limit of each number of
    shingles (held, limit, n: strings that ask) in ``sizes``; equal codes are compared in full."""

    def wanted(code: Column) -> Column:
        found = F.lit(False)
        for row in sizes:
            found = found | ((F.shiftright(code, COUNT_AT) == row["held"]) & (F.col("size") <= row["limit"]))
        return found

    theirs = [F.col(f"t_{g}") for g in index.group]
    held = index.short.where(
        (F.size("tokens") >= min(row["held"] for row in sizes)) & (F.col("size") <= max(row["limit"] for row in sizes))
    )
    held = held.select("tokens", "size", "first", *theirs, F.explode(F.filter(_codes(F.col("tokens"), theirs), wanted)).alias("t_code"))
    letters = lambda i: F.substr("part", i * SHINGLE + 1, F.lit(SHINGLE))
    tokens = F.transform(F.sequence(F.lit(0), F.col("held") - 1), letters)
    mine = [F.col(g) for g in index.group]
    code = F.aggregate(tokens, F.lit(0).cast("bigint"), lambda total, t: total + _code(t, mine))
    coded = asked.select("part", *index.group, "limit", tokens.alias("asked"), code.alias("code"))
    coded = F.broadcast(coded) if sum(row["n"] for row in sizes) <= FEW_SUBSETS else merged(coded)
    met = held.join(coded, (F.col("t_code") == F.col("code")) & index.same_group() & (F.col("size") <= F.col("limit")))
    met = met.where(F.size(F.array_except("asked", "tokens")) == 0)
    return met.groupBy("part", *index.group).agg(F.min(F.struct("size", "first")).alias("answer"))


def short_pairs(active: DataFrame, index: Index, stage: int) -> DataFrame:
    """``active`` with the nearest short target of each short string, where it comes before the best one. At first a string asks
    for all its known shingles, then for fewer; what it shares with the nearest target is among the subsets asked for."""
    for low, high in steps(SHORT):
        parts = written(subsets(active, index, stage, low, high), "subsets")
        sizes = parts.groupBy("held").agg(F.max("limit").alias("limit"), F.count("*").alias("n")).collect()  # SHORT rows at most
        if not sizes:
            break
        asked = parts.groupBy(*index.group, "part", "held").agg(F.max("limit").alias("limit"))
        found = parts.join(merged(answered(asked, sizes, index)), [*index.group, "part"])
        found = found.select("id", "n", "held", F.col("answer.size").alias("size"), "answer.first.*")
        found = computed(found, distance=1.0 - F.col("held") / (F.col("n") + F.col("size") - F.col("held")))
        found = found.groupBy("id").agg(F.min(_candidate(F.col("distance"), stage)).alias("found"))
        active = written(_better(active, found), "active")
    return active


def pairs(active: DataFrame, places: DataFrame, index: Index, stage: int, low: int, high: int) -> DataFrame:
    """(id, place): strings and targets that share one of the string's known shingles ``low`` to ``high`` and
    may be nearer than the best target. A pair is bounded as if this shingle were the first that it shares:
    then no earlier one is common, in either list."""
    looked = active.select(
        "id", *index.group, "known", "n", "best", F.posexplode(F.slice("tokens", F.lit(low + 1), F.lit(high - low))).alias("i", "token")
    )
    met = looked.join(places, (F.col("token") == F.col("t_token")) & index.same_group())
    common = F.least(F.col("known") - F.col("i") - low, F.col("t_known") - F.col("j")).cast("double")
    return met.where(_hopeful(common / (F.col("n") + F.col("size") - common), stage)).select("id", "place").distinct()


def compared(found: DataFrame, active: DataFrame, index: Index, stage: int) -> DataFrame:
    """(id, found): the nearest target of each string among its pairs, compared in full."""
    theirs = index.targets.select("place", "size", F.col("tokens").alias("t_tokens"), "first.*")
    both = found.join(theirs, "place").join(active.select("id", "tokens", "n"), "id")
    both = computed(both, common=F.size(F.array_intersect("tokens", "t_tokens")))
    similarity = F.col("common") / (F.col("n") + F.col("size") - F.col("common"))
    scored = computed(both, distance=1.0 - similarity)
    return scored.groupBy("id").agg(F.min(_candidate(F.col("distance"), stage)).alias("found"))


def _better(active: DataFrame, found: DataFrame) -> DataFrame:
    return active.join(found, "id", "left").withColumn("best", F.least("best", "found")).drop("found")


def steps(longest: int) -> Iterator[tuple[int, int]]:
    """Ranges of known shingles: one, and then up to four times as many each time."""
    low, high = 0, 1
    while low < longest:
        yield low, min(high, longest)
        low, high = high, 4 * high


def long_pairs(active: DataFrame, targets: DataFrame, index: Index, stage: int) -> DataFrame:
    """``active`` with the nearest one of ``targets`` for each string, where it comes before the best one, found by single shingles."""
    places, left = index.places(targets), active
    longest = active.agg(F.max("known")).first()[0] or 0
    for low, high in steps(longest):
        unseen = (F.col("known") - low).cast("double") / F.col("n")
        left = left.where((F.col("known") > low) & _hopeful(unseen, stage))
        left = written(_better(left, compared(pairs(left, places, index, stage, low, high), left, index, stage)), "active")
        active = _better(active, left.select("id", F.col("best").alias("found")))
        if left.isEmpty():
            break
    return written(active, "active")


def improved(strings: DataFrame, refs: DataFrame, group: list[str], stages: int) -> DataFrame:
    """``strings`` (id, text, group, best) with the nearest target of ``refs`` where it comes before the best one."""
    refs = refs.select(*group, "s_type", "target", "type_order", "target_order")
    for stage in range(stages):
        form = normal_forms(F.col("text"))[stage]
        todo = strings.where("best.other").select("id", *group, "best", form.alias("form"))
        todo = computed(todo, all_tokens=shingle_set(F.col("form"), SHINGLE)).withColumn("n", F.size("all_tokens"))
        tokens = todo.select("id", *group, F.explode("all_tokens").alias("token"))
        index = Index(refs, tokens.drop("id"), group, stage)
        known = index.in_order(tokens, "id")
        active = todo.drop("all_tokens").join(known, "id", "left").withColumn("known", F.coalesce(F.size("tokens"), F.lit(0)))
        # Equal forms have distance 0, also those too short for a shingle.
        equal = active.select("id", *group, "form").join(merged(index.forms.select(*group, "form", "first.*")), [*group, "form"])
        active = written(_better(active, equal.groupBy("id").agg(F.min(_candidate(F.lit(0.0), stage)).alias("found"))).drop("form"), "active")
        active = short_pairs(active, index, stage)
        # Pairs of two short ones are done, all others are left.
        short = F.col("known") <= SHORT
        long_targets, long_strings = not index.long.isEmpty(), not active.where(~short).isEmpty()
        done = active.where(short)
        done = long_pairs(done, index.long, index, stage) if long_targets else done
        if long_strings:
            done = done.select("id", "best").unionByName(long_pairs(active.where(~short), index.targets, index, stage).select("id", "best"))
        strings = written(_better(strings, done.select("id", F.col("best").alias("found"))), "strings")
    return strings


def results(strings: DataFrame, group: list[str]) -> DataFrame:
    fields = [F.col(f"best.{name}").alias(name) for name in ("s_type", "target", "distance", "adjusted", "stage")]
    return strings.select("text", *group, *fields)


def nearest(rows: DataFrame, refs: DataFrame, keys: list[str], group: list[str] | None = None, stages: int = 4) -> DataFrame:
    """What ``matching.nearest`` returns, for reference sets of any size: (keys, s_type, target, distance,
    adjusted, stage). Every different text is searched once; each step is written."""
    group = group or []
    found = results(improved(start(rows, refs, group), refs, group, stages), group)
    mine = found.withColumnsRenamed({name: f"found_{name}" for name in ("text", *group)})
    same = F.col("text").eqNullSafe(F.col("found_text"))
    for g in group:
        same = same & (F.col(g) == F.col(f"found_{g}"))
    return rows.join(mine, same).select(*keys, "s_type", "target", "distance", "adjusted", "stage")
