"""Exact similarity joins over token sets.

Two strings that are similar enough share one of their rarest tokens. So each string is indexed
under a short prefix of its tokens, rarest first, the prefixes are joined, and only the pairs found
are scored on the full strings. Common tokens hardly ever enter a prefix, hence a token that a third
of all strings hold makes no giant group; what remains large are true results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kolumna.functions.text import shingles
from kolumna.operators.steps import computed
from kolumna.session import written

#: Rows of a part in which a task sorts or collects.
ROWS_OF_PART = 500_000
#: Pairs of two numbers that go to every task, 16 bytes each.
FEW_PAIRS = 100_000


def rarity_buckets(k: int) -> int:
    """Size of the rarity table for tokens of ``k`` characters: longer tokens are more diverse."""
    return 1 << 14 if k <= 3 else 1 << 18


def distinct_values(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Each different string once: id (its smallest key), value, copies.

    Copies are counted before the shuffle, so heavily repeated strings cost one row each.
    """
    return rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(
        F.min(key).alias("id"), F.count("*").alias("copies")
    )


def shingle_tokens(k: int) -> Callable[[Column], Column]:
    """Hashed distinct shingles; a string without shingles has itself as its only token."""
    def tokens(value: Column) -> Column:
        parts = F.array_distinct(F.transform(shingles(value, k), lambda s: F.xxhash64(s)))
        return F.when(F.size(parts) > 0, parts).otherwise(F.array(F.xxhash64(F.lit("="), value)))

    return tokens


def character_tokens(value: Column) -> Column:
    """Hashed characters, numbered within equal ones, so that sets count repetitions."""
    characters = F.split(value, "")
    return F.transform(
        characters,
        lambda c, i: F.xxhash64(c, F.size(F.filter(F.slice(characters, F.lit(1), i + 1), lambda d: d == c))),
    )


def bucket(token: Column, buckets: int) -> Column:
    return F.pmod(token, F.lit(buckets)).cast("int")


def ranked_token(token: Column, levels: Column, buckets: int) -> Column:
    """The token as one number that sorts by rarity: its bucket's level, then 56 bits of its hash."""
    return F.get(levels, bucket(token, buckets)).cast("bigint") * (1 << 56) + F.pmod(token, F.lit(1 << 56))


def rarity(tokens: list[DataFrame], buckets: int) -> Column:
    """How common each token bucket is, as one array of ``buckets`` one-byte levels.

    Counting buckets in place of tokens bounds the table whatever the data, so it can go to every
    task; nothing is lost, as any fixed order of tokens gives exact results. Buckets that one of the tables has no
    token in have level 0: their tokens have no partner.
    """
    spark = tokens[0].sparkSession
    counts = None
    for i, df in enumerate(tokens):
        exploded = df.select(F.lit(i).alias("side"), F.explode_outer("tokens").alias("token")).select("side", bucket(F.col("token"), buckets).alias("bucket"))
        counts = exploded if counts is None else counts.unionAll(exploded)
    counts = counts.groupBy("bucket").agg(F.count("*").alias("n"), F.min("side").alias("first"), F.max("side").alias("last"))
    counts = counts.where((F.col("first") == 0) & (F.col("last") == len(tokens) - 1))
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    level = F.floor(4 * F.log2(1 + F.coalesce("n", F.lit(0)))).cast("tinyint")
    return every.join(counts, "bucket", "left").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("bucket", level.alias("level")))), lambda b: b["level"])
    ).scalar()


def spare(size: Column) -> Column:
    """By how many tokens a prefix is longer than it must be. A pair has to meet that many times
    more, which rules out most strings that share but a phrase."""
    return F.floor(size / 16)


def _prefixes(tokens: DataFrame, levels: Column, least: Callable[[Column], Column], buckets: int) -> DataFrame:
    """One row per prefix token: with ``least(size)`` tokens in common at the least, two strings
    must meet within the first size - least + 1 tokens, and again within each token more. Tokens of level 0
    come first and have no partner, so they get no row."""
    size = F.col("size")
    rarest_first = F.sort_array(F.transform("tokens", lambda t: ranked_token(t, F.col("levels"), buckets)))
    length = F.least(size, F.greatest(F.lit(0), size - F.greatest(least(size), F.lit(1)) + 1 + spare(size)))
    sized = tokens.select("id", "tokens", F.size("tokens").alias("size"), levels.alias("levels"))
    ranked = sized.select("id", "size", F.slice(rarest_first, F.lit(1), length).alias("prefix"))
    ranked = computed(ranked, alone=F.size(F.filter("prefix", lambda t: t < F.lit(1 << 56))))
    met = F.slice("prefix", F.col("alone") + 1, F.greatest(F.size("prefix"), F.lit(1)))
    found = ranked.select("id", "size", "alone", F.posexplode_outer(met).alias("pos", "token"))
    return found.select("id", "size", (F.col("pos") + F.col("alone")).alias("pos"), "token")


def join_sides(left: DataFrame, right: DataFrame | None, meets: Column, times: Column | None = None) -> DataFrame:
    """Different (id0, id1) pairs of rows a.*, b.* that meet, at least ``times`` if given. A table
    joined with itself is named once, so that Spark shuffles it once."""
    if right is None:
        meets = meets & (F.col("a.id") < F.col("b.id"))
    met = left.alias("a").join(merged((left if right is None else right).alias("b")), meets)
    needed = (F.lit(1) if times is None else times).alias("times")
    counted = met.select(F.col("a.id").alias("id0"), F.col("b.id").alias("id1"), needed).groupBy("id0", "id1").agg(
        F.count("*").alias("met"), F.max("times").alias("times")
    )
    return counted.where(F.col("met") >= F.col("times")).select("id0", "id1")


def candidates(
    left: DataFrame,
    right: DataFrame | None,
    tokens: Callable[[Column], Column],
    enough: Callable[[Column, Column], Column],
    least: Callable[[Column], Column],
    buckets: int = 1 << 14,
) -> DataFrame:
    """Pairs (id0, id1) that may share ``enough(size0, size1)`` tokens; none that do is missing.

    ``least(size)`` is the smallest ``enough`` over all partners. With ``right`` None a table is
    joined with itself, each pair once. Sizes and positions rule out most pairs inside the join.
    """
    return token_candidates([token_sets(side, tokens) for side in (left, right) if side is not None], enough, least, buckets)


def token_sets(df: DataFrame, tokens: Callable[[Column], Column]) -> DataFrame:
    """(id, tokens) of strings."""
    return computed(df, tokens=tokens(F.col("value"))).select("id", "tokens")


def token_candidates(
    sides: list[DataFrame], enough: Callable[[Column, Column], Column], least: Callable[[Column], Column], buckets: int
) -> DataFrame:
    """``candidates`` of one or two tables of token sets; several steps read them."""
    levels = rarity(sides, buckets)
    left_side, *right_side = [_prefixes(side, levels, least, buckets) for side in sides]
    rest = F.least(F.col("a.size") - F.col("a.pos"), F.col("b.size") - F.col("b.pos"))
    extra = spare(F.least("a.size", "b.size"))
    shared = enough(F.col("a.size"), F.col("b.size"))
    meets = (F.col("a.token") == F.col("b.token")) & (rest >= shared - extra)
    return join_sides(left_side, right_side[0] if right_side else None, meets, F.least(1 + extra, shared))


def spread(pairs: DataFrame) -> DataFrame:
    """Spread pairs evenly over all shuffle partitions: a pair is two ids, but costly to score, so
    the bytes by which Spark merges partitions say nothing about the work."""
    return pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id0", "id1")


def in_parts(table: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Partition a table by ``keys`` into parts of some ROWS_OF_PART rows, at least as many as shuffles have. Spark merges
    partitions by their compressed bytes, from which a task's memory does not follow: numbered names shrink tenfold."""
    least = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.repartition(max(least, -(-rows // ROWS_OF_PART)), *keys)


def merged(table: DataFrame) -> DataFrame:
    """A table that grows with the input, to be joined by sorting. Spark's guess of its size comes from a compressed file
    and leaves out what ``explode`` adds; a broadcast on that guess fills the driver."""
    return table.hint("merge")


def for_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs, written, to be joined with the tables they come from: few are broadcast, so that those tables need not
    be shuffled for them; many are spread."""
    pairs = written(pairs, "pairs")
    return F.broadcast(pairs) if pairs.count() <= FEW_PAIRS else spread(pairs)


def with_values(pairs: DataFrame, left: DataFrame, right: DataFrame | None = None) -> DataFrame:
    """Attach both strings to (id0, id1) pairs, spread for scoring."""
    other = left if right is None else right
    both = pairs.join(merged(left.select(F.col("id").alias("id0"), F.col("value").alias("value0"))), "id0").join(
        merged(other.select(F.col("id").alias("id1"), F.col("value").alias("value1"))), "id1"
    )
    return spread(both)


def whole(number: Column) -> Column:
    """Round up, forgiving the last bits of a product of floats."""
    return F.ceil(number - F.lit(1e-9))
