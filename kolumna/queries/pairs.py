"""Queries of the similarity joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from kolumna.operators import edit_pairs as e
from kolumna.operators import overlap
from kolumna.operators import set_pairs as s
from kolumna.queries.data import table

PART_TEXT = "concat(p_name, ' ', p_type)"
SWAPPED = "concat(substr(p_name, 1, 1), substr(p_name, 3, 1), substr(p_name, 2, 1), substr(p_name, 4))"


def strings(spark, sf, name, key, expression):
    rows = table(spark, sf, name).select(F.expr(key).alias("key"), F.expr(expression).alias("text"))
    return overlap.distinct_values(rows, "key", "text")


def documents(spark, sf):
    return strings(spark, sf, "documents", "doc_id", "text")


def part_names(spark, sf):
    return strings(spark, sf, "part", "p_partkey", "p_name")


def scores(pairs, *columns):
    return pairs.select("id0", "id1", *[F.round(c, 6).alias(c) for c in columns])


QUERIES = {
    "distinct_strings": lambda spark, sf: documents(spark, sf).select("id", F.length("value").alias("size"), "copies"),
    "shingle_counts": lambda spark, sf: s.shingle_counts(
        strings(spark, sf, "part", "p_partkey", PART_TEXT).select("id", "value"), "value", 3
    ),
    "jaccard_pairs": lambda spark, sf: scores(
        s.jaccard_pairs(documents(spark, sf), k=9, min_similarity=0.7), "similarity"
    ),
    "jaccard_between": lambda spark, sf: scores(
        s.jaccard_pairs(
            documents(spark, sf), strings(spark, sf, "benchmark", "item_id", "text"), k=9, min_similarity=0.1
        ),
        "similarity",
    ),
    "cosine_pairs": lambda spark, sf: scores(
        s.cosine_pairs(strings(spark, sf, "conversations", "conv_id * 1000 + turn", "text"), k=5, min_similarity=0.6),
        "similarity",
    ),
    "dice_pairs": lambda spark, sf: scores(
        s.dice_pairs(strings(spark, sf, "pages", "page_id", "url"), k=3, min_similarity=0.85), "similarity"
    ),
    "qgram_pairs": lambda spark, sf: s.qgram_pairs(
        strings(spark, sf, "part", "p_partkey", PART_TEXT), k=2, max_distance=6
    ),
    "qgram_pairs_of_short_strings": lambda spark, sf: s.qgram_pairs(
        strings(spark, sf, "documents", "doc_id", "concat(lang, source)"), k=3, max_distance=5
    ),
    "qgram_links": lambda spark, sf: s.qgram_classes(
        strings(spark, sf, "customer", "c_custkey", "cast(c_custkey as string)"), k=2, max_distance=4
    ).links(),
    "levenshtein_pairs": lambda spark, sf: e.levenshtein_pairs(
        strings(spark, sf, "customer", "c_custkey", "c_name"), max_distance=1
    ).select("id0", "id1", "distance"),
    "normalized_levenshtein_pairs": lambda spark, sf: scores(
        e.normalized_levenshtein_pairs(part_names(spark, sf), max_distance=0.3), "distance", "similarity"
    ),
    "normalized_levenshtein_urls": lambda spark, sf: scores(
        e.normalized_levenshtein_pairs(strings(spark, sf, "pages", "page_id", "url"), max_distance=0.25), "distance", "similarity"
    ),
    "metric_subsequence_names": lambda spark, sf: scores(
        e.metric_subsequence_pairs(strings(spark, sf, "supplier", "s_suppkey", "s_name"), max_distance=0.06), "distance"
    ),
    "alignment_pairs": lambda spark, sf: e.alignment_pairs(
        part_names(spark, sf), strings(spark, sf, "part", "p_partkey", SWAPPED), max_distance=1
    ).select("value0", "value1", "distance"),
    "subsequence_pairs": lambda spark, sf: e.subsequence_pairs(part_names(spark, sf), max_distance=3).select(
        "value0", "value1", "distance"
    ),
    "metric_subsequence_pairs": lambda spark, sf: scores(
        e.metric_subsequence_pairs(part_names(spark, sf), max_distance=0.25), "distance"
    ),
    "jaro_winkler_pairs": lambda spark, sf: scores(
        e.jaro_winkler_pairs(part_names(spark, sf), min_similarity=0.85), "similarity", "distance"
    ),
}


def strings_sql(name, key, expression):
    return f"select min({key}) as id, {expression} as value, count(*) as copies from {name} group by {expression}"


def profile_sql(source, k):
    """(id, shingle, n): all shingles of a string with their counts."""
    return f"""select id, substr(v, i, {k}) as shingle, count(*) as n
      from (select id, v, unnest(range(1, length(v) - {k - 2})) as i
            from (select id, regexp_replace(value, '\\s+', ' ', 'g') as v from ({source})))
      group by all"""


def set_pairs_sql(left, right, k, score, limit):
    """Every pair that shares a shingle, scored by ``score`` over n0, n1, common."""
    order = "where a.id < b.id" if right is None else ""
    return f"""with p0 as materialized ({profile_sql(left, k)}), p1 as materialized ({profile_sql(right or left, k)}),
        n0 as (select id, count(*) as n0, sqrt(sum(n * n)) as norm0, cast(sum(n) as bigint) as all0 from p0 group by id),
        n1 as (select id, count(*) as n1, sqrt(sum(n * n)) as norm1, cast(sum(n) as bigint) as all1 from p1 group by id),
        shared as (select a.id as id0, b.id as id1, count(*) as common, cast(sum(least(a.n, b.n)) as bigint) as least_n,
                     sum(a.n * b.n) as product from p0 a join p1 b using (shingle) {order} group by all)
      select id0, id1, {score} from shared join n0 on id0 = n0.id join n1 on id1 = n1.id where {limit}"""


def self_sql(source, columns, limit):
    return f"""with v as ({source}) select {columns} from v a join v b on a.id < b.id where {limit}"""


DOCUMENTS = strings_sql("documents", "doc_id", "text")
PARTS = strings_sql("part", "p_partkey", "p_name")
PART_TEXTS = strings_sql("part", "p_partkey", PART_TEXT)
JACCARD = "common / (n0 + n1 - common)"
LONGER = "greatest(length(a.value), length(b.value))"
# The prefix rule of the similarity: in full, weight at most 1 / longer length, above 0.7 only.
PREFIX = """len(list_filter(range(1, least(length(a.value), length(b.value)) + 1),
    lambda i: a.value[:i] = b.value[:i]))"""
WINKLER = f"""(case when jaro_similarity(a.value, b.value) > 0.7
    then jaro_similarity(a.value, b.value) + least(0.1, 1 / {LONGER}) * {PREFIX} * (1 - jaro_similarity(a.value, b.value))
    else jaro_similarity(a.value, b.value) end)"""

# Longest common subsequence of two strings, row by row.
COMMON = """list_reduce(
    list_concat([list_transform(range(0, length(b.value) + 1), lambda z: 0)], list_transform(range(1, length(a.value) + 1), lambda i: [i])),
    lambda above, x: list_reduce(
        list_concat([[0]], list_transform(range(1, length(b.value) + 1), lambda j: [j])),
        lambda row, y: list_append(row, greatest(row[-1], above[y[1] + 1],
            above[y[1]] + case when substr(a.value, x[1], 1) = substr(b.value, y[1], 1) then 1 else 0 end))))[-1]"""


def common_sql(source):
    return f"select *, {COMMON} as common, {LONGER} as longer from ({source}) a join ({source}) b on a.id < b.id"


SQL = {
    "distinct_strings": f"select id, length(value) as size, copies from ({DOCUMENTS})",
    "shingle_counts": f"select id, value, shingle, n from ({profile_sql(PART_TEXTS, 3)}) join ({PART_TEXTS}) using (id)",
    "jaccard_pairs": set_pairs_sql(DOCUMENTS, None, 9, f"round({JACCARD}, 6) as similarity", f"{JACCARD} >= 0.7"),
    "jaccard_between": set_pairs_sql(
        DOCUMENTS, strings_sql("benchmark", "item_id", "text"), 9, f"round({JACCARD}, 6) as similarity",
        f"{JACCARD} >= 0.1",
    ),
    "cosine_pairs": set_pairs_sql(
        strings_sql("conversations", "conv_id * 1000 + turn", "text"), None, 5,
        "round(product / (norm0 * norm1), 6) as similarity", "product / (norm0 * norm1) >= 0.6",
    ),
    "dice_pairs": set_pairs_sql(
        strings_sql("pages", "page_id", "url"), None, 3, "round(2 * common / (n0 + n1), 6) as similarity",
        "2 * common / (n0 + n1) >= 0.85",
    ),
    "qgram_pairs": set_pairs_sql(
        PART_TEXTS, None, 2, "all0 + all1 - 2 * least_n as distance", "all0 + all1 - 2 * least_n <= 6"
    ),
    "qgram_pairs_of_short_strings": f"""with v as ({strings_sql("documents", "doc_id", "concat(lang, source)")}),
        p as ({profile_sql(strings_sql("documents", "doc_id", "concat(lang, source)"), 3)}),
        t as (select id, greatest(length(value) - 2, 0) as n from v),
        shared as (select a.id as id0, b.id as id1, sum(least(a.n, b.n)) as c from p a join p b using (shingle)
                   where a.id < b.id group by all)
      select a.id as id0, b.id as id1, cast(a.n + b.n - 2 * coalesce(c, 0) as bigint) as distance
      from t a join t b on a.id < b.id left join shared on a.id = id0 and b.id = id1
      where a.n + b.n - 2 * coalesce(c, 0) <= 5""",
    "qgram_links": f"""with v as ({strings_sql("customer", "c_custkey", "cast(c_custkey as string)")}),
        p as ({profile_sql(strings_sql("customer", "c_custkey", "cast(c_custkey as string)"), 2)}),
        t as (select id, greatest(length(value) - 1, 0) as n from v),
        shared as (select a.id as id0, b.id as id1, sum(least(a.n, b.n)) as c from p a join p b using (shingle)
                   where a.id <> b.id group by all),
        near as (select id0, count(*) as k from shared join t a on a.id = id0 join t b on b.id = id1
                 where a.n + b.n > 4 and a.n + b.n - 2 * c <= 4 group by id0),
        far as (select a.id, count(b.id) as m from t a left join t b on a.id <> b.id and a.n + b.n <= 4 group by a.id)
      select t.id, cast(n as integer) as total, cast(m + coalesce(k, 0) as bigint) as links
      from t join far on far.id = t.id left join near on id0 = t.id""",
    "levenshtein_pairs": self_sql(
        strings_sql("customer", "c_custkey", "c_name"),
        "a.id as id0, b.id as id1, levenshtein(a.value, b.value) as distance", "levenshtein(a.value, b.value) <= 1",
    ),
    "normalized_levenshtein_pairs": self_sql(
        PARTS,
        f"""a.id as id0, b.id as id1, round(levenshtein(a.value, b.value) / {LONGER}, 6) as distance,
            round(1 - levenshtein(a.value, b.value) / {LONGER}, 6) as similarity""",
        f"levenshtein(a.value, b.value) / {LONGER} <= 0.3",
    ),
    # Up to distance 1 the restricted and the full distance with swaps agree.
    "alignment_pairs": f"""select a.value as value0, b.value as value1,
        damerau_levenshtein(a.value, b.value) as distance
      from ({PARTS}) a, ({strings_sql("part", "p_partkey", SWAPPED)}) b where damerau_levenshtein(a.value, b.value) <= 1""",
    "jaro_winkler_pairs": self_sql(
        PARTS, f"a.id as id0, b.id as id1, round({WINKLER}, 6) as similarity, round(1 - {WINKLER}, 6) as distance",
        f"{WINKLER} >= 0.85",
    ),
    "normalized_levenshtein_urls": self_sql(
        strings_sql("pages", "page_id", "url"),
        f"""a.id as id0, b.id as id1, round(levenshtein(a.value, b.value) / {LONGER}, 6) as distance,
            round(1 - levenshtein(a.value, b.value) / {LONGER}, 6) as similarity""",
        f"levenshtein(a.value, b.value) / {LONGER} <= 0.25",
    ),
    "subsequence_pairs": f"""select value as value0, value_1 as value1, length(value) + length(value_1) - 2 * common as distance
        from ({common_sql(PARTS)}) where length(value) + length(value_1) - 2 * common <= 3""",
    "metric_subsequence_pairs": f"""select id as id0, id_1 as id1, round(1 - common / longer, 6) as distance
        from ({common_sql(PARTS)}) where 1 - common / longer <= 0.25 + 1e-12""",
    "metric_subsequence_names": f"""select id as id0, id_1 as id1, round(1 - common / longer, 6) as distance
        from ({common_sql(strings_sql("supplier", "s_suppkey", "s_name"))}) where 1 - common / longer <= 0.06 + 1e-12""",
}
