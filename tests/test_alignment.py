"""Scores in words of bits against the plain tables, on strings of up to 200 characters."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from kolumna.functions import alignment


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            here = row[j + 1]
            row[j + 1] = before + 1 if x == y else max(here, row[j])
            before = here
    return row[-1]


def aligned(a, b):
    d = [[max(i, j) if i == 0 or j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def edited(rng, a, letters):
    b = list(a)
    for _ in range(rng.randint(0, 20)):
        i = rng.randrange(max(1, len(b) - 1))
        kind = rng.randrange(3)
        if kind == 0 and len(b) > 1:
            b[i], b[i + 1] = b[i + 1], b[i]
        elif kind == 1 and b:
            del b[i]
        else:
            b.insert(i, rng.choice(letters))
    return "".join(b)


def test_equal_scores(spark):
    rng = random.Random(1)
    pairs = [("", ""), ("a", ""), ("", "b"), ("ab", "ba"), ("a", "a"), ("a" * 60, "a" * 61), ("ab" * 60, "ba" * 60), ("x" * 120, "y" * 121)]
    for length in [0, 1, 2, 58, 59, 60, 61, 62, 119, 120, 121, 200] + [rng.randint(0, 200) for _ in range(100)]:
        letters = rng.choice(["ab", "abcdé", "abcdefghijklmnop"])
        a = "".join(rng.choice(letters) for _ in range(length))
        pairs.append((a, edited(rng, a, letters)))
        pairs.append((a, "".join(rng.choice(letters) for _ in range(rng.randint(0, 200)))))
    rows = spark.createDataFrame(pairs, "a string, b string")
    found = rows.select("a", "b", alignment.common_subsequence_length(F.col("a"), F.col("b")).alias("common"), alignment.alignment_distance(F.col("a"), F.col("b")).alias("distance"))
    for r in found.collect():
        assert (r.common, r.distance) == (subsequence(r.a, r.b), aligned(r.a, r.b)), (r.a, r.b)
