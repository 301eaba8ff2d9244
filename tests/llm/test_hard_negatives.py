from __future__ import annotations

import math
import random

import numpy as np
import pytest
from compare import connect, differences
from fixtures import SF_DIR, read

from kolumna.llm import hard_negatives, queries

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
FIELDS = "vec_id long, label int, embedding array<float>, score string, x int, `a.b` string, __x string"


def by_hand(rows):
    rows = [
        (i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in vector])
        for i, label, vector in rows
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    answer = []
    for a, label, vector in rows:
        if a is None or a % 100:
            continue
        scored = [(sum(x * y for x, y in zip(vector, v)), i, l) for i, l, v in rows if i != a]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1]))
        for ps, p, _ in [s for s in scored if s[2] == label][:5]:
            negatives = [s for s in scored if s[2] != label and 80 * ps <= 100 * s[0] <= 100 * ps][:5]
            answer += [(a, p, rank, n, ps, ns) for rank, (ns, n, _) in enumerate(negatives, 1)]
    return sorted(answer, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "dot", "bar") for r in rows], FIELDS)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in hard_negatives.mined(df).collect()), key=str)


def test_whole_table(spark):
    rows = [(r.vec_id, r.label, r.embedding) for r in read(spark, "embeddings").collect()]
    answer = found(read(spark, "embeddings"))
    assert answer == by_hand(rows) and len(answer) > 50


def test_sql(spark):
    name = "op12_hard_negatives"
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) == ""


@pytest.mark.parametrize("small", [False, True])
def test_edges(spark, monkeypatch, small):
    """Ties, repeated rows, nulls, bad numbers, vectors of several lengths; blocks of a few rows and anchors."""
    if small:
        for name, value in (("ROW_BLOCK", 7), ("ANCHOR_BLOCK", 2), ("SENT_NUMBERS", 12)):
            monkeypatch.setattr(hard_negatives, name, value)
    rng = random.Random(8)
    hot = [0.5, 0.25, -0.125, 1.0]
    rows = [(i, rng.choice([0, 1, 2]), rng.choice([hot, [rng.uniform(-1, 1) for _ in range(4)]])) for i in range(0, 700)]
    rows += [(1001, 1, None), (1002, None, hot), (1003, 1, [0.5, None, 1.0, 2.0]), (1004, 0, [math.nan] * 4), (1005, 0, [math.inf, 0.0, 0.0, 0.0])]
    rows += [(1006, 0, []), (1007, 1, hot[:2]), (None, 0, hot), (None, 1, hot), (8, 1, [9.0] * 4), (8, 1, [9.0] * 4), (1100, None, hot), (1200, -4, hot)]
    assert found(frame(spark, rows)) == by_hand(rows)


def test_empty(spark):
    none = frame(spark, [(1, None, None)])
    assert hard_negatives.mined(none).collect() == [] and hard_negatives.mined(none.limit(0)).collect() == []


def test_residues_give_exact_scores():
    rng = np.random.default_rng(5)
    for n_dims, most in ((1, 1), (64, 200), (300, 40_000), (7, 2**23)):
        a, b = (rng.integers(-most, most + 1, (9, n_dims)) for _ in range(2))
        a[0], b[0], b[1] = most, most, -most
        scorer = hard_negatives.Scorer(n_dims * most**2, a)
        scores = np.concatenate([scores for _, scores in scorer.blocks(b)])
        assert (scores == a @ b.T).all()


def test_scores_beyond_a_long(spark):
    with pytest.raises(ValueError, match="scale"):
        hard_negatives.mined(frame(spark, [(100, 1, [1e30]), (1, 1, [1.0])]))
