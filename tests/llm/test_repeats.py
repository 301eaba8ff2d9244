from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from fixtures import TEXTS, edge_rows, read

from kolumna.llm import repeats


def by_hand(texts, span):
    windows = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    answers = []
    for t in texts:
        removed = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if windows[t[i : i + span]] > 1:
                removed[i : i + span] = b"\1" * span
        runs = sum(1 for i in range(len(t)) if removed[i] and not (i and removed[i - 1]))
        kept = bytes(b for b, r in zip(t, removed) if not r)
        answers.append((len(t), sum(removed), runs, hashlib.sha256(kept).hexdigest()))
    return answers


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abc", bytes(range(256))])
def test_two_stage_order(letters):
    rng = random.Random(len(letters))
    for _ in range(60):
        text = bytes(rng.choice(letters) for _ in range(rng.randint(0, 250)))
        order = repeats.suffix_order(text, 30)
        keys = [text[i : i + 30] for i in order]
        assert sorted(order.tolist()) == list(range(len(text))) and keys == sorted(keys)


def test_common_prefixes():
    rng = random.Random(5)
    text = bytes(rng.choice(b"ab") for _ in range(400))
    order = repeats.suffix_order(text, 40)
    order = order[order <= len(text) - 40]
    found = repeats.common_prefixes(text, order, 40)
    for a, b, n in zip(order[:-1], order[1:], found):
        assert n == next((k for k in range(40) if text[a + k] != text[b + k]), 40)


@pytest.mark.parametrize("limit", [1, 3, repeats.PIECE_LIMIT])
def test_against_all_windows(spark, limit):
    """Shared lines with ever new neighbours, copies, runs of one letter; every path of crowded anchors."""
    rng = random.Random(11)
    line = "".join(rng.choice("abcdefgh ") for _ in range(70))
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randint(0, 90))) + line + "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 90))) for _ in range(25)]
    texts += [texts[0], texts[1][:-3] + "xyz", "a" * 200, "a" * 61, "ab" * 80, "", "é" * 90]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.without_repeats(rows, 60, 16, limit).collect()}
    assert [found[i] for i in range(len(texts))] == by_hand([t.encode() for t in texts], 60)


def test_whole_table(spark):
    rows = read(spark).orderBy("doc_id").collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.without_repeats(read(spark)).collect()}
    assert [found[r.doc_id] for r in rows] == by_hand([r.text.encode() for r in rows], 200)


def test_edges(spark):
    found = repeats.without_repeats(edge_rows(spark)).collect()
    answers = by_hand([(t or "").encode() for _, t in TEXTS], 200)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == sorted(
        (i or -1, *a) for (i, _), a in zip(TEXTS, answers)
    )
    assert repeats.without_repeats(edge_rows(spark).limit(0)).collect() == []


def test_parts_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PART", 300)
    rng = random.Random(2)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(700))
    texts = [shared + "x", "y" + shared, "".join(rng.choice("abcdefgh ") for _ in range(900))]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.without_repeats(rows).collect()}
    assert [found[i] for i in range(3)] == by_hand([t.encode() for t in texts], 200)
