from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import pytest
from compare import connect, differences
from fixtures import SF_DIR, TEXTS, edge_rows, read

from kolumna.llm import filter_audit, queries

LETTERS = "ABCDE"


def fails_by_hand(rows):
    """Letters that each of ``rows`` (doc_id, part, text) fails."""
    ids = defaultdict(set)
    for i, _, text in rows:
        ids[text or ""].add(i)
    for i, part, text in rows:
        text = text or ""
        words = text.encode().split()
        failed = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": any(o is not None and (i is None or o < i) for o in ids[text]),
        }
        yield i, part or "", {x for x in LETTERS if failed[x]}


def by_hand(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    parts = defaultdict(list)
    for i, part, failed in fails_by_hand(rows):
        parts[part].append((i, failed))
    answer = set()
    for part, members in parts.items():
        table, total = [], Counter()
        for order in itertools.permutations(LETTERS):
            left = members
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[1]]
                left = [m for m in left if letter not in m[1]]
                failing = sum(letter in f for _, f in members)
                total[letter] += len(gone)
                alone = sum(f == {letter} for _, f in members)
                table.append(("".join(order), step, len(left), len(gone), failing - len(gone), alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        answer |= {(part, *t, total[t[0][t[1] - 1]]) for t in table}
    return answer


def check(spark, docs, labels):
    rows = [(r.doc_id, r.lang, r.text) for r in docs.collect()]
    marks = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    found = [tuple(r) for r in filter_audit.audited(docs, labels).collect()]
    assert set(found) == by_hand(rows, marks) and len(found) == len(set(found))


def test_whole_table(spark):
    check(spark, read(spark), read(spark, "labels"))


def test_sql(spark):
    name = "op11_filter_orders"
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) == ""


@pytest.mark.parametrize("cells", [1024, filter_audit.MAX_CELLS])
def test_edges(spark, monkeypatch, cells):
    """Nulls, repeated rows, hot texts and repeated labels, with a sketch that fits and one that is full."""
    if cells == 1024:
        for name, value in (("LEAST_CELLS", 1024), ("MAX_CELLS", 1024), ("SEGMENT", 256), ("FLUSH", 10)):
            monkeypatch.setattr(filter_audit, name, value)
    rng = random.Random(3)
    texts = TEXTS + [(i, rng.choice(["same $", "SAME", "", None, f"unique {i} " * 60])) for i in range(20, 400)] + [(None, "same $"), (None, "only here")]
    docs = edge_rows(spark, texts).withColumnsRenamed({"h": "mask", "kept": "digest", "score": "doubt", "shard": "part"})
    labels = spark.createDataFrame(
        [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for i in list(range(20, 200)) * 2 + [None]], "doc_id long, quality int, toxic int, mask string"
    )
    check(spark, docs, labels)
    check(spark, docs, labels.limit(0))


def test_empty(spark):
    assert filter_audit.audited(edge_rows(spark).limit(0), read(spark, "labels")).collect() == []


def test_sketch_clears_unique_texts(spark):
    docs = spark.createDataFrame([(i, "en", f"text {i if i < 3000 else i % 7}") for i in range(4000)], "doc_id long, lang string, text string")
    rows = filter_audit.measured(docs, "lang", "doc_id", "text")
    bits = filter_audit.sketch(rows, filter_audit.cells_for(4000))
    doubt = {r.doc_id: r.doubt for r in filter_audit.with_doubts(rows, bits).collect()}
    assert all(doubt[i] for i in range(3000, 4000)) and all(doubt[i] for i in range(7))
    assert sum(doubt[i] for i in range(7, 3000)) < 0.02 * 3000
