from __future__ import annotations

import hashlib
import random

import pytest
from compare import connect, differences
from fixtures import SF_DIR, TEXTS, edge_rows, read

from kolumna.llm import queries, word_repeats


def by_hand(rows, span):
    """(n_words, n_removed, kept words) of each of ``rows`` (doc_id, text)."""
    key = lambda i: (i is None, i or 0)
    first: dict = {}
    texts = [(key(i), (t or "").encode().split()) for i, t in rows]
    for i, words in texts:
        for at in range(len(words) - span + 1):
            window = tuple(words[at : at + span])
            first[window] = min(i, first.get(window, i))
    for i, words in texts:
        gone = bytearray(len(words))
        for at in range(len(words) - span + 1):
            if first[tuple(words[at : at + span])] < i:
                gone[at : at + span] = b"\1" * span
        yield len(words), sum(gone), [w for w, g in zip(words, gone) if not g]


def check(rows, found, span=word_repeats.SPAN):
    name = lambda r: (r[0] is None, *map(str, r))
    ours = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=name)
    theirs = [(i, n, gone, hashlib.sha256(b" ".join(kept)).hexdigest()) for (i, _), (n, gone, kept) in zip(rows, by_hand(rows, span))]
    assert ours == sorted(theirs, key=name)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in read(spark).collect()]
    check(rows, word_repeats.without_repeats(read(spark)).collect())


def test_sql(spark):
    name = "op13_word_repeats"
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) == ""


@pytest.mark.parametrize("part", [7, word_repeats.PART])
@pytest.mark.parametrize("span,anchor", [(6, 2), (6, 5), (2, 1), (10, 3)])
def test_few_words(spark, monkeypatch, part, span, anchor):
    """Repeats of all kinds: whole copies, passages with new neighbours, runs of one word, within one document."""
    monkeypatch.setattr(word_repeats, "PART", part)
    monkeypatch.setattr(word_repeats, "WORDS_HELD", 3)
    rng = random.Random(span * 10 + anchor)
    passage = [rng.choice("abcdefgh") for _ in range(14)]
    texts = []
    for i in range(60):
        words = [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(words))
            words[at:at] = passage[rng.randint(0, 4) : rng.randint(9, 14)] * rng.randint(1, 2)
        texts.append((rng.choice([i, i // 2, None]) if i % 9 == 0 else i, rng.choice([" ", "\n", " \t"]).join(words)))
    texts += [(70, texts[3][1]), (71, "a " * 40), (3, texts[3][1]), (72, "a " * 9), (None, texts[3][1]), texts[5]]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    check(texts, word_repeats.without_repeats(rows, span, anchor).collect(), span)


def test_edges(spark):
    rows = TEXTS + [(90, TEXTS[0][1] * 3), (91, TEXTS[0][1] * 3), (None, TEXTS[0][1] * 3), (92, "long " * 200_000), (93, "Long " * 300_000)]
    docs = edge_rows(spark, rows).withColumnRenamed("label", "anchor")
    check(rows, word_repeats.without_repeats(docs).collect())
    assert word_repeats.without_repeats(docs.limit(0)).collect() == []


def test_intervals(spark):
    docs = spark.createDataFrame([(1, "x a b c d y"), (2, "a b c d e f"), (3, "q a b c d")], "doc_id long, text string")
    found = {r.doc_id: r for r in word_repeats.without_repeats(docs, 3, 2).collect()}
    assert [[tuple(x) for x in found[i].intervals] for i in (1, 2, 3)] == [[], [(0, 4)], [(1, 5)]]
    assert [bytes(found[i].kept) for i in (1, 2, 3)] == [b"x a b c d y", b"e f", b"q"]


def test_words_at_hand_are_few():
    known, texts = word_repeats.WordHashes(), [b"%d" % i for i in range(300_000)]
    first = known.of(texts)
    assert len(known) <= 1 << 17 and (known.of(texts) == first).all()
