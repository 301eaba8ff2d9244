from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from fixtures import SF_DIR, TEXTS, edge_rows, read

from kolumna.llm import credentials, quality, queries


def counted(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(text.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def measured(r):
    return int(r.n_words), r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_measures(spark):
    found = {r.doc_id: r for r in queries.quality_verdicts(spark, SF_DIR).collect()}
    for r in read(spark).collect():
        n = counted(r.text)
        assert measured(found[r.doc_id]) == n
        assert found[r.doc_id].base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])


def test_measure_edges(spark):
    found = quality.judged(edge_rows(spark)).collect()
    assert sorted(map(measured, found)) == sorted(counted(t) for _, t in TEXTS)
    assert all(r.base_failed and not r.kept for r in found if r.n_words < 20)
    assert quality.judged(edge_rows(spark).limit(0)).collect() == []


def test_repeated_windows(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(80)]
    found = quality.judged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_repeat_words for r in found} == {i: counted(t)[4] for i, t in enumerate(texts)}


def test_thresholds(spark):
    good = "It was the best of times and the worst of times for all who lived in that old city by the sea, as they said. "
    rows = [(1, good), (2, good.upper() * 1), (3, "### " * 3 + good.replace(" ", " $$ ")), (4, " ".join(f"k{i}zz" for i in range(40)))]
    found = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: True, 2: False, 3: False, 4: False}
    loose = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string"), rules=()).collect()}
    assert all(loose.values())


def plain_spans(text):
    found = []
    rules = [
        ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16),
    ]
    for k, (kind, pattern, group, least) in enumerate(rules):
        found += [(m.start(), k, kind, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


SECRETS = [
    "PassWord = 'abcdefghijkl' then token:short and API_KEY=\"0123456789abcdef0123\"", "AKIAABCDEFGHIJKLMN AKIAshort", "paſsword=abcdefghijklmnop",
    "ß 😀 secret: x.y/z+_==--aaaa deadbeefdeadbeef", "see https://u:pw@host/x and eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl and Bearer abcdefghijklmnopqrstuv",
    "passwd=passwd=passwd=passwd", "-----BEGIN RSA PRIVATE KEY-----\nAAAA\n-----END RSA PRIVATE KEY-----", "",
]


def test_secrets(spark):
    texts = [(i, t) for i, t in enumerate(SECRETS)] + [(100 + r.doc_id, r.text) for r in read(spark).collect()]
    found = {r.doc_id: r for r in credentials.find(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, text in texts:
        spans = plain_spans(text)
        assert found[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
        counts = Counter(k for k, _, _ in spans)
        assert (found[i].n_assign, found[i].n_access, found[i].n_hex) == (counts["assign"], counts["access"], counts["hex"])
        assert {f"{k}:{s}:{e}" for k, s, e in spans} <= set(found[i].spans.split(","))
    assert {s.split(":")[0] for s in found[4].spans.split(",")} == {"url_login", "web_token", "bearer"}
    assert found[6].spans.startswith("private_key:0:")


def test_secret_edges(spark):
    found = credentials.find(edge_rows(spark)).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in TEXTS)
    assert {r.spans for r in found} == {""}
    assert credentials.find(edge_rows(spark).limit(0)).collect() == []


@pytest.mark.parametrize("rule", [*credentials.BASE, *credentials.MORE], ids=lambda r: r.kind)
def test_queries_are_necessary(rule):
    """No text that a rule matches is missing from its candidates."""
    segment = credentials.Segment(SECRETS)
    rows = set(segment.candidates(credentials.trigram_query(rule.pattern)).tolist())
    assert {i for i, t in enumerate(SECRETS) if rule.pattern.search(t)} <= rows
    if rule.kind == "hex":
        assert credentials.trigram_query(rule.pattern) == credentials.ALWAYS
    if rule.kind == "access":
        assert rows == {1}


def test_long_runs_are_scanned_in_linear_time():
    """A megabyte of the letters of a scheme, of digits and of key characters: each rule in under a few seconds."""
    import time

    for text in ("a" * 1_000_000, "a1+.-" * 200_000, "x://" + "y" * 1_000_000, "token=" * 150_000, "AKIA" * 250_000):
        for rule in (*credentials.BASE, *credentials.MORE):
            begin = time.perf_counter()
            credentials.matches(text, rule)
            assert time.perf_counter() - begin < 3, rule.kind
