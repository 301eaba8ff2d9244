from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from fixtures import SF_DIR, edge_rows, read

from kolumna.llm import decontaminate, queries
from kolumna.llm.common import table


@pytest.fixture(scope="module")
def index(spark):
    return next(iter(decontaminate.indexes(table(spark, SF_DIR, "documents"), read(spark, "benchmark"))))


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_words():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([bytes([rng.choice(b"abcd")]) for _ in range(rng.randint(1, 40))] for _ in range(2))
        assert decontaminate.common_words(decontaminate.masks_of(a), len(a), b) == plain_common(a, b)


def test_whole_items(spark):
    flat = {r.doc_id: re.sub(r"\W+", " ", r.text.lower()) for r in read(spark).collect()}
    items = {r.item_id: " ".join(re.findall(r"\w+", r.text.lower())) for r in read(spark, "benchmark").collect()}
    truth = {(d, i) for d, t in flat.items() for i, x in items.items() if x in t}
    found = {(r.doc_id, r.item_id) for r in queries.benchmark_matches(spark, SF_DIR).collect()}
    assert truth and truth <= found
    assert {d for d, _ in found} == {d for d, _ in truth}


def test_recall_of_candidates(spark, index):
    """Against brute force: items of which a fifth of the words differ, planted in documents."""
    rng = random.Random(6)
    texts = [r.text for r in read(spark).orderBy("doc_id").collect()]
    words = [w.decode() for t in texts[:40] for w in decontaminate.words_of(t)]
    planted = set()
    for d in rng.sample(range(len(texts)), 60):
        item = rng.choice(index.items)
        changed = [w.decode() if rng.random() > 0.2 else rng.choice(words) for w in item.words]
        tokens = texts[d].split(" ")
        at = rng.randint(0, len(tokens))
        texts[d] = " ".join([*tokens[:at], *changed, *tokens[at:]])
        planted.add((d, item.item_id))
    parts = [decontaminate.words_of(t) for t in texts]
    truth = {(d, i) for d, i in planted if plain_common(next(x.words for x in index.items if x.item_id == i), parts[d]) >= 0.7 * len(next(x.words for x in index.items if x.item_id == i))}
    found = {(d, i) for d, one in enumerate(index.search(texts)) for i in one}
    assert len(truth) > 30 and len(truth & found) >= 0.9 * len(truth)


def test_bundles_hold_all_words(monkeypatch):
    texts = [None, "", "one", "Two, THREE four.", "É-lan", "x " * 400, "é" * 50]
    for part in (1 << 18, 64):
        monkeypatch.setattr(decontaminate, "PART", part)
        words = Counter()
        for bundle in decontaminate.bundles(texts):
            words.update(bundle.words(0, len(bundle.features)))
            assert len(bundle.projected(decontaminate.weighted_rows(*constant()))) == len(bundle.passages)
        if part > 64:
            assert words == Counter(w for t in texts for w in decontaminate.words_of(t))


def constant():
    import numpy as np

    return np.ones((decontaminate.FEATURES, 2), dtype=np.float32), np.ones(decontaminate.FEATURES, dtype=np.float32)


def test_projection_adds_words():
    import numpy as np

    table = decontaminate.weighted_rows(*constant())
    for n in (1, 15, 16, 17, 31, 32, 33, 100):
        (bundle,) = decontaminate.bundles([" ".join(f"w{i}" for i in range(n))])
        sums = bundle.projected(table)[:, 0]
        starts = bundle.first[bundle.passages]
        assert sums.tolist() == [min(s + 32, n) - s for s in starts] and starts[0] == 0 and starts[-1] + 32 >= n
        assert np.allclose(decontaminate._lengths(bundle, constant()[1]) ** 2, sums)


def test_edges(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "the quick brown fox jumps over the lazy dog and runs to the river with all of its friends"), (3, "the quick brown fox jumps over the lazy dog and runs to the river with all of its friends"), (None, "?!")], "item_id long, text string")
    found = decontaminate.contaminated(edge_rows(spark), items).collect()
    assert Counter(r.doc_id for r in found) == Counter({1: 2, None: 1}) and {r.item_id for r in found} == {3}
    kept = decontaminate.clean(edge_rows(spark), items)
    assert kept.columns == edge_rows(spark).columns and {r.doc_id for r in kept.collect()} == {2, 3, 4, None, 5, 6, 7, 8, 9}
    assert decontaminate.contaminated(edge_rows(spark).limit(0), items).collect() == []
    assert decontaminate.contaminated(edge_rows(spark), items.limit(0)).collect() == []
    assert decontaminate.clean(edge_rows(spark), items.limit(0)).count() == edge_rows(spark).count()


def test_recall_with_many_items(spark):
    """2,000 items by length: every verbatim one is found, and those with a fifth of the words changed."""
    rng = random.Random(9)
    docs = read(spark).orderBy("doc_id").collect()
    words = {r.doc_id: [w.decode() for w in decontaminate.words_of(r.text)] for r in docs}
    long = [d for d in words if len(words[d]) > 80]
    items = []
    for k in range(2000):
        source, n = words[rng.choice(long)], rng.choice([3, 6, 10, 16, 23, 40, 70])
        at = rng.randrange(len(source) - n)
        items.append((k, " ".join(source[at : at + n])))
    index = next(iter(decontaminate.indexes(read(spark), spark.createDataFrame(items, "item_id long, text string"))))
    everything = [w for d in long for w in words[d]]
    found, asked = Counter(), Counter()
    for k, text in items:
        own, around = text.split(), [rng.choice(everything) for _ in range(120)]
        changed = [rng.choice(everything) if rng.random() < 0.2 else w for w in own]
        for kind, planted in (("verbatim", own), ("changed", changed)):
            if plain_common(own, planted) >= 0.7 * len(own):
                (matches,) = index.search([" ".join([*around[:60], *planted, *around[60:]])])
                asked[kind, len(own)] += 1
                found[kind, len(own)] += k in matches
    print({k: (found[k], asked[k]) for k in sorted(asked)})
    for kind, n in asked:
        assert found[kind, n] >= (1.0 if kind == "verbatim" else 0.8 if n < 10 else 0.95) * asked[kind, n], (kind, n)


def test_fit_reads_all_documents(spark, monkeypatch):
    """Words, lengths and products of every different text, however many documents there are; repeated rows count in the weights."""
    import numpy as np

    monkeypatch.setattr(decontaminate, "FIT_TEXTS", 5)
    texts = [f"common words word{i} of{i % 7} document{i} " * (1 + i % 40) for i in range(60)] + ["twice told"] * 2 + ["", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(decontaminate, "latent_basis", lambda words, *rest: seen.extend(words.collect()))
    monkeypatch.setattr(decontaminate, "Index", lambda block, weights, basis: weights)
    (weights,) = decontaminate.indexes(rows, spark.createDataFrame([(1, "an item of words")], "item_id long, text string"))
    found = [r for r in seen if r.scale != decontaminate.ITEM_WEIGHT]
    alone = {t: next(decontaminate.bundles([t])).features for t in texts if t}
    assert Counter(bytes(r.features) for r in found) == Counter({f.astype("<u2").tobytes(): 1 for f in alone.values()})
    assert np.allclose([r.scale for r in found], (5 / len(texts)) ** 0.5)
    segments, total = np.zeros(decontaminate.FEATURES), 0
    for t in filter(None, texts):
        for at in range(0, len(alone[t]), decontaminate.STEP):
            segments[np.unique(alone[t][at : at + decontaminate.STEP])] += 1
            total += 1
    assert np.allclose(weights, np.log((1 + total) / (1 + segments)) + 0.01)


def test_product_adds_all_passages():
    import numpy as np

    rng = np.random.default_rng(4)
    rows = [rng.choice([3, 3, 3, *range(200)], n) for n in (1, 16, 17, 40, 500)]
    weights = rng.random(decontaminate.FEATURES).astype(np.float32) + 0.1
    table = decontaminate.weighted_rows(rng.random((decontaminate.FEATURES, 3)), weights)
    total, plain, lengths = np.zeros((decontaminate.FEATURES, 3), dtype=np.float32), np.zeros((decontaminate.FEATURES, 3)), []
    for row in rows:
        one = []
        for at in range(0, max(1, len(row) - decontaminate.STEP), decontaminate.STEP):
            passage = row[at : at + decontaminate.PASSAGE]
            norm = np.sqrt(((np.bincount(passage, minlength=decontaminate.FEATURES) * weights) ** 2).sum())
            np.add.at(plain, passage, 4 * table[passage].astype(float).sum(axis=0) / norm**2)
            one.append(norm)
        found = decontaminate._lengths(decontaminate.passages_of([row.astype("<u2").tobytes()]), weights)
        assert np.allclose(found, one)
        lengths.append(found.astype("<f4").tobytes())
    decontaminate.add_product(total, table, [row.astype("<u2").tobytes() for row in rows], lengths, [2.0] * len(rows))
    assert np.allclose(total, plain, rtol=1e-4)
