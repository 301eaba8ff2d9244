from __future__ import annotations

import random
from collections import Counter

import numpy as np
import xxhash
from fixtures import TEXTS, edge_rows, read
from pyspark.sql import functions as F

from kolumna.llm import simhash
from kolumna.llm.common import connected


def plain_fingerprint(text, width):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(fps, bits):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(fps))]


def test_whole_table(spark):
    rows = read(spark).orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text, 3) for r in rows]
    roots = plain_classes(fps, 3)
    found = {r.doc_id: r for r in simhash.components(read(spark)).collect()}
    for r, fp, root in zip(rows, fps, roots):
        assert found[r.doc_id].fingerprint == f"{fp:016x}"
        assert found[r.doc_id].component_id == rows[root].doc_id


def test_crowded_variants(spark):
    """Many fingerprints around few centres, with a limit that cuts every key."""
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(4)]
    fps = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for c in centres for _ in range(150)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(f,) for f in signed], "fp long")
    for limit in (4, simhash.RUN_LIMIT):
        stars = {r.node: r.label for r in connected(simhash.links(rows, 3, limit), "test").collect()}
        ours = [stars.get(f, f) for f in signed]
        roots = plain_classes(fps, 3)
        assert len(set(zip(ours, roots))) == len(set(ours)) == len(set(roots))


def test_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(7, 7), (3, 9), (9, 3)]
    found = {r.node: r.label for r in connected(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert all(found[i] == 100 for i in range(100, 161)) and all(found[i] == 200 for i in range(200, 260))
    assert found[9] == found[3] == 3 and 7 not in found


def test_edges(spark):
    found = simhash.components(edge_rows(spark)).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in TEXTS)
    zero = {r.doc_id: r.component_id for r in found if r.fingerprint == "0" * 16}
    assert zero == {2: 2, 3: 2, 4: 2, None: 2}
    assert {r.component_id for r in found if r.doc_id == 1} == {1}
    assert simhash.components(edge_rows(spark).limit(0)).collect() == []


def kept_by_hand(rows, width=3, bits=3):
    """Of ``rows`` (doc_id, text) one of each class: the smallest id, none after all others."""
    roots = plain_classes([plain_fingerprint(t, width) for _, t in rows], bits)
    kept = {}
    for (i, _), root in zip(rows, roots):
        kept[root] = min((i is None, i or 0), kept.get(root, (True, 1 << 62)))
    return Counter(None if none else i for none, i in kept.values())


def test_one_of_each(spark):
    """Copies within the bits go by whatever chain, others stay; ties and repeated rows leave one."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    texts = []
    for k in range(12):
        base = [rng.choice(words) for _ in range(400)]
        texts.append(" ".join(base))
        for _ in range(8):
            base[rng.randrange(400)] = "changed"
            texts.append(" ".join(base))
    rows = [*enumerate(texts), (0, texts[0]), (None, texts[20]), (None, "alone " * 30), (500, None), (501, " ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("a.b", F.lit(None).cast("long")).withColumn("__row", F.lit(1))
    kept = simhash.one_of_each(frame)
    answer = kept_by_hand(rows)
    assert kept.columns == frame.columns and Counter(r.doc_id for r in kept.collect()) == answer
    assert 20 < sum(answer.values()) < len(rows) - 20
    wider = simhash.one_of_each(frame, 5, 6, run_limit=4)
    assert Counter(r.doc_id for r in wider.collect()).keys() >= kept_by_hand(rows, 5, 6).keys()
    edges = simhash.one_of_each(edge_rows(spark))
    assert Counter(r.doc_id for r in edges.collect()) == kept_by_hand(TEXTS)
    assert simhash.one_of_each(edge_rows(spark).limit(0)).collect() == []


def test_one_of_each_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in read(spark).collect()]
    assert Counter(r.doc_id for r in simhash.one_of_each(read(spark)).collect()) == kept_by_hand(rows)
    classes = {r.component_id for r in simhash.components(read(spark)).collect()}
    assert {r.doc_id for r in simhash.one_of_each(read(spark)).collect()} == classes
