from __future__ import annotations

import os
import random
import sys
from collections import Counter, defaultdict

import pytest
from fixtures import SF_DIR, TEXTS, edge_rows, read

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
from compare import connect, differences  # noqa: E402

from kolumna.llm import mixing, queries, shards  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) == ""


def plain_shards(rows, limit):
    """{hash: prefix}: split a bucket while it is too large and holds more than one hash."""
    placed = {}

    def split(prefix, members):
        if sum(b for _, b in members) <= limit or len(members) <= 1 or len(prefix) == shards.HASH_BITS:
            placed.update({h: prefix for h, _ in members})
            return
        for bit in "01":
            split(prefix + bit, [m for m in members if f"{m[0]:0{shards.HASH_BITS}b}"[len(prefix)] == bit])

    split("", rows)
    return placed


@pytest.mark.parametrize("limit", [500, 3000, 40_000, 10**9])
def test_directory(spark, limit):
    docs = read(spark).withColumns({"h": shards.row_hash("doc_id", "text"), "b": shards.n_bytes("text")})
    rows = docs.select("doc_id", "h", "b").collect()
    expected = plain_shards([(r.h, r.b) for r in rows], limit)
    found = {r.doc_id: r.shard for r in shards.assigned(read(spark), limit).collect()}
    assert found == {r.doc_id: expected[r.h] for r in rows}


def test_shards_of_equal_rows(spark):
    rows = [(None, "x" * 10)] * 60 + [(None, None)] * 30 + [(i, "y" * i) for i in range(40)] + [(99, "z" * 500)]
    found = shards.assigned(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    size, n = Counter(), Counter()
    for r in found:
        size[r.shard] += r.n_bytes
        n[r.shard] += 1
    assert all(size[s] <= 50 or n[s] == 1 for s in size)


def test_shard_edges(spark):
    found = shards.assigned(edge_rows(spark), 1000).collect()
    assert Counter((r.doc_id, r.text, r.n_bytes) for r in found) == Counter((i, t, len((t or "").encode())) for i, t in TEXTS)
    assert shards.assigned(edge_rows(spark).limit(0), 1000).collect() == []


def test_schedule_is_fair():
    """Every block within its window, every source within one block of its share at every slot."""
    rng = random.Random(3)
    for _ in range(100):
        slots = mixing.slots_of({f"s{i}": rng.random() ** 3 + 1e-9 for i in range(rng.randint(1, 30))}, 100)
        frame, served = sum(slots.values()), Counter()
        for source, i, release, deadline, slot in mixing.schedule(slots):
            assert release <= slot < deadline and served[source] == i
            served[source] += 1
            assert all(abs(served[s] - n * (slot + 1) / frame) < 1 for s, n in slots.items())
        assert served == slots


def test_slots():
    assert mixing.slots_of({"a": 3, "b": 1}, 8) == {"a": 6, "b": 2} or sum(mixing.slots_of({"a": 3, "b": 1}, 8).values()) == 8
    assert sum(mixing.slots_of({str(i): 0.0 for i in range(700)}, 1000).values()) == 1400
    assert mixing.slots_of({None: 1.0}, 10) == {None: 10}


def plain_mixture(rows, weights, block_bytes, frame):
    """{(doc_id, order)}: block and slot by counting through each source in order."""
    slots = mixing.slots_of(weights, frame)
    place = {(s, i): slot for s, i, _, _, slot in mixing.schedule(slots)}
    out, groups = {}, defaultdict(list)
    for r in rows:
        groups[r.source].append(r)
    for source, members in groups.items():
        total = 0
        for r in sorted(members, key=lambda r: (r.order, r.doc_id)):
            block, n = total // block_bytes, slots[source]
            out[r.doc_id] = (block, block // n * sum(slots.values()) + place[source, block % n])
            total += r.size
    return out


def test_mixture(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 3)
    weights = {f"src{i}": 1.0 + i % 4 for i in range(20)}
    placed = mixing.mixed(read(spark), weights, 4096, 60).collect()
    rows = read(spark).withColumns({"order": shards.row_hash("doc_id", "text"), "size": shards.n_bytes("text")}).collect()
    assert {r.doc_id: (r.block, r.slot) for r in placed} == plain_mixture(rows, weights, 4096, 60)
    assert all(r.release <= r.slot < r.deadline for r in placed)
    assert len({(r.source, r.block) for r in placed}) == len({r.slot for r in placed})


def test_mixture_order_and_edges(spark):
    ordered = mixing.in_order(read(spark)).collect()
    slots = {r.doc_id: r.slot for r in mixing.mixed(read(spark)).collect()}
    places = [slots[r.doc_id] for r in ordered]
    assert places == sorted(places) and len(places) == read(spark).count()
    found = mixing.mixed(edge_rows(spark), block_bytes=50).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(TEXTS)
    assert mixing.in_order(edge_rows(spark)).columns == edge_rows(spark).columns or "block" not in mixing.in_order(edge_rows(spark)).columns
    assert mixing.mixed(edge_rows(spark).limit(0)).collect() == []


@pytest.mark.parametrize("weights", [
    {"heavy": 0.14, **{f"s{i}": 0.86 / 19 for i in range(19)}}, {"half": 0.5, **{f"s{i}": 0.5 / 599 for i in range(599)}},
    {"a": 1.0, "rare": 1e-4, None: 0.3}, {"a": 2.0, "b": 1.0, "never": 0.0, "nor": 0.0},
])
def test_exact_shares(weights):
    """Within one block of the given weights at every slot, over many frames, until a source runs out."""
    total, n = sum(weights.values()), 12_000
    blocks = {s: int(n * w / total) + 1 if w else 5 for s, w in weights.items()}
    placed = mixing.exact_schedule(weights, blocks)
    assert {s: len(x[2]) for s, x in placed.items()} == blocks
    slots = [x for p in placed.values() for x in p[2]]
    assert len(slots) == len(set(slots))
    last = max(p[1][-1] for s, p in placed.items() if weights[s])
    for s, (release, deadline, slot) in placed.items():
        assert list(slot) == sorted(slot) and all(a <= x < b for a, b, x in zip(release, deadline, slot))
        if weights[s]:
            w = weights[s] / total
            # Before its i-th block is served i blocks are, after it i + 1.
            assert all(i - x * w < 1 + 1e-6 and i - x * w > -1 - 1e-6 and abs(i + 1 - (x + 1) * w) < 1 + 1e-6 for i, x in enumerate(slot))
        else:
            assert min(slot) >= last


def test_exact_mixture(spark, monkeypatch):
    """Shares of the given weights in the rows, with blocks in more than one piece of the schedule."""
    monkeypatch.setattr(mixing, "GROUP_ROWS", 3)
    monkeypatch.setattr(mixing, "PIECE", 4)
    rows = read(spark).withColumns({"order": shards.row_hash("doc_id", "text"), "size": shards.n_bytes("text")}).collect()
    weights = {s: 1.0 + 100 * (k == 0) for k, s in enumerate(sorted({r.source for r in rows}))}
    groups, expected = defaultdict(list), {}
    for r in rows:
        groups[r.source].append(r)
    placed = mixing.exact_schedule(weights, {s: sum(r.size for r in m) // 512 + 1 for s, m in groups.items()})
    for source, members in groups.items():
        start = 0
        for r in sorted(members, key=lambda r: (r.order, r.doc_id)):
            expected[r.doc_id] = (start // 512, *(x[start // 512] for x in placed[source]))
            start += r.size
    for sent in (mixing.SENT_BLOCKS, 1):
        monkeypatch.setattr(mixing, "SENT_BLOCKS", sent)
        found = mixing.mixed(read(spark), weights, 512).collect()
        assert {r.doc_id: (r.block, r.release, r.deadline, r.slot) for r in found} == expected and len(found) == len(rows)
