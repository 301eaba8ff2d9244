"""Mixing sources to target weights by Pfair scheduling.

A source of weight w owns blocks; its i-th block is released at floor((i - 1) / w) and due at
ceil(i / w). Serving the earliest deadline first on one line of slots meets all deadlines, so that at
every slot each source is within one block of its share until it has run out. All blocks are scheduled,
in exact integers.

With a ``frame`` weights are whole slots of it, at least one for each source: shares of light sources are
too large then, those of the others too small. One frame is scheduled and every later one repeats it.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolumna.llm.common import running_total, saved, sealed
from kolumna.llm.shards import HASH_BITS, n_bytes, row_hash

#: Slots of a frame: weights are multiples of one slot. With more sources than half of it, it grows to two for each.
FRAME = 1000
#: Blocks of one row of the exact schedule, and of a schedule that is sent to every task.
PIECE, SENT_BLOCKS = 1024, 1 << 20
#: Bytes of text in a block.
BLOCK_BYTES = 1 << 16
#: Sources are names of collections; their schedule is made on the driver and sent to every task.
MAX_SOURCES = 100_000
#: Rows that are ordered in one group.
GROUP_ROWS = 500
RESULTS = ("block", "release", "deadline", "slot")
#: Exponent that flattens the sizes of sources to weights where none are given.
FLATTEN = 0.5


def slots_of(weights: dict[str | None, float], frame: int = FRAME) -> dict[str | None, int]:
    """Whole slots of a frame for each source, at least one, by largest remainders."""
    frame = max(frame, 2 * len(weights))
    total = sum(weights.values())
    spare = frame - len(weights)
    exact = {s: spare * (w / total if total > 0 else 1 / len(weights)) for s, w in weights.items()}
    slots = {s: 1 + math.floor(x) for s, x in exact.items()}
    left = frame - sum(slots.values())
    for s in sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], str(s), s is None))[:left]:
        slots[s] += 1
    return slots


def schedule(slots: dict[str | None, int]) -> list[tuple[str | None, int, int, int, int]]:
    """(source, i, release, deadline, slot) of the blocks of one frame, i from 0, earliest deadline first."""
    frame = sum(slots.values())
    jobs = sorted((i * frame // n, -(-(i + 1) * frame // n), str(s), s is None, i, s) for s, n in slots.items() for i in range(n))
    ready: list = []
    placed, at = [], 0
    for slot in range(frame):
        while at < len(jobs) and jobs[at][0] <= slot:
            release, deadline, *name, i, s = jobs[at]
            heapq.heappush(ready, (deadline, *name, i, release, s))
            at += 1
        deadline, _, _, i, release, s = heapq.heappop(ready)
        placed.append((s, i, release, deadline, slot))
    return placed


def exact_schedule(weights: dict[str | None, float], blocks: dict[str | None, int]) -> dict[str | None, tuple[array, array, array]]:
    """Release, deadline and slot of every block of each source, by the given weights.

    Sources without weight come after all others, with equal shares. A slot whose blocks have all run
    out, or are not released yet, stays empty. Takes 24 bytes and one step of a heap for each block.
    """
    placed = {s: (array("q"), array("q"), array("q")) for s in blocks}
    heavy = {s: Fraction(weights[s]) for s in blocks if weights[s] > 0}
    begin = 0
    for shares in (heavy, {s: Fraction(1) for s in blocks if s not in heavy}):
        unit = math.lcm(1, *(w.denominator for w in shares.values()))
        whole = {s: int(w * unit) for s, w in shares.items()}
        total = sum(whole.values())
        waiting = [(0, str(s), s is None, s) for s in whole if blocks[s]]  # the next block of each source
        heapq.heapify(waiting)
        ready: list = []
        slot = end = 0
        while waiting or ready:
            if not ready:
                slot = max(slot, waiting[0][0])
            while waiting and waiting[0][0] <= slot:
                release, *name, s = heapq.heappop(waiting)
                i = len(placed[s][0])
                heapq.heappush(ready, (-(-(i + 1) * total // whole[s]), *name, release, s))
            deadline, *name, release, s = heapq.heappop(ready)
            for values, value in zip(placed[s], (release, deadline, slot)):
                values.append(begin + value)
            slot, end, i = slot + 1, max(end, deadline), len(placed[s][0])
            if i < blocks[s]:
                heapq.heappush(waiting, (i * total // whole[s], *name, s))
        begin += end
    return placed


def _pieces(schedule: dict[str | None, tuple[array, array, array]]) -> Iterator[tuple]:
    for s, values in schedule.items():
        for at in range(0, len(values[0]), PIECE):
            yield (s, at // PIECE, *(v[at : at + PIECE].tolist() for v in values))


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, block_bytes: int = BLOCK_BYTES, frame: int | None = None, source_column: str = "source", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with block, release, deadline and slot of every row; their order is the mixture.

    The rows of a source follow each other by the hash of id and text and are cut into blocks by the
    byte their text starts at. No row is dropped or repeated: a source that has run out leaves its
    slots to the others, whose shares keep their proportions. A null source is one of its own; sources
    without a given weight have the lightest given one; a null text has no bytes. Repeated rows each
    have their place, an empty table stays empty, columns with a result's name are replaced.
    More than MAX_SOURCES sources are an error. Without a ``frame`` the weights are exact.
    """
    docs, names, opened = sealed(docs, *RESULTS)
    return opened(_placed(docs, weights, block_bytes, frame, *(names[c] for c in (source_column, id_column, text_column))), *RESULTS)


def _placed(docs: DataFrame, weights, block_bytes: int, frame: int | None, source_column: str, id_column: str, text_column: str) -> DataFrame:
    """``mixed`` on plain names, with the hash by which rows follow each other as ``order_in_slot``."""
    columns = docs.columns
    docs = docs.withColumns({"__bytes": n_bytes(text_column), "__order": row_hash(id_column, text_column)})
    sizes = docs.groupBy(source_column).agg(F.sum("__bytes").alias("bytes"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: name coarser ones")
    if weights is None:
        shares = {r[0]: float(max(1, r.bytes)) ** FLATTEN for r in sizes}
    else:
        shares = {r[0]: weights.get(r[0], min(weights.values(), default=1.0)) for r in sizes}
    groups = max([1, *(math.ceil(r.n / GROUP_ROWS) for r in sizes)])
    spread = F.col("__order") / F.lit(2.0**HASH_BITS)
    placed = running_total(docs, [source_column], [F.col("__order"), F.col(id_column)], spread, "__bytes", "__total", groups)
    placed = placed.withColumn("block", F.floor(F.col("__total") / block_bytes))
    spark = docs.sparkSession
    if frame is None:
        blocks = {r[0]: r.bytes // block_bytes + 1 for r in sizes}
        pieces = spark.createDataFrame(
            list(_pieces(exact_schedule(shares, blocks))), "__source string, __piece long, __releases array<long>, __deadlines array<long>, __slots array<long>"
        )
        if sum(blocks.values()) <= SENT_BLOCKS:
            pieces = F.broadcast(pieces)
        own = F.col(source_column).cast("string").eqNullSafe(F.col("__source")) & (F.floor(F.col("block") / PIECE) == F.col("__piece"))
        named = [F.expr(f"__{n}s[int(block % {PIECE})]").alias(n) for n in ("release", "deadline", "slot")]
        return placed.join(pieces, own).select(*columns, "block", *named, F.col("__order").alias("order_in_slot"))
    slots = slots_of(shares, frame) if shares else {}
    length = sum(slots.values())
    table = spark.createDataFrame(
        [(s, slots[s], *rest) for s, *rest in schedule(slots)], "__source string, __n long, __i long, __release long, __deadline long, __slot long"
    )
    share = F.broadcast(table.select("__source", "__n").distinct().withColumnRenamed("__source", "__owner"))  # one row for each source
    placed = placed.join(share, F.col(source_column).cast("string").eqNullSafe(F.col("__owner")))
    frames = F.broadcast(table.drop("__n"))  # one row for each slot of a frame
    placed = placed.join(frames, F.col(source_column).cast("string").eqNullSafe(F.col("__source")) & (F.pmod("block", "__n") == F.col("__i")))
    start = F.floor(F.col("block") / F.col("__n")) * length
    return placed.select(
        *columns, "block", (start + F.col("__release")).alias("release"),
        (start + F.col("__deadline")).alias("deadline"), (start + F.col("__slot")).alias("slot"), F.col("__order").alias("order_in_slot"),
    )


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for every row, as ``row``: written, so that numbers stay the same."""
    return saved(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")


def slots(rows: DataFrame, source_column: str, id_column: str, text_column: str, weights=None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, slot, order_in_slot) of the numbered ``rows``; texts are measured and stay where they are."""
    narrow = rows.select("row", source_column, id_column, text_column)
    return _placed(narrow, weights, block_bytes, None, source_column, id_column, text_column).select("row", "slot", "order_in_slot")


def in_order(docs: DataFrame, weights: dict[str | None, float] | None = None, block_bytes: int = BLOCK_BYTES, source_column: str = "source", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` in the order of the mixture: by slot, within a slot by the hash of id and text.

    Takes what ``mixed`` takes; all columns stay. The order is found on numbers of rows; texts are shuffled
    twice, to their slots and into their order.
    """
    plain, names, opened = sealed(docs)
    rows = numbered(plain)
    places = saved(slots(rows, *(names[c] for c in (source_column, id_column, text_column)), weights, block_bytes), "slots")
    return opened(rows.join(places, "row").orderBy("slot", "order_in_slot", "row"))


def mixture_sql(block_bytes: int = BLOCK_BYTES, frame: int = FRAME) -> str:
    """The same for ``documents`` in SQL: slots by largest remainders, one frame by a recursion over its slots."""
    return f"""
with recursive rows as (
    select doc_id, source, coalesce(strlen(text), 0) as size,
        cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, {HASH_BITS // 4}) as bigint) as h
    from documents
),
sizes as (select source, pow(greatest(1, sum(size)), {FLATTEN}) as w from rows group by source),
shares as (
    select source, (f - s) * w / total as exact, f, s
    from sizes, (select greatest({frame}, 2 * count(*)) as f, count(*) as s, sum(w) as total from sizes)
),
slots as (
    select source, f, 1 + cast(floor(exact) as bigint)
        + case when row_number() over (order by floor(exact) - exact, source) <= f - s - sum(cast(floor(exact) as bigint)) over () then 1 else 0 end as n
    from shares
),
lists as (select list(source order by source) as sources, list(n order by source) as ns, any_value(f) as f from slots),
frame_slots as (
    select 0::bigint as slot, list_transform(ns, lambda n: 0::bigint) as served, cast(null as bigint) as pick, ns, f, sources from lists
    union all
    select slot + 1, list_transform(served, lambda c, i: case when i = chosen then c + 1 else c end), chosen, ns, f, sources
    from (select *, list_min(list_transform(list_filter(range(1, len(ns) + 1), lambda i: served[i] < ns[i] and (served[i] * f) // ns[i] <= slot),
            lambda i: [((served[i] + 1) * f + ns[i] - 1) // ns[i], i]))[2] as chosen from frame_slots where slot < f)
),
placed as (
    select sources[pick] as source, slot - 1 as slot, served[pick] - 1 as i, ns[pick] as n, f from frame_slots where pick is not null
),
blocks as (
    select doc_id, source, cast(coalesce(sum(size) over (partition by source order by h, doc_id
        rows between unbounded preceding and 1 preceding), 0) as bigint) // {block_bytes} as block
    from rows
)
select doc_id, b.source, block, (block // n) * f + (i * f) // n as release, (block // n) * f + ((i + 1) * f + n - 1) // n as deadline,
    (block // n) * f + slot as slot
from blocks b join placed p on b.source = p.source and block % n = i"""
