"""How filters interact: what each one removes in every order in which they may be applied.

The filters look at one text each, but for the last one, which asks whether a smaller doc_id has the
same text. A counting Bloom sketch of all texts comes first: a text with a cell that nothing else has
touched is unique for certain and never shuffled. Only possible repeats are grouped, by the SHA-256 of
the full text, for the smallest id of each. A row then is a mask of the filters it fails, and as every
figure of every order is a sum over masks, counts of masks are all that is gathered.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolumna.llm.common import arrow_schema, as_bytes, map_batches, saved
from kolumna.operators.cells import quoted

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
MARKS = "#$%&*|"
#: Cells of the sketch for each row, and cells that a text touches: 3 of 16 leave a unique text in doubt in
#: half a percent of the cases. The merged sketch is one bit a cell. Beyond MAX_CELLS (32 MB) it grows no
#: more: then it clears fewer texts and more digests are grouped, with the same result.
CELLS, TOUCHED, LEAST_CELLS, MAX_CELLS = 16, 3, 1 << 16, 1 << 28
#: Cells in a segment, the unit in which sketches are merged, and rows that a task sketches at a time.
SEGMENT, FLUSH = 1 << 16, 1 << 18

_MARK = re.compile(("[" + re.escape(MARKS) + "]").encode())
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_FOLLOWING = bytes(range(0x80, 0xC0))


def failures(text: bytes) -> int:
    """Bits of the filters A to D that ``text`` fails."""
    words = text.split()
    n_chars = len(text.translate(None, _FOLLOWING))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    fails = (len(words) < MIN_WORDS, 100 * len(set(words)) < MIN_DISTINCT * len(words), 100 * capitals > MAX_CAPITALS * n_chars, _MARK.search(text))
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def measured(docs: DataFrame, part_column: str, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, part, mask, digest) of every row, with the mask of the filters that look at its text alone."""
    rows = docs.select(
        F.col(quoted(id_column)).cast("long"), F.coalesce(F.col(quoted(part_column)).cast("string"), F.lit("")), F.col(quoted(text_column)).cast("string")
    )

    def of(batch: pa.RecordBatch) -> dict:
        texts = as_bytes(batch.column(2))
        return {
            "doc_id": batch.column(0), "part": batch.column(1), "mask": [failures(t) for t in texts],
            "digest": [hashlib.sha256(t).digest() for t in texts],
        }

    return map_batches(rows, of, "doc_id long, part string, mask int, digest binary")


def touched(digests: list[bytes], cells: int) -> np.ndarray:
    """Cells of each digest, one row for each."""
    words = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 4)[:, :TOUCHED]
    return (words & np.uint64(cells - 1)).astype(np.int64)


def sketch(rows: DataFrame, cells: int) -> np.ndarray:
    """Bits of the merged counting sketch of ``rows`` (digest): set where a cell was touched twice or more.

    Each task counts its own texts up to two and passes on the touched cells by segment, so that a text
    that a third of the rows share arrives once from each.
    """
    schema = arrow_schema(rows.sparkSession, "segment int, places binary, counts binary")
    merged = arrow_schema(rows.sparkSession, "segment int, bits binary")

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(parts), return_counts=True)
        segments, first = np.unique(found // SEGMENT, return_index=True)
        places = np.split((found % SEGMENT).astype(np.uint16), first[1:])
        counts = np.split(np.minimum(counts, 2).astype(np.uint8), first[1:])
        columns = segments.astype(np.int32), [p.tobytes() for p in places], [c.tobytes() for c in counts]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            parts.append(touched(batch.column(0).to_pylist(), cells).ravel())
            n += batch.num_rows
            if n >= FLUSH:
                yield counted(parts)
                parts, n = [], 0
        if n:
            yield counted(parts)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, total = None, np.zeros(SEGMENT, dtype=np.uint8)

        def bits() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"segment": [segment], "bits": [np.packbits(total > 1, bitorder="little").tobytes()]}, schema=merged)

        for batch in batches:
            for at, places, counts in zip(*(column.to_pylist() for column in batch.columns)):
                if segment is not None and at != segment:
                    yield bits()
                    total[:] = 0
                segment, own = at, np.frombuffer(places, dtype=np.uint16)
                total[own] = np.minimum(total[own] + np.frombuffer(counts, dtype=np.uint8), 2)
        if segment is not None:
            yield bits()

    partial = rows.select("digest").mapInArrow(count, "segment int, places binary, counts binary")
    whole = partial.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, bits binary")
    result = np.zeros(cells // 8, dtype=np.uint8)
    for row in whole.toLocalIterator():  # at most MAX_CELLS bits in all
        result[row.segment * SEGMENT // 8 : (row.segment + 1) * SEGMENT // 8] = np.frombuffer(row.bits, dtype=np.uint8)
    return result


def cells_for(n_rows: int) -> int:
    return min(MAX_CELLS, max(LEAST_CELLS, 1 << (CELLS * n_rows).bit_length()))


def with_doubts(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """``rows`` with ``doubt``: whether another row may have the same text. False is certain."""
    sent, cells = rows.sparkSession.sparkContext.broadcast(bits), 8 * len(bits)

    def of(batch: pa.RecordBatch) -> dict:
        places = touched(batch.column("digest").to_pylist(), cells)
        held = (sent.value[places >> 3] >> (places & 7).astype(np.uint8)) & 1
        return {name: batch.column(name) for name in batch.schema.names} | {"doubt": held.all(axis=1)}

    return map_batches(rows, of, "doc_id long, part string, mask int, digest binary, doubt boolean")


def flagged(docs: DataFrame, part_column: str = "lang", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, part, mask) of every row: bit i of the mask is set if it fails filter i of FILTERS.

    A null text is empty, a null part is an empty name. A row fails E if a smaller doc_id has the same text:
    equal rows of one id do not fail by each other, a null id is larger than any other.
    """
    rows = saved(measured(docs, part_column, id_column, text_column), "measured")
    marked = with_doubts(rows, sketch(rows, cells_for(rows.count())))
    certain = marked.where("not doubt").select("doc_id", "part", "mask")
    doubtful = saved(marked.where("doubt").drop("doubt"), "doubtful")
    # Joined by text and id: the copies of one text have different ids and do not meet in one task.
    first = saved(doubtful.groupBy("digest").agg(F.min("doc_id").alias("first")).withColumnRenamed("digest", "of"), "first")
    same = (F.col("digest") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first"))
    last = F.when(F.col("of").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return certain.unionByName(doubtful.join(first, same, "left").select("doc_id", "part", (F.col("mask") + last).alias("mask")))


def mask_counts(flags: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): rows of each mask, and how many of them a label calls good or toxic.

    Labels of one id count once, a null label as zero. Rows without a filter failed need none.
    """
    kinds = labels.where(F.col(quoted(id_column)).isNotNull()).groupBy(F.col(quoted(id_column)).cast("long").alias("labelled")).agg(
        *[F.coalesce(F.max(F.when(F.col(name) == 1, 1)), F.lit(0)).alias(f"is_{name}") for name in ("quality", "toxic")]
    )
    named = flags.join(kinds, F.col("doc_id") == F.col("labelled"), "left")
    return named.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("is_quality"), F.lit(0)).alias("good"), F.coalesce(F.sum("is_toxic"), F.lit(0)).alias("toxic")
    )


FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def order_figures(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> Iterator[tuple]:
    """(filter_order, step, *FIGURES) of every order, from counts by mask."""
    masks = np.arange(len(n))
    sizes = np.bitwise_count(masks)
    orders = list(itertools.permutations(range(len(FILTERS))))
    # In a share of 1 / size of all orders a filter comes first among those that a row fails.
    shapley = [int(sum(int(n[m]) * (len(orders) // int(sizes[m])) for m in masks if m >> f & 1)) for f in range(len(FILTERS))]
    for order in orders:
        before = 0
        for step, f in enumerate(order, start=1):
            own = (masks >> f & 1) == 1
            here = own & (masks & before == 0)
            before |= 1 << f
            figures = (n[masks & before == 0], n[here], n[own & ~here], n[masks == 1 << f], good[here], toxic[here])
            yield "".join(FILTERS[i] for i in order), step, *(int(x.sum()) for x in figures), shapley[f]


def audited(docs: DataFrame, labels: DataFrame, part_column: str = "lang", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(part, filter_order, step, *FIGURES) for all orders of the five filters in every part of ``docs``.

    Nulls are handled as in ``flagged`` and ``mask_counts``; repeated rows count each. An empty table has no
    part and gives no row; extra columns are ignored. A part's counts are at most 32 rows, whatever its size.
    """
    counts = mask_counts(flagged(docs, part_column, id_column, text_column), labels, id_column)
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in FIGURES)
    fields = arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, counted in zip(*(column.to_pylist() for column in batch.columns)):
                figures = np.zeros((3, 1 << len(FILTERS)), dtype=np.int64)
                for row in counted:
                    figures[:, row["mask"]] = row["n"], row["good"], row["toxic"]
                rows = list(order_figures(*figures))
                columns = [[part] * len(rows), *zip(*rows)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.types)], schema=fields)

    return by_part.mapInArrow(run, schema)


def audit_sql() -> str:
    """The same for ``documents`` and ``labels`` in SQL."""
    letters = ", ".join(f"('{letter}', {1 << i})" for i, letter in enumerate(FILTERS))
    return f"""
with texts as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
        min(doc_id) over (partition by coalesce(text, '')) as first
    from documents
),
masks as (
    select doc_id, part, case when len(words) < {MIN_WORDS} then 1 else 0 end
        + case when 100 * len(list_distinct(words)) < {MIN_DISTINCT} * len(words) then 2 else 0 end
        + case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MAX_CAPITALS} * length(text) then 4 else 0 end
        + case when regexp_matches(text, '[{MARKS}]') then 8 else 0 end
        + case when doc_id > first or (doc_id is null and first is not null) then 16 else 0 end as mask
    from texts
),
kinds as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id),
counts as (
    select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
    from masks left join kinds using (doc_id) group by part, mask
),
letters as (select * from (values {letters}) as t(letter, bit)),
orders as (
    select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
    from letters a, letters b, letters c, letters d, letters e where (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
),
steps as (
    select filter_order, step, bits[step] as own, cast(coalesce(list_sum(bits[1:step - 1]), 0) as integer) as before
    from (select filter_order, bits, unnest(range(1, 6)) as step from orders)
)
select part, filter_order, cast(step as integer) as step,
    cast(sum(case when mask & (before | own) = 0 then n else 0 end) as bigint) as kept,
    cast(sum(case when mask & own > 0 and mask & before = 0 then n else 0 end) as bigint) as removed,
    cast(sum(case when mask & own > 0 and mask & before > 0 then n else 0 end) as bigint) as redundant,
    cast(sum(case when mask = own then n else 0 end) as bigint) as unique_fails,
    cast(sum(case when mask & own > 0 and mask & before = 0 then good else 0 end) as bigint) as good_lost,
    cast(sum(case when mask & own > 0 and mask & before = 0 then toxic else 0 end) as bigint) as toxic_lost,
    cast(sum(case when mask & own > 0 then n * (120 // bit_count(mask)) else 0 end) as bigint) as shapley
from counts, steps
group by part, filter_order, step"""
