"""Hard negatives: rows of other labels that score nearly as high against an anchor as its positives.

Scores are inner products of whole numbers and must be exact, so the matrices are multiplied in a
residue number system: one float32 product for each of several small primes, chosen so that no partial
sum leaves the whole numbers that a float32 holds, and the signed score by Chinese remaindering.
Anchors go to all rows in blocks of bounded size. A first pass finds the best positives of the
anchors of a block, a second one the best rows of other labels in the window below each positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kolumna.llm.common import BATCH_BYTES, arrow_schema, saved
from kolumna.operators.cells import quoted

SCALE = 256
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES, LEAST_PERCENT = 5, 5, 80
#: Whole numbers up to it are exact in float32; the largest modulus, so that a product takes in 64 dimensions.
EXACT, MAX_PRIME = 1 << 24, 1021
#: Rows and anchors that are multiplied at a time, and numbers in the anchors that are sent to every task at once.
ROW_BLOCK, ANCHOR_BLOCK, SENT_NUMBERS = 4096, 256, 1 << 20
#: Scores up to it can be told apart with their place in a block in one long.
MAX_SCORE = 1 << 50

_NONE = np.iinfo(np.int64).min


def primes_for(bound: int) -> list[int]:
    """Largest primes up to MAX_PRIME whose product exceeds twice ``bound``."""
    found, product, n = [], 1, MAX_PRIME
    while product <= 2 * bound + 1:
        if all(n % k for k in range(2, math.isqrt(n) + 1)):
            found.append(n)
            product *= n
        n -= 1
    return found


def residues(matrix: np.ndarray, prime: int) -> np.ndarray:
    """``matrix`` modulo ``prime`` in float32, by the residues next to zero."""
    half = prime // 2
    return ((matrix + half) % prime - half).astype(np.float32)


def residue_product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """a @ b.T modulo ``prime`` of residues: exact, as the sums of each stretch of dimensions fit a float32."""
    stretch = max(1, EXACT // (prime // 2) ** 2)
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    for at in range(0, a.shape[1], stretch):
        total += (a[:, at : at + stretch] @ b[:, at : at + stretch].T).astype(np.int64)
    return total % prime


def remaindered(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed numbers next to zero with these remainders, digit by digit in the mixed base of the primes."""
    digits: list[np.ndarray] = []
    for k, prime in enumerate(primes):
        rest, base = parts[k], 1
        for digit, earlier in zip(digits, primes):
            rest, base = rest - digit * base, base * earlier % prime
        digits.append(rest * pow(base, -1, prime) % prime)
    value, base = np.zeros_like(parts[0]), 1
    for digit, prime in zip(digits, primes):
        value, base = value + digit * base, base * prime
    return np.where(value > base // 2, value - base, value)


class Scorer:
    """Exact inner products of the rows of two integer matrices."""

    def __init__(self, bound: int, anchors: np.ndarray) -> None:
        self.primes = primes_for(bound)
        self.anchors = [residues(anchors, p) for p in self.primes]

    def blocks(self, rows: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        theirs = [residues(rows, p) for p in self.primes]
        for at in range(0, len(self.anchors[0]), ANCHOR_BLOCK):
            part = slice(at, at + ANCHOR_BLOCK)
            yield part, remaindered([residue_product(a[part], b, p) for a, b, p in zip(self.anchors, theirs, self.primes)], self.primes)


def best(keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the ``k`` largest keys of each row, without the empty ones."""
    if keys.shape[1] > k:
        keys = np.partition(keys, keys.shape[1] - k, axis=1)[:, -k:]
    rows, columns = np.nonzero(keys != _NONE)
    return rows, keys[rows, columns]


def whole_numbers(vectors: DataFrame, id_column: str, label_column: str, vector_column: str) -> DataFrame:
    """(vec_id, label, x) of the rows that take part."""
    ids, label, vector = F.col(quoted(id_column)).cast("long"), F.col(quoted(label_column)).cast("long"), F.col(quoted(vector_column))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    part = label.isNotNull() & vector.isNotNull() & finite
    changed = F.when(F.coalesce(ids % RELABEL_EVERY == 0, F.lit(False)), (label + 1) % LABELS).otherwise(label)
    return vectors.where(part).select(ids.alias("vec_id"), changed.alias("label"), F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double"))).alias("x"))


def matrix_of(column: pa.ListArray, n_dims: int) -> np.ndarray:
    """The vectors of an Arrow column, shorter ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    if (lengths == n_dims).all():
        return values.reshape(len(lengths), n_dims)
    filled = np.zeros((len(lengths), n_dims), dtype=np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    filled[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return filled


def _row_blocks(batches: Iterable[pa.RecordBatch], n_dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, matrix) of up to ROW_BLOCK rows each, ordered by id, a null id as the largest."""
    held: list[pa.RecordBatch] = []

    def block(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        ids = rows.column(0).fill_null(np.iinfo(np.int64).max).to_numpy()
        order = np.argsort(ids, kind="stable")
        matrix = matrix_of(rows.column(2).chunk(0), n_dims)
        return ids[order], rows.column(1).to_numpy()[order], matrix[order]

    for batch in batches:
        for at in range(0, batch.num_rows, ROW_BLOCK):
            part = batch.slice(at, ROW_BLOCK)
            if held and sum(b.num_rows for b in held) + part.num_rows > ROW_BLOCK:
                yield block(held)
                held = []
            held.append(part)
    if held:
        yield block(held)


def _kept(found: list[np.ndarray], k: int, groups: int) -> np.ndarray:
    """Of rows (group columns, score, id) the best ``k`` of each group."""
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, -1], -rows[:, -2], *(rows[:, i] for i in reversed(range(groups)))))]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :groups] != rows[:-1, :groups]).any(axis=1)
    first = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
    return rows[np.arange(len(rows)) - first < k]


def scan(rows: DataFrame, n_dims: int, bound: int, anchors: tuple[np.ndarray, np.ndarray, np.ndarray], windows: list[np.ndarray] | None) -> DataFrame:
    """(anchor, nth, score, vec_id): the best rows of each task for each anchor.

    Without ``windows`` these are its positives (nth is 0), otherwise the rows of other labels in the window
    below the scores of ``windows[nth]``, one for each anchor (_NONE: it has no such positive).
    """
    sent = rows.sparkSession.sparkContext.broadcast((anchors, windows))
    schema = "anchor long, nth long, score long, vec_id long"
    fields = arrow_schema(rows.sparkSession, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (anchor_ids, anchor_labels, matrix), limits = sent.value
        scorer, found, size = Scorer(bound, matrix), [], 0
        for ids, labels, block in _row_blocks(batches, n_dims):
            n = len(ids)
            for part, scores in scorer.blocks(block):
                places = np.arange(n - 1, -1, -1)  # of equal scores the smaller id has the larger key
                same = anchor_labels[part, None] == labels
                others = anchor_ids[part, None] != ids
                if limits is None:
                    wanted = [same & others]
                else:
                    tops = [limit[part, None] for limit in limits]
                    wanted = [~same & others & (top != _NONE) & (LEAST_PERCENT * np.maximum(top, -MAX_SCORE) <= 100 * scores) & (scores <= top) for top in tops]
                keys = scores * n + places
                for nth, mask in enumerate(wanted):
                    at, kept = best(np.where(mask, keys, _NONE), POSITIVES if limits is None else NEGATIVES)
                    if len(at):
                        found.append(np.stack([anchor_ids[part][at], np.full(len(at), nth), kept // n, ids[n - 1 - kept % n]], axis=1))
                        size += len(at)
            if size > 8 * len(anchor_ids) * NEGATIVES * POSITIVES:
                found = [_kept(found, max(POSITIVES, NEGATIVES), 2)]
                size = 0
        if found:
            result = _kept(found, max(POSITIVES, NEGATIVES), 2)
            for at in range(0, len(result), BATCH_BYTES // 32):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(result[at : at + BATCH_BYTES // 32].T, fields.types)], schema=fields)

    return rows.mapInArrow(run, schema)


def ranked(rows: DataFrame, groups: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.col("score").desc(), F.col("vec_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mined(vectors: DataFrame, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    Rows with a null label, a null vector or a component that is null or not finite take no part. Shorter
    vectors are filled up with zeros. Anchors are told by their id: repeated rows of an anchor's id are one
    anchor, with the smallest label and vector of them, and none of its partners. Other repeated rows take part
    each, so that ranks of equal rows follow each other. A row without an id is no anchor and comes after equal
    scores; its id in the result is null. An empty table gives no row; extra columns are ignored. Scores beyond
    2**50 are an error.
    """
    spark = vectors.sparkSession
    rows = saved(whole_numbers(vectors, id_column, label_column, vector_column), "whole_numbers")
    largest = F.array_max(F.transform("x", lambda x: F.abs(x)))
    n_dims, most = rows.agg(F.max(F.size("x")), F.max(largest)).first()
    bound = (n_dims or 0) * (most or 0) ** 2
    if bound > MAX_SCORE:
        raise ValueError(f"scores of up to {bound}: scale the vectors down")
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("a"))
    anchors = saved(anchors.select("vec_id", "a.label", "a.x"), "anchors")
    results = spark.createDataFrame([], _RESULT)
    for block in anchor_blocks(anchors, n_dims or 0):
        results = results.unionByName(saved(_mined_block(rows, n_dims, bound, block), "negatives"))
    return results


def anchor_blocks(anchors: DataFrame, n_dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, matrix) of the anchors, SENT_NUMBERS numbers at a time, as the driver holds and sends them."""
    held, most = [], max(1, SENT_NUMBERS // max(1, n_dims))

    def block(part: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        matrix = np.array([r.x + [0] * (n_dims - len(r.x)) for r in part], dtype=np.int64).reshape(len(part), n_dims)
        return np.array([r.vec_id for r in part]), np.array([r.label for r in part]), matrix

    for row in anchors.toLocalIterator():
        held.append(row)
        if len(held) == most:
            yield block(held)
            held = []
    if held:
        yield block(held)


def _mined_block(rows: DataFrame, n_dims: int, bound: int, block: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """The result for the anchors of one block: two scans of all rows."""
    ids = block[0]
    positives = saved(ranked(scan(rows, n_dims, bound, block, None), ["anchor"], POSITIVES).select("anchor", "score", "vec_id", "rank"), "positives")
    spot = {int(one): i for i, one in enumerate(ids)}
    windows = [np.full(len(ids), _NONE) for _ in range(POSITIVES)]
    for r in positives.toLocalIterator():  # at most POSITIVES for each anchor of the block
        windows[r["rank"] - 1][spot[r.anchor]] = r.score
    negatives = ranked(scan(rows, n_dims, bound, block, windows), ["anchor", "nth"], NEGATIVES)
    pairs = positives.select(F.col("anchor").alias("anchor_id"), (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive"), F.col("score").alias("positive_score"))
    joined = negatives.join(pairs, (F.col("anchor") == F.col("anchor_id")) & (F.col("nth") == F.col("place")))
    return joined.select(
        "anchor_id", _id("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), _id("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def _id(name: str) -> Column:
    return F.when(F.col(name) != np.iinfo(np.int64).max, F.col(name))


def negatives_sql() -> str:
    """The same for ``embeddings`` in SQL."""
    return f"""
with rows as (
    select vec_id, case when vec_id % {RELABEL_EVERY} = 0 then (label + 1) % {LABELS} else label end as label,
        list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as x
    from embeddings
    where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scores as (
    select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
        cast(coalesce(list_sum(list_transform(list_zip(a.x, r.x), lambda p: p[1] * p[2])), 0) as bigint) as score
    from rows a join rows r on a.vec_id % {ANCHOR_EVERY} = 0 and a.vec_id <> r.vec_id
),
positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scores where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES}
)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
    vec_id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where not same and {LEAST_PERCENT} * positive_score <= 100 * score and score <= positive_score
qualify rank <= {NEGATIVES}"""
