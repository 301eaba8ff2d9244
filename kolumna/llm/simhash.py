"""Near copies by SimHash: 64-bit fingerprints that differ in few bits.

Two fingerprints of 64 bits that differ in at most 3 differ in at most one bit in one of their two
halves. Every half is therefore indexed under its 32 one-wildcard variants (one bit left open), an
equality of variants gives the candidates, and a bit count verifies them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kolumna.llm.common import as_bytes, connected, map_batches, saved, sealed

SEED = 42
#: Fingerprints under one key that a task compares directly; beyond it the key is cut further.
RUN_LIMIT = 2048


def fingerprint(text: bytes, width: int) -> int:
    """SimHash of the word shingles of ``text``: a bit is 1 if it is set in over half the hashes."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    ends = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s:e], SEED) for s, e in zip(starts, ends)], dtype=">u8")
    count = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(hashes)).tobytes(), "big")


def _fingerprints(texts: pa.Array, width: int) -> np.ndarray:
    return np.array([fingerprint(t, width) for t in as_bytes(texts)], dtype=np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, width: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp long) of every row; null and blank texts have fingerprint zero."""

    def of(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "fp": _fingerprints(batch.column(1), width)}

    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return map_batches(picked, of, "doc_id long, fp long")


def _half(fp: Column, high: bool) -> Column:
    return F.shiftrightunsigned(fp, 32) if high else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _variants(value: Column, bits: int, tag: Column) -> Column:
    """One-wildcard variants of a ``bits``-bit value, each as one long: tag, open bit, rest."""
    full = (1 << bits) - 1
    return F.array(*[
        tag + F.lit(bit << 40) + value.bitwiseAND(F.lit(full ^ (1 << bit))) for bit in range(bits)
    ])


def variant_keys(fps: DataFrame, run_limit: int = RUN_LIMIT) -> DataFrame:
    """(fp, key, key2): equal keys are candidates.

    A key that more than ``run_limit`` fingerprints may share is cut by the variants of the two
    quarters of its other half: of at most 3 differing bits there, one quarter has at most one.
    Whether a key is crowded follows from counts of whole halves, two rows for each fingerprint.
    """
    halves = fps.select(
        F.explode(F.array(*[
            F.struct(F.lit(h << 50).alias("tag"), _half(F.col("fp"), bool(h)).alias("value")) for h in (0, 1)
        ])).alias("x")
    ).select("x.*")
    crowded = halves.groupBy("tag", "value").count().where(F.col("count") > run_limit // 2)
    crowded = crowded.select(F.explode(_variants(F.col("value"), 32, F.col("tag"))).alias("crowded_key")).distinct()
    keyed = fps.select("fp", F.explode(F.concat(*[_variants(_half(F.col("fp"), bool(h)), 32, F.lit(h << 50)) for h in (0, 1)])).alias("key"))
    keyed = keyed.join(crowded, F.col("key") == F.col("crowded_key"), "left")
    other = F.when(F.col("key") >= F.lit(1 << 50), _half(F.col("fp"), False)).otherwise(_half(F.col("fp"), True))
    quarters = F.concat(
        _variants(F.shiftrightunsigned(other, 16), 16, F.lit(1 << 50)), _variants(other.bitwiseAND(F.lit(0xFFFF)), 16, F.lit(2 << 50))
    )
    key2 = F.when(F.col("crowded_key").isNull(), F.array(F.lit(0).cast("long"))).otherwise(quarters)
    return keyed.select("fp", "key", F.explode(key2).alias("key2"))


def links_within(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all of ``values`` that are linked, directly or by others among them."""
    left, right, rest = [], [], values
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            near = np.bitwise_count(rest ^ one) <= bits
            if near.any():
                found = rest[near]
                left += [one] * len(found)
                right += found.tolist()
                queue += list(found)
                rest = rest[~near]
    return np.array(left, dtype=np.uint64), np.array(right, dtype=np.uint64)


def links(fps: DataFrame, bits: int = 3, run_limit: int = RUN_LIMIT) -> DataFrame:
    """(a, b): enough verified links to hold every class together, for distinct fingerprints ``fp``.

    Up to 3 bits all fingerprints within that distance are linked. With more, those of them are that
    share a variant, as they do with fewer errors in one half.
    """
    keys = variant_keys(fps, run_limit)
    keys = keys.repartition("key", "key2").sortWithinPartitions("key", "key2")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 3), dtype=np.int64)  # the run of the last key, which may go on
        for batch in batches:
            rows = np.concatenate([held, np.stack([column.to_numpy() for column in batch.columns], axis=1)])
            if len(rows):
                cut = len(rows) - int((rows[:, 1:] == rows[-1, 1:]).all(axis=1).sum())
                yield from linked(rows[:cut])
                held = rows[cut:]
        yield from linked(held)

    def linked(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = links_of_runs(rows[:, 0].copy().view(np.uint64), rows[:, 1:], bits)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    return keys.mapInArrow(scan, "a long, b long").distinct()


def links_of_runs(fps: np.ndarray, keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within every run of equal ``keys``."""
    new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    bounds = np.concatenate([[0], new, [len(fps)]]).astype(np.int64)
    sizes = np.diff(bounds)
    first = bounds[:-1][sizes == 2]
    first = first[np.bitwise_count(fps[first] ^ fps[first + 1]) <= bits]
    a, b = [fps[first]], [fps[first + 1]]
    for i in np.flatnonzero(sizes > 2):
        left, right = links_within(fps[bounds[i] : bounds[i + 1]], bits)
        a.append(left)
        b.append(right)
    return np.concatenate(a), np.concatenate(b)


def components(docs: DataFrame, width: int = 3, bits: int = 3, id_column: str = "doc_id", text_column: str = "text", run_limit: int = RUN_LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    Rows link if their fingerprints differ in ``bits`` bits at most; component_id is the smallest
    doc_id reachable, itself included. Null and blank texts have fingerprint zero and link like any
    other. Repeated rows and repeated ids each keep their row; a null doc_id takes part and is never
    the smallest, a class of nulls only has a null component_id. An empty table gives no row; extra
    columns are ignored.
    """
    fps = saved(fingerprints(docs, width, id_column, text_column), "fingerprints")
    named = labelled_classes(fps, bits, run_limit)
    return fps.join(named, F.col("fp") == F.col("f")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def labelled_classes(fps: DataFrame, bits: int, run_limit: int) -> DataFrame:
    """(f, label, component_id) of every different fingerprint of ``fps`` (doc_id, fp)."""
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    classes = saved(classes, "classes")
    stars = connected(links(classes.select("fp"), bits, run_limit), "stars")
    stars = stars.select(F.col("node").alias("fp"), "label")
    # Written like the minima above, so that joins on the label of a large class can be split.
    labelled = saved(classes.join(stars, "fp", "left").select("fp", "first_id", F.coalesce("label", "fp").alias("label")), "labelled")
    least = labelled.groupBy("label").agg(F.min("first_id").alias("component_id")).withColumnRenamed("label", "l")
    named = labelled.join(saved(least, "least"), F.col("label") == F.col("l"))
    return named.select(F.col("fp").alias("f"), "label", "component_id")


def one_of_each(docs: DataFrame, width: int = 3, bits: int = 3, id_column: str = "doc_id", text_column: str = "text", run_limit: int = RUN_LIMIT) -> DataFrame:
    """``docs`` with one row of each class of ``components``, that of the smallest doc_id.

    Null and blank texts are copies of each other. A null id comes after all others; of rows with the
    same id and text one stays, whatever their other columns. An empty table stays empty. Texts are
    shuffled once, to the keys of the rows that stay.
    """
    plain, names, opened = sealed(docs)
    ids, text = F.col(names[id_column]).cast("long"), F.col(names[text_column]).cast("string")
    row = F.xxhash64(ids.isNull(), text)
    keyed = plain.select("*", F.coalesce(ids, F.lit(0)).alias("id"), row.alias("row"))

    def of(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "row": batch.column(1), "fp": _fingerprints(batch.column(2), width)}

    fps = map_batches(plain.select(ids.alias("doc_id"), row.alias("row"), text.alias("text")), of, "doc_id long, row long, fp long")
    fps = saved(fps, "fingerprints")
    named = saved(labelled_classes(fps, bits, run_limit).select("f", "label"), "named")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    # Per fingerprint first, so that a class that holds a third of the rows is small before it meets.
    least = saved(fps.groupBy("fp").agg(first), "first_of_fingerprints").join(named, F.col("fp") == F.col("f"))
    kept = least.groupBy("label").agg(F.min("first").alias("first"))
    kept = saved(kept.select(F.coalesce("first.doc_id", F.lit(0)).alias("id"), "first.row"), "kept")
    return opened(keyed.join(kept, ["id", "row"]).dropDuplicates(["id", "row"]))
