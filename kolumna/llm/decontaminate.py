"""Benchmark items in documents, verbatim or paraphrased, by latent semantic retrieval.

Documents and items are cut into passages of words, weighted by TF-IDF over hashed words, and
projected on the leading singular vectors of a passage matrix. Passages whose projections have a high
cosine are candidates, and so are those that share runs of words with an item, whatever their cosine, so
that no verbatim item depends on the projection; a longest common subsequence of words, and for weaker ones a check of the
item's answer (its last sentence), decides.

Document frequencies count all passages of all documents. The singular vectors, which only find
candidates, are fitted to the items and all passages of all different documents by a distributed randomised SVD.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kolumna.llm.common import arrow_schema, mixed_bits, powers, prefix_hashes, saved, sealed
from kolumna.session import discard

#: Words of a passage, and from one passage to the next.
PASSAGE, STEP = 32, 16
#: Hashed words, and dimensions of the latent space at least; see ``rank_for``.
FEATURES, RANK, EXTRA = 1 << 15, 64, 8
#: The fit of the singular vectors reads all documents. Where they are more, they weigh as much as so many, so that the
#: items keep their part of the dimensions.
FIT_TEXTS = 4096
#: Tasks of the fit at least, each of which sends FEATURES x (RANK + EXTRA) numbers for every product; the words of one
#: at most, and those it multiplies together.
FIT_TASKS, TASK_WORDS, FIT_WORDS = 8, 1 << 24, 1 << 16
#: A feature that so many words of these have is frequent, and is added up so many words at a time.
FEW = 8
#: Columns of a sum that are added up together.
NEAR = 512
#: Factor of the items' passages in that matrix, so that their words get dimensions of their own.
ITEM_WEIGHT = 10.0
SEED = 20
#: Candidates have at least this cosine. Of an item's words, a match holds MIN_COMMON in order, or
#: MIN_LOOSE together with MIN_ANSWER of the words of its answer.
MIN_COSINE, MIN_COMMON, MIN_LOOSE, MIN_ANSWER = 0.65, 0.7, 0.55, 0.75
#: Words of a run that makes a candidate, and the share of an item's runs that have to begin in one segment.
GRAM, MIN_GRAMS = 3, 0.15
#: Bits of the table that tells which runs some item may have.
GRAM_BITS = 20
#: Items searched in one pass.
ITEM_BLOCK = 5_000
#: Bytes of texts handled together; longer texts are taken in overlapping parts.
PART = 1 << 18
#: Columns of the table that tells which words an item may have.
CHECK = 1 << 12

_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_IS_WORD = np.array([_WORD.fullmatch(bytes([b])) is not None for b in range(256)])
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def rank_for(items: int) -> int:
    """Dimensions of the latent space for so many items."""
    return max(RANK, 8 * math.isqrt(items))


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").lower().encode())


def summed(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For every column of ``places`` the sum of the rows of ``table`` that it names. Adding row by row touches memory in
    order, a few columns at a time stay near the processor; a segmented sum takes several times as long."""
    sums = np.empty((places.shape[1], table.shape[1]), dtype=np.float32)
    rows = np.empty((NEAR, table.shape[1]), dtype=np.float32)
    for at in range(0, len(sums), NEAR):
        part = sums[at : at + NEAR]
        table.take(places[0, at : at + NEAR], axis=0, out=part, mode="clip")
        for k in range(1, len(places)):
            one = rows[: len(part)]
            table.take(places[k, at : at + NEAR], axis=0, out=one, mode="clip")
            part += one
    return sums


class Passages:
    """Parts of texts as the features of their words, with their bounds.

    A segment is up to STEP words of one part, a passage two neighbouring segments or, in a short
    part, the only one.
    """

    def __init__(self, features: np.ndarray, bounds: np.ndarray):
        self.features = features
        self.bounds = bounds  # of the parts, in words
        segments = -(-np.diff(bounds) // STEP)
        part = np.repeat(np.arange(len(segments)), segments)
        self.first = bounds[part] + STEP * (np.arange(len(part)) - np.repeat(np.cumsum(segments) - segments, segments))
        alone = segments[part] == 1
        more = np.append(part[1:] == part[:-1], False)[: len(part)]
        self.passages = np.flatnonzero(more | alone)  # by their first segment
        self.alone = alone[self.passages]
        self.part = part[self.passages]
        self.segment_of_word = np.repeat(np.arange(len(part)), np.diff(np.append(self.first, len(features))))

    def by_place(self) -> np.ndarray:
        """Features of the first, second, ... word of all segments; FEATURES where a segment has ended."""
        ends = np.append(self.first, len(self.features))[1:]
        at = self.first + np.arange(STEP)[:, None]
        return np.append(self.features, FEATURES)[np.where(at < ends, at, len(self.features))]

    def projected(self, table: np.ndarray) -> np.ndarray:
        """Sums of the rows of ``table`` (one for each feature, a last one of zeros) over the words of every passage."""
        sums = summed(table, self.by_place())
        found = sums[self.passages]
        pairs = ~self.alone
        found[pairs] += sums[self.passages[pairs] + 1]
        return found


class Bundle(Passages):
    """Parts of texts with their words, as arrays."""

    def __init__(self, parts: list[tuple[int, bytes]], factors: tuple[np.ndarray, np.ndarray]):
        self.rows = np.array([row for row, _ in parts])
        self.data = b"\n".join(part for _, part in parts)
        codes = np.frombuffer(self.data, dtype=np.uint8)
        edges = np.diff(_IS_WORD[codes].astype(np.int8), prepend=0, append=0)
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sums = prefix_hashes(codes, factors[0])
        self.hashes = mixed_bits((sums[self.ends] - sums[self.starts]) * factors[1][self.starts])
        offsets = np.cumsum([0, *(len(part) + 1 for _, part in parts)])
        super().__init__((self.hashes >> np.uint64(40)).astype(np.int64) % FEATURES, np.searchsorted(self.starts, offsets))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, code) of the runs of ``n`` words within a part."""
        count = max(0, len(self.hashes) - n + 1)
        codes = np.zeros(count, dtype=np.uint64)
        for k in range(n):
            codes = mixed_bits(codes * np.uint64(0x9E3779B97F4A7C15) + self.hashes[k : k + count])
        part = self.part_of_word
        inside = np.flatnonzero(part[:count] == part[n - 1 : n - 1 + count])
        return inside, codes[inside]

    @property
    def part_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def words(self, begin: int, end: int) -> list[bytes]:
        return [self.data[a:b] for a, b in zip(self.starts[begin:end].tolist(), self.ends[begin:end].tolist())]


def bundles(texts: Iterable[str | None], overlap: int = 0) -> Iterator[Bundle]:
    factors = powers(2 * PART + (1 << 17))
    parts: list[tuple[int, bytes]] = []
    size = 0
    for row, text in enumerate(texts):
        data, at = (text or "").lower().encode(), 0
        while at < len(data):
            end = min(len(data), at + PART)
            if end < len(data):
                end = max(data.rfind(b" ", at, end), at + PART // 2)
            parts.append((row, data[at:end]))
            size += end - at + 1
            if size >= PART:
                yield Bundle(parts, factors)
                parts, size = [], 0
            at = end if end == len(data) else max(end - overlap, at + PART // 4)
    if parts:
        yield Bundle(parts, factors)


def distinct_words(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(features, copies): the features of the words of every different text, 16 bits each, with the rows that hold it.

    Written once, a third of the texts' bytes, so that the fit need not cut words again. Long texts have a row for each part.
    """
    schema = "digest string, part int, features binary"
    fields = arrow_schema(docs.sparkSession, schema)
    text = F.col(text_column).cast("string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, rows, number = batch.column(0).to_pylist(), [], Counter()
            for bundle in bundles(batch.column(1).to_pylist()):
                words = bundle.features.astype("<u2")
                for row, begin, end in zip(bundle.rows.tolist(), bundle.bounds[:-1].tolist(), bundle.bounds[1:].tolist()):
                    rows.append((digests[row], number[row], words[begin:end].tobytes()))
                    number[row] += 1
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(fields.types)], schema=fields)

    cut = docs.where(text.isNotNull()).select(F.sha2(text.cast("binary"), 256), text).mapInArrow(run, schema)
    return saved(cut.groupBy("digest", "part").agg(F.first("features").alias("features"), F.count("*").alias("copies")).drop("digest", "part"), "words")


def passages_of(rows: list[bytes]) -> Passages:
    """Parts of texts from the bytes of their words' features."""
    bounds = np.cumsum([0, *(len(row) // 2 for row in rows)])
    return Passages(np.frombuffer(b"".join(rows), dtype="<u2").astype(np.int64), bounds)


def grouped_words(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of the batches, some FIT_WORDS words at a time."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            rows.append(row)
            size += len(row[0]) // 2
            if size >= FIT_WORDS:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def inverse_frequencies(words: DataFrame) -> tuple[np.ndarray, int]:
    """Weight of every feature, from ``distinct_words``: the logarithm of all segments over those that hold it. Reads all
    documents. And the number of segments of different texts."""
    schema = "feature int, n long"
    fields = arrow_schema(words.sparkSession, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total, different = np.zeros(FEATURES, dtype=np.int64), 0, 0
        for rows in grouped_words(batches):
            found, copies = passages_of([row[0] for row in rows]), np.array([row[1] for row in rows])
            part = np.repeat(np.arange(len(copies)), np.diff(found.bounds))
            times = copies[part[found.first]]
            pairs = np.sort(found.segment_of_word * FEATURES + found.features)
            pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]]
            np.add.at(counts, pairs % FEATURES, times[pairs // FEATURES])
            total, different = total + int(times.sum()), different + len(times)
        some = np.flatnonzero(counts)
        columns = np.append(some, [-1, -2]), np.append(counts[some], [total, different])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.types)], schema=fields)

    rows = dict(words.mapInArrow(run, schema).groupBy("feature").agg(F.sum("n").alias("n")).collect())  # FEATURES + 2 rows
    total, different = rows.pop(-1, 0), rows.pop(-2, 0)
    df = np.zeros(FEATURES)
    df[list(rows)] = list(rows.values())
    return np.log((1.0 + total) / (1.0 + df)).astype(np.float32) + np.float32(0.01), different


def _lengths(found: Passages, weights: np.ndarray) -> np.ndarray:
    """Norms of the TF-IDF vectors of the passages."""
    squares = np.append(weights.astype(np.float64) ** 2, 0.0)
    places = found.by_place().astype(np.uint16)
    after = np.where(found.alone, FEATURES, places[:, np.minimum(found.passages + 1, len(found.first) - 1)]).astype(np.uint16)
    words = np.sort(np.concatenate([places[:, found.passages], after]), axis=0)
    total, again = squares[words[0]], np.zeros(len(found.passages), dtype=np.int64)
    for k in range(1, len(words)):  # n squared is 1 + 3 + ... + 2 n - 1
        again = np.where(words[k] == words[k - 1], again + 1, 0)
        total += squares[words[k]] * (2 * again + 1)
    return np.sqrt(total)


def with_lengths(words: DataFrame, weights: np.ndarray) -> DataFrame:
    """(features, lengths) of the rows of ``words``: the norms of their passages, four bytes each. Written, as every product needs them."""
    schema = "features binary, lengths binary"
    fields = arrow_schema(words.sparkSession, schema)
    sent = words.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped_words(batches):
            features = [row[0] for row in rows]
            found = passages_of(features)
            lengths = np.maximum(_lengths(found, sent.value), 1e-6).astype("<f4")
            bounds = np.searchsorted(found.part, np.arange(len(rows) + 1)).tolist()
            columns = features, [lengths[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], schema=fields)

    found = saved(words.select("features").mapInArrow(run, schema), "lengths")
    sent.destroy()
    return found


def weighted_rows(basis: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Rows of ``basis`` times the weight of their feature, and a row of zeros."""
    return np.concatenate([basis * weights[:, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)


def latent_basis(words: DataFrame, weights: np.ndarray, rank: int = RANK, tasks: int = FIT_TASKS) -> np.ndarray:
    """FEATURES x rank: leading right singular vectors of the passages of ``words`` (features, lengths, scale), each over
    its damped singular value, so that the words common to all passages do not drown the others.

    Randomised: the rows' range is found from random directions, the vectors from the product with it. Tasks hold the
    passages; what they send is a product with as many columns as the rank, added up over tasks.
    """
    spark = words.sparkSession
    width, block = rank + EXTRA, FEATURES // 64
    words = words.select("features", "lengths", F.col("scale").cast("float")).coalesce(tasks)
    fields = arrow_schema(spark, "block int, part binary")

    def product(directions: np.ndarray) -> np.ndarray:
        """AᵀA times ``directions``, for the unit passages A."""
        sent = spark.sparkContext.broadcast(directions.astype(np.float32))
        weighted = spark.sparkContext.broadcast(weights)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, table = None, weighted_rows(sent.value, weighted.value)
            for rows in grouped_words(batches):
                total = np.zeros((FEATURES, width), dtype=np.float32) if total is None else total
                add_product(total, table, *zip(*rows))
            if total is not None:
                total *= weighted.value[:, None]
                blocks = [total[i : i + block].tobytes() for i in range(0, FEATURES, block)]
                yield pa.RecordBatch.from_arrays([pa.array(range(64), pa.int32()), pa.array(blocks, pa.binary())], schema=fields)

        def added(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in parts:
                for number, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    sums[number] = sums.get(number, 0) + np.frombuffer(part, dtype=np.float32)
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], schema=fields)

        sums = words.mapInArrow(run, "block int, part binary").repartition(FIT_TASKS, "block").mapInArrow(added, "block int, part binary")
        result = np.zeros((FEATURES, width), dtype=np.float32)
        for number, part in sums.collect():  # 64 rows, FEATURES x width numbers together
            result[number * block : (number + 1) * block] = np.frombuffer(part, dtype=np.float32).reshape(block, width)
        for copy in (sent, weighted):  # else the driver keeps one of each for every product
            copy.destroy()
        return result.astype(np.float64)

    directions = np.random.default_rng(SEED).standard_normal((FEATURES, width)) / np.sqrt(width)
    directions = np.linalg.qr(product(directions))[0]
    # AᵀA from its second product alone (Nyström): image core⁻¹ imageᵀ, with small values of the core as zero.
    image = product(directions)
    values, turn = np.linalg.eigh(directions.T @ image)
    root = np.where(values > 1e-6 * values[-1], 1 / np.sqrt(np.maximum(values, 1e-12)), 0.0)
    image = image @ (turn * root)
    values, turn = np.linalg.eigh(image.T @ image)
    vectors = image @ (turn / np.sqrt(np.maximum(values, 1e-12)))
    # Damped, so that a direction with less than a few items in it is not blown up.
    scale = np.sqrt(np.maximum(values[::-1][:rank], 0) + 4 * ITEM_WEIGHT**2)
    return (vectors[:, ::-1][:, :rank] / scale).astype(np.float32)


def add_product(total: np.ndarray, table: np.ndarray, features: list[bytes], lengths: list[bytes], scales: list[float]) -> None:
    """Add to the row of every feature the projections on ``table`` of the passages that hold it, each over its squared
    norm and times its squared scale."""
    found = passages_of(features)
    factor = np.array(scales)[found.part] / np.frombuffer(b"".join(lengths), dtype="<f4")
    y = found.projected(table)
    y *= (factor**2).astype(np.float32)[:, None]
    of_segment = np.zeros((len(found.first) + 1, total.shape[1]), dtype=np.float32)  # a last row of zeros
    of_segment[found.passages] = y
    of_segment[found.passages[~found.alone] + 1] += y[~found.alone]
    order = np.argsort(found.features.astype(np.uint16), kind="stable")
    token, segment = found.features[order], found.segment_of_word[order]
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1])[: len(token)])
    count = np.diff(np.append(first, len(token)))
    for k in range(FEW - 1):
        some = first[(count < FEW) & (count > k)] + k
        for at in range(0, len(some), NEAR):  # small copies, as large ones cost more than the sums
            one = some[at : at + NEAR]
            rows = total.take(token[one], axis=0, mode="clip")
            rows += of_segment.take(segment[one], axis=0, mode="clip")
            total[token[one]] = rows
    first, count = first[count >= FEW], count[count >= FEW]
    if len(first):
        groups = -(-count // FEW)
        begin = np.cumsum(groups) - groups
        start = np.repeat(first, groups) + FEW * (np.arange(groups.sum()) - np.repeat(begin, groups))
        at = start + np.arange(FEW)[:, None]
        places = np.append(segment, len(found.first))[np.where(at < np.repeat(first + count, groups), at, len(segment))]
        total[token[first]] += np.add.reduceat(summed(of_segment, places), begin, axis=0)


class Item(NamedTuple):
    item_id: int
    words: list[bytes]
    answer: list[bytes]


def common_words(masks: dict[bytes, int], n: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence of an item's words, given as bit masks, with ``words``."""
    full = (1 << n) - 1
    state = full
    for word in words:
        found = masks.get(word)
        if found:
            u = state & found
            state = ((state + u) | (state - u)) & full
    return n - state.bit_count()


def masks_of(words: list[bytes]) -> dict[bytes, int]:
    masks: dict[bytes, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


class Index:
    """Items with their projected passages."""

    def __init__(self, items: list[Item], weights: np.ndarray, basis: np.ndarray):
        self.items = items
        self.table = weighted_rows(basis, weights)
        vectors, owner = [], []
        for bundle in bundles(b" ".join(i.words).decode() for i in items):
            vectors.append(bundle.projected(self.table))
            owner.append(bundle.rows[bundle.part])
        stacked = np.concatenate(vectors) if vectors else np.empty((0, basis.shape[1]), dtype=np.float32)
        self.vectors = (stacked / np.maximum(np.linalg.norm(stacked, axis=1, keepdims=True), 1e-9)).T.copy()
        self.owner = np.concatenate(owner) if owner else np.empty(0, dtype=np.int64)
        self.masks = [masks_of(i.words) for i in items]
        self.answers = [masks_of(i.answer) for i in items]
        self.sizes = np.array([len(i.words) for i in items])
        self.overlap = 2 * max((len(b" ".join(i.words)) for i in items), default=0) + 1024
        self.may_have = np.zeros((len(items), CHECK), dtype=bool)
        grams: dict[int, list] = {n: [np.empty((0, 2), dtype=np.uint64)] for n in range(1, GRAM + 1)}
        for bundle in bundles(b" ".join(i.words).decode() for i in items):
            for n in range(1, GRAM + 1):
                at, codes = bundle.grams(n)
                of = bundle.rows[bundle.part_of_word[at]]
                some = np.minimum(GRAM, self.sizes[of]) == n  # an item of fewer words is one run
                grams[n].append(np.stack([codes[some], of[some].astype(np.uint64)], axis=1))
            self.may_have[bundle.rows[np.searchsorted(bundle.bounds, np.arange(len(bundle.features)), side="right") - 1], bundle.features % CHECK] = True

        self.grams = {}
        for n, found in grams.items():
            pairs = np.unique(np.concatenate(found), axis=0)
            if len(pairs):
                known = np.zeros(1 << GRAM_BITS, dtype=bool)
                known[pairs[:, 0] >> np.uint64(64 - GRAM_BITS)] = True
                self.grams[n] = (known, pairs[:, 0].copy(), pairs[:, 1].astype(np.int64))
        runs = np.maximum(self.sizes - GRAM + 1, 1)
        self.least_grams = np.maximum(1, (MIN_GRAMS * np.minimum(runs, STEP)).astype(np.int64))

    def sharing(self, bundle: Bundle) -> tuple[np.ndarray, np.ndarray]:
        """Passages and items that have runs of words in common, enough of them in one segment."""
        passages, items = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        for n, (known, codes, owner) in self.grams.items():
            at, found = bundle.grams(n)
            some = known[found >> np.uint64(64 - GRAM_BITS)]
            at, found = at[some], found[some]
            first = np.searchsorted(codes, found)
            times = np.searchsorted(codes, found, side="right") - first
            item = owner[np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
            keys, hits = np.unique(np.repeat(bundle.segment_of_word[at], times) * len(self.items) + item, return_counts=True)
            segment, item = np.divmod(keys, len(self.items))
            enough = hits >= self.least_grams[item]
            # The passage that begins with the segment or, for the last segment of a part, the one before it.
            passages.append(np.searchsorted(bundle.passages, segment[enough], side="right") - 1)
            items.append(item[enough])
        return np.concatenate(passages), np.concatenate(items)

    def candidates(self, bundle: Bundle, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Passages, items and cosines: of at least ``least``, if the passage may have words enough of the item,
        or of any cosine with runs of words in common. In the order of the passages."""
        found = bundle.projected(self.table)
        found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)
        passages, columns, cosines = [], [], []
        for at in range(0, len(found), 512):
            cosine = found[at : at + 512] @ self.vectors
            flat = np.flatnonzero(cosine >= least)
            rows, column = np.divmod(flat, cosine.shape[1])
            passages.append(rows + at)
            columns.append(column)
            cosines.append(cosine.ravel()[flat])
        if not passages:
            return (np.empty(0, dtype=np.int64),) * 3
        passages, items, cosines = np.concatenate(passages), self.owner[np.concatenate(columns)], np.concatenate(cosines)
        start = bundle.first[bundle.passages[passages]]
        end = np.minimum(start + PASSAGE, bundle.bounds[bundle.part[passages] + 1])
        at = start[:, None] + np.arange(PASSAGE)
        inside = at < end[:, None]
        hits = (self.may_have[items[:, None], bundle.features[np.minimum(at, len(bundle.features) - 1)] % CHECK] & inside).sum(axis=1)
        # Of a match's words at least MIN_LOOSE are the item's, and some passage holds most of its own share.
        enough = hits >= 0.75 * MIN_LOOSE * np.minimum(self.sizes[items], PASSAGE)
        near = passages[enough] * len(self.items) + items[enough]
        shared, item = self.sharing(bundle)
        more = np.setdiff1d(shared * len(self.items) + item, near)
        shared, item = np.divmod(more, len(self.items))
        begin, end = np.searchsorted(self.owner, item), np.searchsorted(self.owner, item, side="right")
        cosine = np.full(len(more), -1.0, dtype=np.float32)
        for k in range(int((end - begin).max(initial=0))):  # of the item's passages the nearest
            some = begin + k < end
            cosine[some] = np.maximum(cosine[some], (found[shared[some]] * self.vectors[:, begin[some] + k].T).sum(axis=1))
        passages, items, cosines = (np.concatenate(x) for x in ((passages[enough], shared), (items[enough], item), (cosines[enough], cosine)))
        order = np.argsort(passages, kind="stable")
        return passages[order], items[order], cosines[order]

    def verified(self, words: list[bytes], k: int) -> tuple[float, float] | None:
        """Shares of the item's and of its answer's words that a window of ``words`` has in order, if enough."""
        item = self.items[k]
        n = len(item.words)
        width, step = n + n // 4 + 2, max(1, n // 4)
        best = (0.0, 0.0)
        for at in range(0, max(1, len(words) - width + step), step):
            window = words[at : at + width]
            best = max(best, (common_words(self.masks[k], n, window) / n, common_words(self.answers[k], len(item.answer), window) / len(item.answer)))
        return best if best[0] >= MIN_COMMON or (best[0] >= MIN_LOOSE and best[1] >= MIN_ANSWER) else None

    def search(self, texts: list[str | None], least: float = MIN_COSINE) -> list[dict[int, tuple[float, float, float]]]:
        """For each text its items: {item_id: (cosine, common, answer)}."""
        found: list[dict] = [{} for _ in texts]
        for bundle in bundles(texts, self.overlap):
            reach: dict[tuple[int, int], list] = {}
            passages, items, cosines = self.candidates(bundle, least)
            for passage, k, cosine in zip(passages.tolist(), items.tolist(), cosines.tolist()):
                spans = reach.setdefault((int(bundle.part[passage]), k), [])
                begin = int(bundle.first[bundle.passages[passage]])
                if spans and begin <= spans[-1][1]:
                    spans[-1][1], spans[-1][2] = max(begin + PASSAGE, spans[-1][1]), max(cosine, spans[-1][2])
                else:
                    spans.append([begin, begin + PASSAGE, cosine])
            for (part, k), spans in reach.items():
                n, row, name = len(self.items[k].words), int(bundle.rows[part]), self.items[k].item_id
                for begin, end, cosine in spans:
                    begin, end = max(int(bundle.bounds[part]), begin - n), min(int(bundle.bounds[part + 1]), end + n)
                    shares = self.verified(bundle.words(begin, end), k)
                    if shares:
                        found[row][name] = max(found[row].get(name, (0.0, 0.0, 0.0)), (shares[0], shares[1], cosine))
        return [{name: (c, a, b) for name, (a, b, c) in one.items()} for one in found]


def items_of(benchmark: DataFrame) -> Iterator[list[Item]]:
    """The benchmark in blocks, by item_id; items without words can match nothing."""
    block: list[Item] = []
    for item_id, text in benchmark.select("item_id", "text").orderBy("item_id").toLocalIterator():
        words = words_of(text)
        if words:
            last = [s for s in (words_of(s) for s in _SENTENCE.split(text)) if s][-1]
            block.append(Item(item_id, words, last))
        if len(block) == ITEM_BLOCK:
            yield block
            block = []
    if block:
        yield block


def indexes(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> Iterator[Index]:
    spark, n = docs.sparkSession, docs.count()
    words = distinct_words(docs, text_column)
    weights, segments = inverse_frequencies(words)
    tasks = max(FIT_TASKS, -(-segments * STEP // TASK_WORDS))
    fitted = with_lengths(words, weights).withColumn("scale", F.lit(math.sqrt(min(1.0, FIT_TEXTS / max(1, n)))))
    discard(words)
    for block in items_of(benchmark):
        rows = [bundle.features.astype("<u2").tobytes() for i in block for bundle in bundles([b" ".join(i.words).decode()])]
        items = with_lengths(spark.createDataFrame([(bytearray(row),) for row in rows], "features binary"), weights)
        both = fitted.unionByName(items.withColumn("scale", F.lit(ITEM_WEIGHT)))
        index = Index(block, weights, latent_basis(both, weights, rank_for(len(block)), tasks))
        discard(items)
        yield index
    discard(fitted)  # a caller searches after the fit of its last block


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = MIN_COSINE) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer): documents with the items they hold.

    A document without any has no row. Null, blank and empty texts and items hold nothing and match
    nothing; equal items and repeated rows each get their rows, null ids stay null; an empty table of
    either kind gives no row. Whole texts are read, extra columns are ignored.
    """
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = "doc_id long, item_id long, cosine double, common double, answer double"
    fields = arrow_schema(docs.sparkSession, schema)
    result = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(docs, benchmark, text_column):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (doc_id, item_id, *shares)
                    for doc_id, found in zip(batch.column(0).to_pylist(), sent.value.search(batch.column(1).to_pylist(), least))
                    for item_id, shares in sorted(found.items(), key=lambda x: (x[0] is None, x[0]))
                ]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(fields.types)], schema=fields)

        result = result.unionByName(picked.mapInArrow(run, schema))
    return result


def clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an item of ``benchmark``.

    Null, blank and empty texts hold nothing and stay, and so do all rows if the benchmark is empty; repeated rows go or
    stay together; an empty table stays empty.
    """
    docs, names, opened = sealed(docs)
    at = docs.columns.index(names[text_column])
    for index in indexes(docs, benchmark, names[text_column]):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not found for found in sent.value.search(batch.column(at).to_pylist())], pa.bool_()))

        docs = docs.mapInArrow(run, StructType(docs.schema.fields))
    return opened(docs)
