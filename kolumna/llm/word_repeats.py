"""Repeated passages: every word covered by a window of ``SPAN`` words that starts in an earlier document too.

Windows go by Rabin-Karp hashes of their words. A corpus has as many windows as words, so they travel
in pieces: neighbouring windows that share an anchor, the run of ``ANCHOR`` words in them with the
smallest hash, which equal windows have in common. Anchors of one document only hold no repeat.
Pieces that are equal as a whole are settled by their smallest document; of an anchor with different
pieces, one piece of each kind is opened and all its windows are counted one by one. Repeated windows
merge into maximal intervals, which are cut out of the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolumna.llm.common import arrow_schema, as_bytes, map_batches, mixed_bits, powers, saved
from kolumna.operators.cells import quoted

SPAN, ANCHOR = 50, 8
#: Windows that a task hashes at a time; longer texts are taken in overlapping parts.
PART = 1 << 17
#: Words whose hashes a task keeps at hand.
WORDS_HELD = 1 << 17
#: A null id is later than any other.
NO_ID = (1 << 63) - 1


class WordHashes(dict):
    """Hashes of words, kept while they are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


class Rolling:
    """Rabin-Karp hashes of any run of a sequence of word hashes, in two lanes of 64 bits."""

    def __init__(self, words: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> None:
        up, self.down = factors
        self.sums = [np.zeros(len(words) + 1, dtype=np.uint64) for _ in range(2)]
        np.cumsum(words * up[: len(words)], out=self.sums[0][1:])
        np.cumsum(mixed_bits(words + np.uint64(0x9E3779B97F4A7C15)) * up[: len(words)], out=self.sums[1][1:])

    def hashes(self, begin: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
        sums = self.sums[lane]
        return mixed_bits((sums[end] - sums[begin]) * self.down[begin] + np.uint64(lane))


def pieces(words: np.ndarray, owner: np.ndarray, factors, span: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Start, number of windows, hash of the anchor and both lanes of the content of every piece; none crosses owners."""
    n = len(words)
    if n < span:
        return tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.uint64))
    rolling = Rolling(words, factors)
    at = np.arange(n - anchor + 1)
    hashes = rolling.hashes(at, at + anchor)
    low = np.uint64((1 << 24) - 1)
    least = (hashes & ~low) | at.astype(np.uint64)  # of equal hashes the leftmost
    width, reach = span - anchor + 1, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    place = (least & low).astype(np.int64)  # of the anchor of every window
    whole = owner[: n - span + 1] == owner[span - 1 :]
    change = np.ones(len(place), dtype=bool)
    change[1:] = (place[1:] != place[:-1]) | (owner[1 : len(place)] != owner[: len(place) - 1]) | (whole[1:] != whole[:-1])
    starts = np.flatnonzero(change)
    counts = np.diff(np.append(starts, len(place)))
    starts, counts = starts[whole[starts]], counts[whole[starts]]
    ends = starts + counts + span - 1
    shape = counts.astype(np.uint64)
    contents = [mixed_bits(rolling.hashes(starts, ends, lane) + shape) for lane in (0, 1)]
    return starts, counts, hashes[place[starts]], *contents


_PIECES = "id long, tag long, start int, n int, anchor long, c1 long, c2 long"


def occurrences(keyed: DataFrame, span: int, anchor: int) -> DataFrame:
    """The pieces of every row of ``keyed`` (id, tag, text)."""
    schema = arrow_schema(keyed.sparkSession, _PIECES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, known = powers(PART + span), WordHashes()
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = [text.split() for text in as_bytes(batch.column(2))]
            lengths = np.array([len(t) for t in texts])
            words = np.concatenate([known.of(t) for t in texts])
            owner, begin = np.repeat(np.arange(len(texts)), lengths), np.cumsum(lengths) - lengths
            for at in range(0, max(0, len(words) - span + 1), PART):
                part = slice(at, at + PART + span - 1)
                starts, counts, anchors, *contents = pieces(words[part], owner[part], factors, span, anchor)
                rows = owner[starts + at]
                columns = (ids[rows], tags[rows], starts + at - begin[rows], counts, *(x.view(np.int64) for x in (anchors, *contents)))
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, schema.types)], schema=schema)

    return keyed.mapInArrow(run, _PIECES)


_WINDOWS = "w1 long, w2 long, id long, c1 long, c2 long, at int"


def opened(requests: DataFrame, packed: DataFrame, span: int) -> DataFrame:
    """(w1, w2, id, c1, c2, at): the hashes of all windows of the pieces asked for; equal rows give them each."""
    wanted = requests.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "n", "c1", "c2")).alias("wanted"))
    joined = packed.join(wanted, ["id", "tag"]).select("id", "packed", "wanted")
    schema = arrow_schema(packed.sparkSession, _WINDOWS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, known = powers(PART + 2 * span), WordHashes()
        for batch in batches:
            for one, value, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = known.of(unpacked(value)[1].split())
                for piece in asked.as_py():
                    start, n = piece["start"], piece["n"]
                    rolling, at = Rolling(words[start : start + n + span - 1], factors), np.arange(n)
                    lanes = [rolling.hashes(at, at + span, lane).view(np.int64) for lane in (0, 1)]
                    columns = (*lanes, *(np.full(n, x) for x in (one, piece["c1"], piece["c2"])), at)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return joined.mapInArrow(run, _WINDOWS)


def keyed_texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, tag, has_id, text); rows with the same id and tag are equal."""
    ids, text = F.col(quoted(id_column)).cast("long"), F.coalesce(F.col(quoted(text_column)).cast("string"), F.lit(""))
    return docs.select(F.coalesce(ids, F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("tag"), ids.isNotNull().alias("has_id"), text.alias("text"))


def packed_texts(keyed: DataFrame) -> DataFrame:
    """(id, tag, packed): whole texts, compressed for the shuffle."""

    def pack(batch: pa.RecordBatch) -> dict:
        coder = zstandard.ZstdCompressor(level=1)
        flags = [b"\1" if f else b"\0" for f in batch.column(2).to_pylist()]
        return {"id": batch.column(0), "tag": batch.column(1), "packed": [f + coder.compress(t) for f, t in zip(flags, as_bytes(batch.column(3)))]}

    return map_batches(keyed, pack, "id long, tag long, packed binary")


def unpacked(value: bytes) -> tuple[bool, bytes]:
    return value[:1] == b"\1", zstandard.ZstdDecompressor().decompress(value[1:])


def without_repeats(docs: DataFrame, span: int = SPAN, anchor: int = ANCHOR, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, intervals, kept) of every row: ``kept`` are its words, joined by
    one space, without the ``intervals`` [begin, end) of words covered by windows that also start in a smaller doc_id.

    Windows never cross rows and are judged on the input. Copies within one doc_id, its repeated rows
    included, stay. A null id is larger than any other; rows without an id stay beside each other. A null text
    has no words, one of fewer than ``span`` words stays whole. An empty table gives no row; extra columns
    are ignored.
    """
    if not 1 <= anchor < span:
        raise ValueError("the anchor must be shorter than the window")
    keyed = keyed_texts(docs, id_column, text_column)
    packed = packed_texts(keyed)
    every = saved(occurrences(keyed.select("id", "tag", "text"), span, anchor), "pieces")
    # Written, so that joins shuffle both sides on their own and Spark can split a common anchor or content.
    several = (F.min("id") < F.max("id")).alias("several")
    again = saved(every.groupBy("anchor").agg(several).where("several").select("anchor"), "again")
    meeting = saved(every.join(again, "anchor"), "meeting")
    kinds = meeting.groupBy("anchor", "c1", "c2").agg(F.min(F.struct("id", "tag", "start", "n")).alias("first"), F.max("id").alias("latest"))
    kinds = saved(kinds, "kinds")
    variety = saved(kinds.groupBy("anchor").agg(F.count("*").alias("count"), (F.min("first.id") < F.max("latest")).alias("several")).where("count > 1 and several").select("anchor"), "variety")
    windows = saved(opened(kinds.join(variety, "anchor").select("first.*", "c1", "c2"), packed, span), "windows")
    counts = windows.groupBy("w1", "w2").agg(F.count("*").alias("count"), F.min("id").alias("earliest"), F.max("id").alias("latest"))
    counts = saved(counts.where("count > 1 and earliest < latest").select("w1", "w2", "earliest"), "counts")
    later = windows.join(counts, ["w1", "w2"]).where("id > earliest").select("c1", "c2", "at", F.expr("at + 1").alias("end"), F.lit(-1).cast("long").alias("floor"))
    whole = kinds.where("first.id < latest").select("c1", "c2", F.lit(0).alias("at"), F.col("first.n").alias("end"), F.col("first.id").alias("floor"))
    found = saved(whole.unionByName(merged_runs(later)), "found")
    spans = meeting.join(found, ["c1", "c2"]).where("id > floor").select("id", "tag", (F.col("start") + F.col("at")).alias("begin"), (F.col("start") + F.col("end") + (span - 1)).alias("end"))
    spans = spans.groupBy("id", "tag").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    cut = packed.join(spans, ["id", "tag"], "left").select("id", "packed", "spans")
    return map_batches(cut, _removed, "doc_id long, n_words long, n_removed long, kept_sha256 string, intervals array<struct<begin:int,end:int>>, kept binary")


def merged_runs(windows: DataFrame) -> DataFrame:
    """Neighbouring windows of one piece as one run. A piece has fewer windows than twice the span."""
    lists = windows.groupBy("c1", "c2", "floor").agg(F.array_sort(F.collect_list("at")).alias("ats"))
    starts = F.filter("ats", lambda x, i: (i == 0) | (F.get("ats", i - 1) < x - 1))
    ends = F.filter("ats", lambda x, i: (i == F.size("ats") - 1) | (F.get("ats", i + 1) > x + 1))
    runs = F.explode(F.arrays_zip(starts.alias("at"), ends.alias("last"))).alias("run")
    return lists.select("c1", "c2", "floor", runs).select("c1", "c2", F.col("run.at").alias("at"), (F.col("run.last") + 1).alias("end"), "floor")


def _removed(batch: pa.RecordBatch) -> dict:
    out: dict[str, list] = {name: [] for name in ("doc_id", "n_words", "n_removed", "kept_sha256", "intervals", "kept")}
    for one, value, spans in zip(*(column.to_pylist() for column in batch.columns)):
        has_id, text = unpacked(value)
        words, intervals = text.split(), []
        for s in sorted(spans or [], key=lambda s: (s["begin"], s["end"])):
            if intervals and s["begin"] <= intervals[-1]["end"]:
                intervals[-1]["end"] = max(intervals[-1]["end"], s["end"])
            else:
                intervals.append(s)
        bounds = [0, *(edge for s in intervals for edge in (s["begin"], s["end"])), len(words)]
        rest = b" ".join(word for b, e in zip(bounds[::2], bounds[1::2]) for word in words[b:e])
        removed = sum(s["end"] - s["begin"] for s in intervals)
        for name, x in zip(out, (one if has_id else None, len(words), removed, hashlib.sha256(rest).hexdigest(), intervals, rest)):
            out[name].append(x)
    return out


def repeats_sql(span: int = SPAN) -> str:
    """The query's columns for ``documents`` in SQL, over all windows."""
    return f"""
with texts as (
    select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents
),
words as (
    select r, doc_id, unnest(range(1, len(words) + 1)) as i, unnest(words) as word,
        unnest(list_transform(range(1, len(words) + 1), lambda k: case when k + {span - 1} <= len(words)
            then md5(array_to_string(words[k:k + {span - 1}], ' ')) end)) as h
    from texts
),
later as (
    select r, i, word, h is not null and coalesce(doc_id, {NO_ID}) > min(coalesce(doc_id, {NO_ID})) over (partition by h) as again from words
),
covered as (select r, i, word, bool_or(again) over (partition by r order by i rows between {span - 1} preceding and current row) as gone from later),
kept as (
    select r, count(*) filter (gone) as n_removed, coalesce(string_agg(word, ' ' order by i) filter (not gone), '') as rest from covered group by r
)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(rest, '')) as kept_sha256
from texts left join kept using (r)"""
