"""Long repeats: every byte covered by a string of ``SPAN`` bytes that also starts somewhere else.

A full suffix array of a corpus fits no machine, but equal strings need only meet. Every window of
``SPAN`` bytes goes by its anchor, the substring of ``ANCHOR`` bytes in it with the smallest hash: a
function of the window alone, so equal windows share it. Neighbouring windows mostly share an anchor
too and travel as one piece.

Pieces that are equal as a whole, or whose anchor occurs once, are settled by counts. Only anchors
with different pieces need texts: these are suffix-sorted in two stages (suffixes smaller than their
successor directly, all others induced by bucket scans) and adjacent common prefixes show the
repeats. An anchor with very many different pieces (a common line with ever new neighbours) is cut by
longer and longer content, in the end by whole windows, whose counts settle them.
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

from kolumna.llm.common import arrow_schema, as_bytes, map_batches, mixed_bits, powers, prefix_hashes, saved

SPAN, ANCHOR = 200, 32
#: Bytes that a task hashes or sorts at a time; longer texts are taken in overlapping parts.
PART = 1 << 19
#: An anchor with more different pieces than this is cut into cells of so many windows, keyed by what
#: all windows of a cell have in common.
PIECE_LIMIT = 1024
CELL = 32

def pieces(data: np.ndarray, owner: np.ndarray, factors, span: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Start, number of windows, place of the anchor, its hash and the content hash of every piece; none crosses owners."""
    n = len(data)
    if n < span:
        return tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    up, down = factors
    sums = prefix_hashes(data, up)
    at = np.arange(n - anchor + 1, dtype=np.uint64)
    hashes = mixed_bits((sums[anchor:] - sums[: n - anchor + 1]) * down[: n - anchor + 1])
    low = np.uint64((1 << 24) - 1)
    least = (hashes & ~low) | at  # of equal hashes the leftmost
    width, reach = span - anchor + 1, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    place = (least & low).astype(np.int64)  # of the anchor of every window
    whole = owner[: n - span + 1] == owner[span - 1 :]
    change = np.empty(len(place), dtype=bool)
    change[0] = True
    change[1:] = (place[1:] != place[:-1]) | (whole[1:] != whole[:-1]) | (owner[1 : len(place)] != owner[: len(place) - 1])
    starts = np.flatnonzero(change)
    counts = np.diff(np.append(starts, len(place)))
    keep = whole[starts]
    starts, counts = starts[keep], counts[keep]
    spots = place[starts]
    content = (sums[starts + counts + span - 1] - sums[starts]) * down[starts]
    content = mixed_bits(content + mixed_bits((spots - starts).astype(np.uint64) + np.uint64(1)) + counts.astype(np.uint64))
    return starts, counts, spots - starts, hashes[spots], content


def _parts(texts: list[bytes], span: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, offset, bytes) of texts that hold a window, bundled to about PART bytes; long texts overlap by span - 1."""
    bundle, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(0, len(text) - span + 1), PART):
            part = text[at : at + PART + span - 1]
            if size and size + len(part) > 2 * PART:
                yield bundle
                bundle, size = [], 0
            bundle.append((row, at, part))
            size += len(part)
    if bundle:
        yield bundle


def occurrences(keyed: DataFrame, span: int, anchor: int) -> DataFrame:
    """(id, tag, start, shape, anchor, content) of every piece of ``keyed`` (id, tag, text); shape: windows * 1024 + place of the anchor."""
    fields = [("id", pa.int64()), ("tag", pa.int32()), ("start", pa.int32()), ("shape", pa.int32()), ("anchor", pa.int64()), ("content", pa.int64())]
    schema = pa.schema(fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = powers(2 * PART + span + 1)
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for bundle in _parts(as_bytes(batch.column(2)), span):
                lengths = [len(p) for _, _, p in bundle]
                data = np.frombuffer(b"".join(p for _, _, p in bundle), dtype=np.uint8)
                owner = np.repeat(np.arange(len(bundle)), lengths)
                starts, counts, spots, anchors, contents = pieces(data, owner, factors, span, anchor)
                which = owner[starts]
                rows = np.array([r for r, _, _ in bundle])[which]
                shift = (np.array([o for _, o, _ in bundle]) - np.concatenate([[0], np.cumsum(lengths)[:-1]]))[which]
                columns = (ids[rows], tags[rows], starts + shift, counts * 1024 + spots, anchors.view(np.int64), contents.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, (_, kind) in zip(columns, fields)], schema=schema)

    return keyed.mapInArrow(run, "id long, tag int, start int, shape int, anchor long, content long")


def suffix_order(text: bytes, depth: int) -> np.ndarray:
    """Suffixes of ``text`` in the order of their first ``depth`` bytes, by two-stage sorting."""
    data = np.frombuffer(text, dtype=np.uint8)
    n = len(data)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    # A suffix is small if it is smaller than its successor; in a run of one byte, what follows decides.
    step = np.sign(data[1:].astype(np.int16) - data[:-1])
    ends = np.append(np.flatnonzero(step), n - 1)
    follow = ends[np.searchsorted(ends, np.arange(n))]
    small = np.append(step, -1)[follow] > 0
    chosen = np.flatnonzero(small).tolist()
    chosen.sort(key=lambda i: text[i : i + depth])
    direct = np.array(chosen, dtype=np.int64)
    bounds = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[data[-1]].append(np.array([n - 1]))  # the last suffix exceeds the empty one
    order: list[np.ndarray] = []

    def hand_out(found: np.ndarray, byte: int) -> np.ndarray:
        """Induce the predecessors of ``found``; those in this very bucket are returned."""
        before = found[found > 0] - 1
        before = before[~small[before]]
        bytes_of = data[before]
        larger = bytes_of > byte
        up, up_bytes = before[larger], bytes_of[larger]
        sort = np.argsort(up_bytes, kind="stable")
        up, up_bytes = up[sort], up_bytes[sort]
        cuts = np.flatnonzero(np.diff(up_bytes)) + 1
        for part in np.split(up, cuts):
            if len(part):
                waiting[data[part[0]]].append(part)
        return before[bytes_of == byte]

    for byte in range(256):
        wave = np.concatenate(waiting[byte]) if waiting[byte] else direct[:0]
        while len(wave):
            order.append(wave)
            wave = hand_out(wave, byte)
        own = direct[bounds[byte] : bounds[byte + 1]]
        if len(own):
            order.append(own)
            hand_out(own, byte)
    return np.concatenate(order)


def common_prefixes(text: bytes, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of every suffix in ``order`` with the next one, up to ``most`` bytes; all hold that many."""
    padded = np.frombuffer(text + bytes(8), dtype=np.uint8).astype(np.uint64)
    words = np.zeros(len(text) + 1, dtype=np.uint64)
    for k in range(8):
        words |= padded[k : k + len(words)] << np.uint64(8 * k)
    a, b = order[:-1], order[1:]
    length = np.full(len(a), most, dtype=np.int64)
    alive = np.arange(len(a))
    for at in range(0, most, 8):
        differ = words[a[alive] + at] ^ words[b[alive] + at]
        apart = np.flatnonzero(differ)
        lowest = differ[apart] & (~differ[apart] + np.uint64(1))
        length[alive[apart]] = np.minimum(most, at + (np.bitwise_count(lowest - np.uint64(1)) // 8))
        alive = alive[differ == 0]
    return length


def repeated_windows(texts: list[bytes], span: int) -> list[np.ndarray]:
    """For each text, which of its windows of ``span`` bytes occur more than once among all of them."""
    joined = b"".join(texts)
    order = suffix_order(joined, span)
    lengths = np.array([len(t) for t in texts])
    begin = np.cumsum(lengths) - lengths
    whole = np.zeros(len(joined), dtype=bool)
    for b, n in zip(begin, lengths):
        whole[b : b + max(0, n - span + 1)] = True
    order = order[whole[order]]
    again = np.zeros(len(joined), dtype=bool)
    equal = common_prefixes(joined, order, span) >= span
    again[order[:-1][equal]] = True
    again[order[1:][equal]] = True
    return [again[b : b + max(0, n - span + 1)] for b, n in zip(begin, lengths)]


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_FOUND = "anchor long, content long, begin int, end int"
_CUT = "key long, anchor long, content long, shift int, text binary"


def cut_texts(requests: DataFrame, packed: DataFrame, crowded: bool, span: int) -> DataFrame:
    """(key, anchor, content, shift, text) of the pieces asked for.

    Crowded ones come in cells of windows. A cell lies at the same distance from the anchor wherever
    its windows occur, and its key is the hash of the content that each of them holds.
    """
    wanted = requests.where(F.col("crowded") == crowded)
    wanted = wanted.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "shape", "anchor", "content")).alias("wanted"))
    joined = packed.join(wanted, ["id", "tag"]).select("packed", "wanted")
    schema = arrow_schema(packed.sparkSession, _CUT)

    def cut(text: bytes, piece: dict) -> Iterator[tuple]:
        start, (n, spot) = piece["start"], divmod(piece["shape"], 1024)
        names = piece["anchor"], piece["content"]
        if not crowded:
            yield (names[0], *names, 0, text[start : start + n + span - 1])
            return
        place = start + spot
        for cell in range((spot - n + 1) // CELL, spot // CELL + 1):
            first, last = max(0, spot - cell * CELL - CELL + 1), min(n - 1, spot - cell * CELL)
            shared = text[place - cell * CELL : place - cell * CELL - CELL + 1 + span]
            key = xxhash.xxh3_64_intdigest(shared, (names[0] + cell) % (1 << 64))
            yield (key - (1 << 63), *names, first, text[start + first : start + last + span])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, asked in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = unpacked(one)[1]
                rows = [row for piece in asked.as_py() for row in cut(text, piece)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return joined.mapInArrow(run, _CUT)


def sorted_repeats(cut: DataFrame, span: int) -> DataFrame:
    """(anchor, content, begin, end): runs of repeated windows in the texts of every key."""
    schema = arrow_schema(cut.sparkSession, _FOUND)
    cut = cut.repartition("key").sortWithinPartitions("key")

    def found(rows: list[tuple]) -> pa.RecordBatch:
        out: list[tuple] = []
        for row, flags in zip(rows, repeated_windows([r[4] for r in rows], span)):
            out += [(row[1], row[2], row[3] + begin, row[3] + end) for begin, end in _spans(flags)]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(schema.types)], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, key = 0, None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[0] != key and size > PART // 2:  # keys don't share windows: many are sorted together
                    yield found(held)
                    held, size = [], 0
                key, size = row[0], size + len(row[4])
                held.append(row)
        if held:
            yield found(held)

    return cut.mapInArrow(run, _FOUND)


def counted_repeats(cut: DataFrame, span: int) -> DataFrame:
    """The same for keys with too many texts: every window is a key of its own."""
    schema = "window long, anchor long, content long, at int"
    fields = arrow_schema(cut.sparkSession, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, anchor, content, shift, text in zip(*(column.to_pylist() for column in batch.columns)):
                keys = [xxhash.xxh3_64_intdigest(text[i : i + span]) - (1 << 63) for i in range(len(text) - span + 1)]
                columns = (keys, [anchor] * len(keys), [content] * len(keys), range(shift, shift + len(keys)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.types)], schema=fields)

    windows = cut.mapInArrow(run, schema)
    again = windows.groupBy("window").count().where("count > 1").select("window")
    return windows.join(again, "window").selectExpr("anchor", "content", "at as begin", "cast(at + 1 as int) as end")


def packed_texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, tag, packed): whole texts, compressed for the shuffle. Rows with the same id and tag are equal."""
    keyed = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(0)).alias("id"),
        F.hash(F.col(id_column).cast("long"), F.col(text_column).cast("string")).alias("tag"),
        F.col(id_column).isNotNull().alias("has_id"), F.col(text_column).cast("string").alias("text"),
    )

    def pack(batch: pa.RecordBatch) -> dict:
        coder = zstandard.ZstdCompressor(level=1)
        texts = as_bytes(batch.column(3))
        flags = [b"\1" if f else b"\0" for f in batch.column(2).to_pylist()]
        return {"id": batch.column(0), "tag": batch.column(1), "packed": [f + coder.compress(t) for f, t in zip(flags, texts)]}

    return map_batches(keyed, pack, "id long, tag int, packed binary")


def unpacked(value: bytes) -> tuple[bool, bytes]:
    return value[:1] == b"\1", zstandard.ZstdDecompressor().decompress(value[1:])


def without_repeats(docs: DataFrame, span: int = SPAN, anchor: int = ANCHOR, piece_limit: int = PIECE_LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row: ``kept`` are its bytes outside
    of all strings of ``span`` bytes that start at more than one place of the corpus.

    Matches never cross rows. Repeated rows repeat each other, whatever their ids; a null text is
    empty and a text below ``span`` bytes stays whole; a null id stays null. An empty table gives no
    row. Extra columns are ignored.
    """
    if not 8 <= anchor <= span - CELL or span > 1000:
        raise ValueError("the anchor must lie in all windows of a cell, and a window in 1000 bytes")
    packed = packed_texts(docs, id_column, text_column)
    keyed = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(0)).alias("id"),
        F.hash(F.col(id_column).cast("long"), F.col(text_column).cast("string")).alias("tag"), F.col(text_column).cast("string").alias("text"),
    )
    every = occurrences(keyed, span, anchor)
    # Written, so that the join shuffles both sides on their own and Spark can split a common anchor.
    again = saved(every.groupBy("anchor").count().where("count > 1").select("anchor"), "again")
    meeting = saved(every.join(again, "anchor"), "meeting")
    kinds = saved(
        meeting.groupBy("anchor", "content").agg(F.count("*").alias("copies"), F.min(F.struct("id", "tag", "start", "shape")).alias("first")), "kinds"
    )
    variety = saved(kinds.groupBy("anchor").count().where("count > 1"), "variety")
    requests = kinds.join(variety, "anchor").select("anchor", "content", "first.*", (F.col("count") > piece_limit).alias("crowded"))
    whole = kinds.where("copies > 1").selectExpr("anchor", "content", "0 as begin", "cast(first.shape div 1024 as int) as end")
    found = whole.unionByName(sorted_repeats(cut_texts(requests, packed, False, span), span))
    if not variety.where(F.col("count") > piece_limit).isEmpty():
        cells = cut_texts(requests, packed, True, span)
        cells = cells.join(cells.groupBy("key").count().where("count > 1").withColumnRenamed("count", "n"), "key")
        few = cells.where(F.col("n") <= piece_limit).drop("n")
        many = cells.where(F.col("n") > piece_limit).drop("n")
        found = found.unionByName(sorted_repeats(few, span)).unionByName(counted_repeats(many, span))
    spans = meeting.join(found, ["anchor", "content"]).select(
        "id", "tag", (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("end") + (span - 1)).alias("end")
    )
    spans = spans.groupBy("id", "tag").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    return map_batches(packed.join(spans, ["id", "tag"], "left").select("id", "packed", "spans"), _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def _removed(batch: pa.RecordBatch) -> dict:
    out: dict[str, list] = {name: [] for name in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
    for one, value, spans in zip(*(column.to_pylist() for column in batch.columns)):
        has_id, text = unpacked(value)
        kept, at, runs, removed = [], 0, 0, 0
        reach = -1  # end of the run so far; runs that touch are one
        for s in sorted(spans or [], key=lambda s: (s["begin"], s["end"])):
            if s["begin"] > reach:
                kept.append(text[at : s["begin"]])
                runs += 1
                at = s["begin"]
            if s["end"] > at:
                removed += s["end"] - at
                at = reach = s["end"]
        kept.append(text[at:])
        rest = b"".join(kept)
        for name, x in zip(out, (one if has_id else None, len(text), removed, runs, hashlib.sha256(rest).hexdigest(), rest)):
            out[name].append(x)
    return out


def repeats_sql(span: int = SPAN) -> str:
    """The query's columns for ``documents`` in SQL, over all windows of hexadecimal text."""
    return f"""
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
windows as (
    select doc_id, unnest(range(0, length(x) // 2 - {span - 1})) as i,
        unnest(list_transform(range(0, length(x) // 2 - {span - 1}), lambda k: md5_number(substr(x, 2 * k + 1, {2 * span})))) as w
    from texts where length(x) >= {2 * span}
),
again as (select doc_id, i from windows qualify count(*) over (partition by w) > 1),
fresh as (select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= {span} then 0 else 1 end as first from again),
numbered as (select doc_id, i, sum(first) over (partition by doc_id order by i) as run from fresh),
runs as (select doc_id, run, min(i) as b, max(i) + {span} as e from numbered group by doc_id, run),
gaps as (
    select doc_id, coalesce(lag(e) over (partition by doc_id order by b), 0) as s, b as e from runs
    union all select doc_id, max(e), max(e) + (1 << 30) from runs group by doc_id
),
kept as (select doc_id, string_agg(substr(x, 2 * s + 1, 2 * (e - s)), '' order by s) as rest from gaps join texts using (doc_id) group by doc_id),
sums as (select doc_id, sum(e - b) as removed, count(*) as runs from runs group by doc_id)
select doc_id, length(x) // 2 as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed, coalesce(runs, 0) as n_spans,
    sha256(unhex(coalesce(rest, x))) as kept_sha256
from texts left join kept using (doc_id) left join sums using (doc_id)"""
