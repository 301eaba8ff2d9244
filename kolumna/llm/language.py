"""Language by compression: the dictionary that makes a text smallest names its language."""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kolumna.llm.common import sealed

#: The fit reads at most this many texts of a language, at most this many characters of each, and
#: stops at this many bytes of dictionary. Prediction reads whole texts.
FIT_TEXTS, FIT_CHARS, DICTIONARY_BYTES = 64, 4096, 16384
#: One dictionary each is sent to every task; more languages are an error.
MAX_LANGUAGES = 1000
#: A text is encoded in pieces of this size, so that a long one cannot become its own dictionary.
PIECE_BYTES = 1024
#: A score (share of bytes saved against the next best language) below it is rejected.
MIN_SCORE = 0.005
LEVEL = 12
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """Lower-case words of letters only, one blank between them."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode()


def fit(labelled: DataFrame, lang_column: str = "lang", text_column: str = "text") -> dict[str, bytes]:
    """One raw-content dictionary for each language of ``labelled``, from a bounded sample of its rows.

    The sample holds the texts with the smallest hashes, repeated texts once. Rows with a null
    language or a text without letters teach nothing.
    """
    rows = labelled.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    keys = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    # Hashes are even, so the smallest ones lie below a bound that follows from their number: a
    # common language does not send its candidates from every task.
    counts = keys.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    bounds = [F.lit(x) for r in counts for x in (r.lang, -(2.0**63) + 2.0**64 * min(1.0, 8.0 * FIT_TEXTS / r["count"]))]
    if bounds:
        keys = keys.where(F.col("h").cast("double") <= F.create_map(*bounds)[F.col("lang")])
    by_hash = Window.partitionBy("lang").orderBy("h")
    keys = keys.withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= FIT_TEXTS).select("lang", "h")
    wanted = [(r.lang, r.h) for r in keys.collect()]  # FIT_TEXTS hashes for each language
    hashes = sorted({h for _, h in wanted})
    texts = rows.where(F.xxhash64("text").isin(hashes)).select("lang", F.xxhash64("text").alias("h"), F.left("text", F.lit(FIT_CHARS)).alias("text"))
    sample = {(r.lang, r.h): r.text for r in texts.dropDuplicates(["lang", "h"]).collect()}
    found: dict[str, bytes] = {}
    for lang, h in sorted(wanted, key=lambda x: (x[0], x[1])):
        piece = letters(sample[lang, h])
        held = found.get(lang, b"")
        if len(held) < DICTIONARY_BYTES:
            found[lang] = held + piece[: DICTIONARY_BYTES - len(held)] + b"\n"
    return found


def compressors(dictionaries: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    made = []
    for lang in sorted(dictionaries):
        content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        made.append((lang, zstandard.ZstdCompressor(dict_data=content, write_content_size=False)))
    return made


def classify(text: str | None, coders: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float]:
    """The language with the fewest bytes and the share it saves against the next; ties go to the first name."""
    if not coders or not any(map(str.isalpha, text or "")):
        return UNKNOWN, 0.0
    content = letters(text)
    pieces = [content[i : i + PIECE_BYTES] for i in range(0, len(content), PIECE_BYTES)]
    sizes = [(sum(len(coder.compress(p)) for p in pieces), lang) for lang, coder in coders]
    sizes.sort()
    return sizes[0][1], 1.0 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0


def predict(docs: DataFrame, dictionaries: dict[str, bytes], text_column: str = "text", pred: str = "lang_pred", score: str = "score", rejected: str = "rejected") -> DataFrame:
    """``docs`` with predicted language, score (0 to 1) and ``rejected``.

    A null text or one without a letter is ``und`` with score 0 and rejected. Repeated rows get the
    same answer; an empty table stays empty; columns of ``docs`` with a result's name are replaced.
    Without any learned language all is ``und``.
    """
    docs, names, opened = sealed(docs, pred, score, rejected)
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"`{pred}` string, `{score}` double, `{rejected}` boolean").fields])
    at = docs.columns.index(names[text_column])

    def run(batches):
        coders = compressors(dictionaries)
        for batch in batches:
            answers = [classify(t, coders) for t in batch.column(at).to_pylist()]
            extra = [
                pa.array([a[0] for a in answers], pa.string()),
                pa.array([a[1] for a in answers], pa.float64()),
                pa.array([a[0] == UNKNOWN or a[1] < MIN_SCORE for a in answers], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, pred, score, rejected])

    return opened(docs.mapInArrow(run, schema), pred, score, rejected)


def known(docs: DataFrame, dictionaries: dict[str, bytes], text_column: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is rejected: null texts, texts without a letter and those
    whose two best languages are close. Repeated rows go or stay together; an empty table stays empty."""
    plain, names, opened = sealed(docs)
    return opened(predict(plain, dictionaries, names[text_column]).where("not rejected"))
