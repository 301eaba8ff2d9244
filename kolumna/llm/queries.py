"""One query for each operator, over its whole table; SQL where DuckDB can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kolumna.llm import (
    credentials,
    decontaminate,
    filter_audit,
    hard_negatives,
    language,
    main_text,
    mixing,
    quality,
    repeats,
    shards,
    simhash,
    surrogates,
    word_repeats,
)
from kolumna.llm.common import table

#: One of so many parts of the labelled rows is held out.
FOLDS = 5
#: Bytes of text in a shard.
SHARD_BYTES = 1 << 20
#: A key for the given tables; real ones come from a secret store.
SURROGATE_KEY = "key of the test tables"


def long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shards.assigned(docs, SHARD_BYTES).select("doc_id", "n_bytes", "shard")


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixed(docs, frame=mixing.FRAME).select("doc_id", "source", "block", "release", "deadline", "slot")


def exact_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixed(docs).select("doc_id", "source", "block", "release", "deadline", "slot")


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.find(table(spark, sf_dir, "documents"))


def simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def quality_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False)).alias("held_out")
    )
    dictionaries = language.fit(docs.where("not held_out"))
    return language.predict(docs.select("doc_id", "text", "held_out"), dictionaries).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract(pages, main_text.fit(pages)).select("page_id", "url", "text", "n_chars")


def benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def filter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"))


def repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_repeats.without_repeats(table(spark, sf_dir, "documents")).drop("intervals", "kept")


QUERIES = {
    "op1_long_repeats": long_repeats,
    "op2_byte_shards": byte_shards,
    "op3_secret_spans": secret_spans,
    "op4_simhash_components": simhash_components,
    "op5_quality_verdicts": quality_verdicts,
    "op6_benchmark_matches": benchmark_matches,
    "op7_mixture": mixture,
    "op7_exact_mixture": exact_mixture,
    "op8_languages": languages,
    "op9_private_data": private_data,
    "op10_main_texts": main_texts,
    "op11_filter_orders": filter_orders,
    "op12_hard_negatives": mined_negatives,
    "op13_word_repeats": repeated_windows,
}

SQL = {
    "op1_long_repeats": repeats.repeats_sql(),
    "op2_byte_shards": shards.shard_sql(SHARD_BYTES),
    "op3_secret_spans": credentials.spans_sql(),
    "op5_quality_verdicts": quality.verdict_sql(),
    "op7_mixture": mixing.mixture_sql(),
    "op11_filter_orders": filter_audit.audit_sql(),
    "op12_hard_negatives": hard_negatives.negatives_sql(),
    "op13_word_repeats": word_repeats.repeats_sql(),
}
