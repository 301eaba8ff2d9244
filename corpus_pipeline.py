"""A training corpus from documents: language, near copies, benchmark leaks, mixture, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kolumna.llm import decontaminate, language, mixing, shards, simhash
from kolumna.llm.common import batched, saved, sealed, table

#: Bytes of text in a shard.
SHARD_BYTES = 1 << 20
#: Near copies: words of a shingle, and bits in which fingerprints of 64 bits may differ.
SHINGLE, BITS = 3, 3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. The dictionaries come from the documents with a language.

    Texts that are null or have no letter go; without any document with a language all go.
    """
    batched(spark)
    return language.known(docs, language.fit(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the smallest doc_id.

    Empty texts are one class; a null id comes last; of repeated rows one stays.
    """
    batched(spark)
    return simhash.one_of_each(docs, SHINGLE, BITS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Empty texts and items hold nothing."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in an order that mixes their sources by weight; every row stays, each with its place."""
    return mixing.in_order(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shards, their slot in the mixture and their place in the shard by it.

    Files read again promise no order, so that the slot, which follows from source, hash and bytes, is
    computed again. Slot, shard and place are found on numbers of rows, so that texts are shuffled once.
    Columns of that name are replaced. Every row stays; an empty table has no shard.
    """
    plain, names, opened = sealed(docs, "slot", "n_bytes", "shard", "place")
    rows = mixing.numbered(plain)
    source, ids, text = (names[c] for c in ("source", "doc_id", "text"))
    named = shards.assigned(rows.select("row", ids, text), SHARD_BYTES, ids, text).select("row", "n_bytes", "shard")
    places = mixing.slots(rows, source, ids, text).join(saved(named, "shards"), "row")
    within = Window.partitionBy("shard").orderBy("slot", "order_in_slot", "row")
    places = saved(places.withColumn("place", F.row_number().over(within)), "places")
    return opened(rows.join(places, "row"), "slot", "n_bytes", "shard", "place")


STAGES = [
    ("language", known_language),
    ("near_copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("mixture", mixed),
    ("shards", sharded),
]

#: Compression, SVD and scheduling are not SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
