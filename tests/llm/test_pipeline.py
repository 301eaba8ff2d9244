from __future__ import annotations

import os
from collections import Counter, defaultdict

from fixtures import SF_DIR, edge_rows, read
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from kolumna.llm import decontaminate, language, mixing, shards, simhash
from kolumna.llm.common import saved


def test_stages_against_plain_versions(spark):
    docs = read(spark)
    coders = language.compressors(language.fit(docs))
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = saved(stage(spark, docs, SF_DIR), name)
        steps[name] = (before, docs)
        if name != "shards":
            assert docs.columns == before.columns
    before, after = steps["language"]
    rejected = {r.doc_id for r in before.collect() if language.classify(r.text, coders)[1] < language.MIN_SCORE}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - rejected
    before, after = steps["near_copies"]
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in simhash.components(before).collect()}
    texts = Counter(r.text for r in after.collect())
    assert max(texts.values()) == 1
    before, after = steps["benchmark"]
    leaks = {r.doc_id for r in decontaminate.contaminated(before, read(spark, "benchmark")).collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - leaks
    before, after = steps["mixture"]
    assert Counter(map(tuple, before.collect())) == Counter(map(tuple, after.collect()))
    slots = {r.doc_id: r.slot for r in mixing.mixed(before).collect()}
    places = [slots[r.doc_id] for r in after.collect()]
    assert places == sorted(places)
    before, after = steps["shards"]
    assert {r.doc_id: r.shard for r in after.collect()} == {r.doc_id: r.shard for r in shards.assigned(before, corpus_pipeline.SHARD_BYTES).collect()}
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()) == Counter(r.doc_id for r in after.collect())


def test_stages_take_edge_rows(spark):
    for rows in (edge_rows(spark), edge_rows(spark).limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SF_DIR).count() <= rows.count()


def test_registered():
    names = contract.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert contract.oracle_sql().keys() <= names.keys()


def test_run_shows_the_mixture(spark, monkeypatch):
    """Rows of run() carry the slot of the mixture, and each shard is numbered by it."""
    monkeypatch.setattr(corpus_pipeline, "SHARD_BYTES", 1 << 14)
    result = corpus_pipeline.run(spark, SF_DIR)
    found = saved(result, "result").collect()
    kept = read(spark).where(F.col("doc_id").isin([r.doc_id for r in found]))
    slots = {r.doc_id: r.slot for r in mixing.mixed(kept).collect()}
    assert {r.doc_id: r.slot for r in found} == slots and len(found) == len(slots)
    shard = defaultdict(list)
    for r in found:
        shard[r.shard].append(r)
    assert len(shard) > 3 and len(set(slots.values())) > 3
    for members in shard.values():
        members.sort(key=lambda r: r.place)
        assert [r.place for r in members] == list(range(1, len(members) + 1))
        assert [r.slot for r in members] == sorted(r.slot for r in members)


def test_benchmark_stage_fits_all_documents(spark, monkeypatch):
    """The singular vectors see every different text of the stage; what the fit has written goes when it is done."""
    monkeypatch.setattr(decontaminate, "FIT_TEXTS", 5)
    seen, fit, gone, discard = [], decontaminate.latent_basis, [], decontaminate.discard
    monkeypatch.setattr(decontaminate, "latent_basis", lambda words, *rest: seen.append(words.where("scale < 1").count()) or fit(words, *rest))
    monkeypatch.setattr(decontaminate, "discard", lambda words: gone.append(words.inputFiles()) or discard(words))
    docs = read(spark).limit(40)
    corpus_pipeline.without_benchmark(spark, docs, SF_DIR).count()
    texts = {r.text for r in docs.collect() if decontaminate.words_of(r.text)}
    assert len(texts) > 20 and seen == [sum(len(t.lower().encode()) // decontaminate.PART + 1 for t in texts)]
    paths = [f.removeprefix("file:").replace("//", "/") for files in gone for f in files]
    assert len(gone) == 3 and paths and not any(os.path.exists(p) for p in paths)
