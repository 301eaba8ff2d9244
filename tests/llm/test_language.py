from __future__ import annotations

import zlib
from collections import Counter

from fixtures import SF_DIR, TEXTS, edge_rows, read

from kolumna.llm import language, queries

SF_LARGER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_LARGER}/documents.parquet").collect()}
    rows = queries.languages(spark, SF_LARGER).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0} and len(rows) == len(lang)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.02 * len(rows)


def test_by_hand(spark):
    """The dictionary with the fewest bytes wins, recomputed piece by piece."""
    dictionaries = language.fit(read(spark))
    coders = language.compressors(dictionaries)
    for r in language.predict(read(spark), dictionaries).collect():
        content = language.letters(r.text)
        sizes = {lang: sum(len(c.compress(content[i : i + 1024])) for i in range(0, len(content), 1024)) for lang, c in coders}
        assert r.lang_pred == min(sizes, key=lambda x: (sizes[x], x))


def test_labels_are_no_input(spark):
    docs = read(spark).limit(40)
    dictionaries = language.fit(read(spark))
    plain = {r.doc_id: r.lang_pred for r in language.predict(docs, dictionaries).collect()}
    other = language.predict(docs.withColumn("lang", docs.source), dictionaries).collect()
    assert plain == {r.doc_id: r.lang_pred for r in other}


def test_edges(spark):
    dictionaries = language.fit(read(spark))
    found = language.predict(edge_rows(spark), dictionaries).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(TEXTS)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in found)
    assert {language.classify(t, language.compressors(dictionaries))[0] for t in ("²½", "123 _ !", "", None)} == {"und"}
    assert all(r.rejected and r.score == 0 for r in found if r.lang_pred == "und")
    assert language.predict(edge_rows(spark).limit(0), dictionaries).collect() == []
    assert language.fit(edge_rows(spark).limit(0)) == {}
    assert {r.lang_pred for r in language.predict(edge_rows(spark), {}).collect()} == {"und"}
    assert {r.lang_pred for r in language.predict(edge_rows(spark), language.fit(edge_rows(spark))).collect()} == {"en", "und"}


def test_known(spark):
    docs = read(spark)
    kept = language.known(docs, language.fit(docs))
    assert kept.columns == docs.columns and 0.9 * docs.count() <= kept.count()
    assert language.known(edge_rows(spark), language.fit(docs)).where("text is null or trim(text) = ''").count() == 0


def test_query_dir(spark):
    assert queries.languages(spark, SF_DIR).count() == read(spark).count()
