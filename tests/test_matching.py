"""Staged matching, semantic typing, evaluation and files on small fixtures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kolumna.operators import evaluation as ev
from kolumna.operators import matching as m
from kolumna.operators import reference_sets as rs
from kolumna.operators import semantics as sem
from kolumna.operators.cells import cells, value_frequencies
from kolumna.plans import profile_report
from kolumna.queries import catalog
from kolumna.sinks import files as sinks
from kolumna.sources import files, listed


def refs(spark, rows):
    return m.reference(spark.createDataFrame(rows, "t string, v string, o int"), "t", "v", "o")


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").withColumn("text", F.col("value"))


def test_staged_golden(spark):
    targets = refs(spark, [("Subject", "core subject 123 12", 1), ("Subject", "Core Subject 9,10,11", 2)])
    row = m.nearest(values(spark, "Core Subject 9,10"), targets, ["value"]).first()
    assert (row.s_type, row.target, row.distance, row.adjusted, row.stage) == ("Subject", "core subject 123 12", 0.0, 0.0, 3)
    raw = m.nearest(values(spark, "Core Subject 9,10"), targets, ["value"], stages=1).first()
    assert raw.target == "Core Subject 9,10,11" and raw.distance == pytest.approx(1 / 6) and raw.adjusted == pytest.approx(0.15)


def test_nothing_shared_takes_the_first(spark):
    targets = refs(spark, [("b", "xxxx", 1), ("a", "yyyy", 2), ("a", "zzzz", 1)])
    row = m.nearest(values(spark, "qqqq"), targets, ["value"]).first()
    assert (row.s_type, row.target, row.distance, row.adjusted) == ("a", "zzzz", 1.0, 0.9)


def test_short_equal_strings(spark):
    targets = refs(spark, [("a", "NY", 1), ("b", "LA", 1)])
    rows = {r.value: r for r in m.nearest(values(spark, "LA", "l.a."), targets, ["value"]).collect()}
    assert (rows["LA"].s_type, rows["LA"].stage) == ("b", 0)
    assert (rows["l.a."].s_type, rows["l.a."].stage) == ("b", 2)


def test_containment(spark):
    targets = refs(spark, [("a", "main street", 1), ("a", "st", 2), ("b", "MAIN", 1)])
    rows = {r.value: r for r in m.nearest_containing(values(spark, "main", "zzz", "street"), targets, ["value"]).collect()}
    assert rows["main"].target == "MAIN" and rows["main"].distance == 0
    assert "zzz" not in rows and rows["street"].target == "main street"


def test_sum_ranks_small_lists_first(spark):
    many = [("big", f"abcdef{c}", i) for i, c in enumerate("qrstuv")]
    targets = refs(spark, [*many, ("small", "zzzzzz", 1)])
    by_sum = m.best_types(values(spark, "abcdefgh"), targets, ["value"]).first()
    by_average = m.best_types(values(spark, "abcdefgh"), targets, ["value"], by="avg").first()
    assert (by_sum.s_type, by_sum.average) == ("small", 1.0)
    assert by_average.s_type == "big" and by_average.average < 0.6


def test_value_types(spark):
    targets = refs(spark, [("city", "Brooklyn", 1), ("city", "Queens", 2), ("website", "www.acme.com", 1), ("zip_code", "10001", 1)])
    rows = spark.createDataFrame(
        [("Brooklyn", "city"), ("null", "city"), (None, "city"), ("www.acme.com", "city"), ("10001", "city"), ("12", "city"), ("Brooklyn", "unknown")],
        "value string, column_type string",
    )
    found = {(r.value, r.column_type): r.s_type for r in sem.value_types(rows, targets).collect()}
    assert found == {
        ("Brooklyn", "city"): "city", ("null", "city"): "city", (None, "city"): "city", ("www.acme.com", "city"): "website",
        ("10001", "city"): "zip_code", ("12", "city"): "city", ("Brooklyn", "unknown"): "city",
    }


def test_records_and_labels(spark):
    counts = spark.createDataFrame([("d", "c", "city", 3), ("d", "c", "odd", 1)], "dataset string, column_name string, s_type string, n bigint")
    types = sem.semantic_records(counts).first().semantic_types
    assert [(t.semantic_type, t.label, t["count"]) for t in types] == [("city", None, 3), ("other", "odd", 1)]


def test_evaluation(spark):
    truth = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "a"), ("z", "only_true")], "column_name string, true_label string")
    guess = spark.createDataFrame([("x", "a"), ("y", "b"), ("w", "only_guess")], "column_name string, semantic_type string")
    rows = ev.aligned(truth, guess)
    assert {r.semantic_type: r.precision for r in ev.precision(rows).collect()} == {"a": 0.5, "b": 0.0, "only_guess": 0.0}
    assert {r.semantic_type: r.recall for r in ev.recall(rows).collect()} == {"a": 0.5, "b": 0.0, "only_true": 0.0}


def test_labels_and_pairs(spark):
    sheet = spark.createDataFrame([("d.tsv.gz", "C", "a, b,", ["x->y->3", "z->1"])], "ds_path string, col_name_ta string, col_name string, `frequent_values->counts_(top_10)` array<string>")
    rows = {(r.true_label, r.frequent_value, r["count"]) for r in rs.labelled_values(sheet).collect()}
    assert rows == {("a", "x->y", 3), ("b", "x->y", 3), ("a", "z", 1), ("b", "z", 1)}


def test_catalog_names(spark):
    lines = spark.createDataFrame([("ab-1.Col.umn.txt.gz",), ("ab-1.Col.umn.txt.gz",)], "value string")
    rows = listed.parse_catalog(lines, "/in").collect()
    assert len(rows) == 2 and tuple(rows[0]) == ("/in/ab-1.tsv.gz", "ab-1.tsv.gz", "Col.umn", "ab-1.Col.umn.txt.gz")


def test_files(spark, tmp_path):
    import gzip

    def put(name, text):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(text)

    put("one.tsv.gz", "A\ta\tb.c\n1\t2\t\n1\t3\tx\n")
    put("two.tsv.gz", "only\nv\nonly\n")
    put("datasets.tsv.gz", "no\n")
    (tmp_path / "note.txt").write_text("no")
    found = files.by_size(files.dataset_files(files.list_files(spark, str(tmp_path))))
    paths = [r.path for r in found.collect()]
    assert [p.rsplit("/", 1)[1] for p in paths] == ["two.tsv.gz", "one.tsv.gz"]
    assert files.first_files(found, 1).count() == 1 and files.shuffled(found, 1).count() == 2
    assert files.within_size(found, 10).count() == 0 and files.oversized(found, 10).count() == 2
    rows = {tuple(r) for r in files.tsv_frequencies(spark, paths).collect()}
    assert rows == {
        ("one.tsv.gz", "A0", "1", 2), ("one.tsv.gz", "a1", "2", 1), ("one.tsv.gz", "a1", "3", 1),
        ("one.tsv.gz", "b.c", "x", 1), ("one.tsv.gz", "b.c", None, 1), ("two.tsv.gz", "only", "v", 1), ("two.tsv.gz", "only", "only", 1),
    }
    assert files.within_size(found).count() == 2 and files.oversized(found).count() == 0


def test_profile_json(spark, tmp_path):
    df = spark.sql("select * from values ('a', 1, '2015-01-02'), ('b', 2, '2016-01-02') as t(name, size, day)")
    records = profile_report.column_records(value_frequencies(cells(df, "d")))
    path = str(tmp_path / "out")
    sinks.write_profile(records, path)
    sinks.write_profile(records, path)
    rows = {r.column_name: r.data_types[0] for r in spark.read.json(path).collect()}
    assert len(rows) == 3 and rows["day"].max_value == "01/02/2016, 00:00:00" and rows["name"].longest_values == ["a", "b"]


def test_no_python_workers(spark):
    for name in ["column_records", "jaccard_pairs", "nearest_target"]:
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "EvalPython" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_registry():
    assert set(catalog.SQL) <= set(catalog.QUERIES)
