"""Files keep what is written, read no more than they must, and intermediate tables go."""

from __future__ import annotations

import os
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from kolumna import session
from kolumna.functions import value_types as vt
from kolumna.operators import reference_sets as rs
from kolumna.operators.cells import all_cells, cells, listed_columns, value_frequencies
from kolumna.plans import figures, profile_report
from kolumna.queries import catalog
from kolumna.queries.data import dataset
from kolumna.sinks import files as sinks
from kolumna.sources import files, listed

SF_DIR = "/root/testdata/sf0.001"
ODD = ['say "hi" now', '"', '""', "two\nlines", "tab\there", "  lead", "trail  ", " ", "a,b", "back\\slash", "\\", "é☃", "#x", "'", "carriage\rreturn"]


def test_tsv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(i, v, None if i % 2 else "z") for i, v in enumerate(ODD)], "i int, v string, w string")
    sinks.write_tsv(rows.coalesce(1), str(tmp_path / "d"))
    paths = [r.path for r in files.dataset_files(files.list_files(spark, str(tmp_path / "d"))).collect()]
    found = {(r.column_name, r.value, r.n) for r in files.tsv_frequencies(spark, paths).collect()}
    expected = {(r.column_name, r.value, r.n) for r in value_frequencies(cells(rows, "d")).collect()}
    assert found == expected
    assert sorted(r.v for r in files.read_tsv(spark, str(tmp_path / "d")).collect()) == sorted(ODD)


def test_csv_round_trip(spark, tmp_path):
    name = "frequent_values->counts_(top_10)"
    rows = spark.createDataFrame([(v, "c", "a, b", [f"{v}->3", f" {v} ->1"]) for v in ODD], f"ds_path string, col_name_ta string, col_name string, `{name}` array<string>")
    sinks.write_csv(rows, str(tmp_path / "sheet"))
    back = listed.read_sheet(spark, str(tmp_path / "sheet"))
    assert sorted(map(tuple, rs.labelled_values(back).collect())) == sorted(map(tuple, rs.labelled_values(rows).collect()))
    assert rs.unread_lists(back).count() == 0


def test_wide_table(spark, tmp_path):
    wide = spark.range(3).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(400)])
    sinks.write_tsv(wide, str(tmp_path / "wide"))
    paths = [r.path for r in files.dataset_files(files.list_files(spark, str(tmp_path))).collect()]
    found = files.tsv_frequencies(spark, paths, F.lit("wide"))
    assert found.select("column_name").distinct().count() == 400 and found.agg(F.sum("n")).first()[0] == 1200


def test_large_files_are_reported(spark, tmp_path):
    for i, n in enumerate((10, 5000)):
        sinks.write_tsv(spark.range(n).withColumn("x", F.rand(1)).coalesce(1), str(tmp_path / f"f{i}"))
    found = files.dataset_files(files.list_files(spark, str(tmp_path)))
    kept, left = files.within_size(found, 2000), files.oversized(found, 2000)
    assert kept.count() == left.count() == 1 and kept.union(left).count() == found.count()
    assert files.within_size(found).count() == 2 and files.first_files(found, 1).count() == 1
    assert {r.path for r in files.shuffled(found, 3).collect()} == {r.path for r in found.collect()}


def test_shuffled_order(spark):
    """The order depends on the seed and the paths, not on partitions; each path comes once."""
    rows = spark.createDataFrame([(f"/in/{i}.tsv.gz", i) for i in range(40)], "path string, length long")
    order = lambda df, seed: [r.path for r in files.shuffled(df, seed).collect()]
    first = order(rows, 3)
    assert first == order(rows.repartition(7), 3) == order(rows.coalesce(1), 3)
    assert first != order(rows, 4) and first != [r.path for r in files.by_size(rows).collect()]
    assert sorted(first) == sorted(r.path for r in rows.collect())


def test_lists_as_people_write_them(spark):
    name = "frequent_values->counts_(top_10)"
    texts = ['["a->1"]', "['b->2', 'c->3']", r"['caf\xe9->4']", "['d->5', None]", "no list", None, "[]"]
    sheet = spark.createDataFrame([(str(i), "c", "L", t) for i, t in enumerate(texts)], f"ds_path string, col_name_ta string, col_name string, `{name}` string")
    found = {(r.ds_path, r.frequent_value, r["count"]) for r in rs.labelled_values(sheet).collect()}
    assert found == {("0", "a", 1), ("1", "b", 2), ("1", "c", 3), ("2", "café", 4), ("3", "d", 5), ("3", None, None), ("4", None, None), ("5", None, None), ("6", None, None)}
    assert [r.ds_path for r in rs.unread_lists(sheet).collect()] == ["4"]
    assert {r.frequent_value for r in rs.reference_set(rs.labelled_values(sheet), "frequent_value").collect()} == {"a", "b", "c", "café", "d"}
    assert rs.reference_set(rs.labelled_values(sheet), "col_name_ta").first()["count"] == 15


def scans(df):
    return re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().toString())


def test_only_listed_columns_are_read(spark):
    assert scans(catalog.QUERIES["one_column"](spark, SF_DIR)) == ["c_mktsegment:string"]
    tables = {name: dataset(spark, SF_DIR, name) for name in ("documents", "customer")}
    wanted = spark.createDataFrame([("documents", "lang"), ("customer", "c_name"), ("documents", "source")], "dataset string, column_name string")
    rows = all_cells(tables, listed_columns(wanted))
    assert sorted(scans(rows)) == ["c_name:string", "lang:string,source:string"]
    assert {tuple(r) for r in rows.select("dataset", "column_name").distinct().collect()} == {tuple(r) for r in wanted.collect()}
    plan = catalog.QUERIES["label_sample"](spark, SF_DIR)
    assert not [s for s in scans(plan) if "text:" in s or "p_partkey" in s]


def test_a_profile_reads_its_source_once(spark):
    """The records are computed from the written frequencies; the source is not in their plan."""
    rows = all_cells({"nation": dataset(spark, SF_DIR, "nation")})
    text = profile_report.run(rows)._jdf.queryExecution().executedPlan().toString()
    assert "nation.parquet" not in text and "frequencies" in text


def test_untyped_cells_are_counted(spark):
    rows = spark.createDataFrame([("1849-01-01",), ("2015-01-02",), ("no date",), (None,)], "some_date string")
    record = profile_report.column_records(value_frequencies(cells(rows, "d"))).first()
    assert record.number_untyped_cells == 2 and record.number_non_empty_cells == 3


DATES = {
    "03/04/15": "2015-03-04 00:00:00", "4-Mar-15": "2015-03-04 00:00:00", "04-MAR-2015": "2015-03-04 00:00:00", "2015-03": "2015-03-01 00:00:00",
    "2015.03.04": "2015-03-04 00:00:00", "Mar 4, 2015 10:00 AM": "2015-03-04 10:00:00", "March 4, 2015 10:05 pm": "2015-03-04 22:05:00",
    "25/12/2015": "2015-12-25 00:00:00", "12/25/98": "1998-12-25 00:00:00", "4 Mar 85": "1985-03-04 00:00:00", "2015-03-04T05:06:07": "2015-03-04 05:06:07",
    "03/04/2015 1:02:03 PM": "2015-03-04 13:02:03", "Mar-2015": "2015-03-01 00:00:00", "13/13/2015": None, "none": None, "2015-13": None, "": None,
}


def test_date_shapes(spark):
    rows = spark.createDataFrame(list(DATES.items()), "text string, expected string").withColumn("found", vt.date(F.col("text")).cast("string"))
    assert {r.text: r.found for r in rows.collect()} == DATES


def test_written_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_written", {})
    df = session.written(spark.range(5), "test")
    assert df.count() == 5
    (path,) = session.remove_written(spark)
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:")) and session.remove_written(spark) == []


@pytest.mark.parametrize("master, fails", [("spark://host:7077", True), ("yarn", True), ("local-cluster[2,1,1024]", True), ("local[4]", False), ("local", False)])
def test_a_cluster_needs_a_shared_folder(master, fails):
    settings = {"spark.master": master}
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: settings.get(k, d)), sparkContext=SimpleNamespace(applicationId="fake"))
    if fails:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.scratch_folder(fake, "x")
    else:
        assert "kolumna-x-" in session.scratch_folder(fake, "x")
    settings["spark.checkpoint.dir"] = "hdfs://shared/folder"
    assert session.scratch_folder(fake, "x").startswith("hdfs://shared/folder/kolumna-x-")


def test_figures_of_one_reading(spark, tmp_path):
    """Cells, files and sheets are counted while they are read; nothing in the results reads the source again."""
    rows = spark.createDataFrame([("1849-01-01", "a"), ("2015-01-02", None), ("no date", "a"), (None, "b")], "some_date string, name string")
    rows.write.parquet(str(tmp_path / "source"))
    records, found = figures.profile(cells(spark.read.parquet(str(tmp_path / "source")), "d"))
    assert {r.figure: r.value for r in found.collect()} == {"cells": 8, "null_cells": 2, "different_values": 5, "columns": 2, "untyped_cells": 2}
    assert "source" not in records._jdf.queryExecution().executedPlan().toString() and records.count() == 2
    listing = spark.createDataFrame([("a", 5), ("b", 50), ("c", 500)], "path string, length long")
    kept, found = figures.chosen_files(listing, 100)
    assert [r.path for r in kept.orderBy("path").collect()] == ["a", "b"]
    assert {r.figure: r.value for r in found.collect()} == {"files": 3, "bytes": 555, "files_left_out": 1, "bytes_left_out": 500}
    assert {r.figure: r.value for r in figures.chosen_files(listing)[1].collect()}["files_left_out"] == 0
    name = "frequent_values->counts_(top_10)"
    sheet = spark.createDataFrame([(str(i), "c", "L", t) for i, t in enumerate(['["a->1"]', "no list", None])], f"ds_path string, col_name_ta string, col_name string, `{name}` string")
    values, found = figures.labelled_values(sheet)
    assert {r.figure: r.value for r in found.collect()} == {"sheet_rows": 3, "unread_lists": 1} and values.count() == 3
