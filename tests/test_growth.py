"""What grows with the input must not meet in one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kolumna.operators import evaluation as ev
from kolumna.operators import overlap
from kolumna.plans import profile_report
from kolumna.queries import profiling, storage
from kolumna.sources import files


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    old = {}

    def use(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            old.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, str(value))

    yield use
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plain_files_are_written_by_many_tasks(spark, tmp_path, conf, monkeypatch):
    """a table of several parts was written by one task."""
    parts = [spark.createDataFrame([(i, f"n{i}\nx", 7) for i in range(100)], "s_suppkey int, s_name string, s_nationkey int")]
    monkeypatch.setattr(storage, "PLAIN", ("supplier",))
    monkeypatch.setattr(storage, "dataset", lambda *_: parts[0].repartition(4, "s_suppkey"))
    monkeypatch.setattr(storage, "scratch_folder", lambda *_: str(tmp_path / "plain"))
    found = {(r.column_name, r.value): r.n for r in storage.split_frequencies(spark, None).collect()}
    assert len(list((tmp_path / "plain" / "supplier").glob("*.csv"))) == 4
    assert found[("s_nationkey", "7")] == 100 and found[("s_name", "n5\nx")] == 1 and len(found) == 201


def test_values_of_files_are_not_sorted(spark, tmp_path, conf):
    """values were sorted to be counted, and met by file and column to be named."""
    path = tmp_path / "d.tsv"
    path.write_text('\n\n"a\nb"\tc\tc\t\n1\t2\tc\t\n\n"a\nb"\t2\t\tx\n')
    conf(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1)
    df = files.tsv_frequencies(spark, [str(path)], F.lit("d"))
    assert "SortAggregate" not in plan(df) and "BroadcastHashJoin [file" in plan(df)
    found = sorted(((r.column_name, r.value or "", r.n) for r in df.collect()))
    assert found == [("_c3", "", 1), ("_c3", "x", 1), ("a\nb", "1", 1), ("a\nb", "a\nb", 1), ("c1", "2", 2), ("c2", "", 1), ("c2", "c", 1)]


def test_values_are_typed_once(spark, tmp_path):
    """each aggregate counted and typed all values again."""
    cells = spark.createDataFrame([("d", "c", v) for v in ("b", "1", "2.5", None, "b")], "dataset string, column_name string, value string")
    text = plan(profile_report.run(cells))
    assert "typed-frequencies" in text and "rlike" not in text.lower() and "-?[0-9]" not in text and "try_cast" not in text.lower()
    record = profile_report.run(cells).first()
    assert (record.itemset, record.number_distinct_values, record.number_empty_cells) == ("-REAL--INTEGER--TEXT-", 3, 1)
    assert "typed-frequencies" in plan(profiling.QUERIES["text_stats"](spark, "/root/testdata/sf0.001"))


def test_itemsets_type_each_value_once(spark):
    """every cell was typed, also those of a value that occurs a thousand times."""
    text = plan(profiling.QUERIES["dataset_itemsets"](spark, "/root/testdata/sf0.001"))
    assert text.count("keys=[dataset") and "value" in "".join(line for line in text.splitlines() if "HashAggregate(keys=[dataset" in line and "value" in line)


def test_labels_are_aligned_in_parts(spark, conf, monkeypatch):
    """F16, F17, F18: partitions were merged by their compressed bytes, without regard to a task's memory."""
    monkeypatch.setattr(overlap, "ROWS_OF_PART", 10)
    rows = [(f"c{i}", "x") for i in range(200)] + [("c0", "x"), (None, "x"), ("t", "y")]
    a = spark.createDataFrame(rows, "column_name string, true_label string")
    b = spark.createDataFrame([*rows[:200], ("p", "z"), (None, "z")], "column_name string, semantic_type string")
    df = ev.aligned(a, b)
    assert df.rdd.getNumPartitions() == 41
    found = {tuple(r) for r in df.collect()}
    assert len(found) == 204 and ("c0", "x", "x", 2) in found and {("t", "y", None, 1), ("p", None, "z", 1), (None, "x", None, 1), (None, None, "z", 1)} <= found


def test_tokens_of_one_table_get_no_rows(spark):
    """all tokens of a prefix were shuffled, also those that the other table does not have."""
    left = spark.createDataFrame([(i, list(range(i * 1000 + 10, i * 1000 + 50)) + [7]) for i in range(3)], "id long, tokens array<long>")
    right = spark.createDataFrame([(9, [7, -5])], "id long, tokens array<long>")
    levels = overlap.rarity([left, right], 1 << 14)
    rows = overlap._prefixes(left, levels, lambda n: F.lit(1), 1 << 14).where("token is not null").collect()
    assert sorted(r.id for r in rows) == [0, 1, 2]
    few = overlap.token_candidates([left, right], lambda a, b: F.lit(1), lambda n: F.lit(1), 1 << 14)
    assert sorted(map(tuple, few.collect())) == [(0, 9), (1, 9), (2, 9)]
