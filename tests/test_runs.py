"""A profile that goes on where it ended, and reads only what has changed."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from kolumna.operators.cells import all_cells
from kolumna.plans import profile_report, profile_runs
from kolumna.sinks import files as sinks
from kolumna.sources import files


def table(spark, k, n=20):
    return spark.range(n).select(F.col("id").alias(f"id{k}"), F.concat(F.lit(f"name {k} "), F.col("id") % 7).alias("name"), (F.col("id") / (k + 2)).cast("string").alias("share"))


def folder_name(path):
    return F.regexp_extract(path, r"([^/]+)/[^/]*$", 1)


@pytest.fixture
def reads(monkeypatch):
    """Paths of all files that are read, by reading."""
    seen, original = [], files.tsv_frequencies

    def counting(spark, paths, dataset=None):
        seen.append(sorted(p.rsplit("/", 2)[1] for p in paths))
        return original(spark, paths, dataset)

    monkeypatch.setattr(files, "tsv_frequencies", counting)
    return seen


def shown(df, *dropped):
    return sorted(repr(r) for r in df.drop(*dropped).selectExpr("dataset", "column_name", "number_distinct_values", "number_non_empty_cells", "itemset", "number_untyped_cells").collect())


def expected(spark, tables):
    return shown(profile_report.run(all_cells(tables)))


def test_a_run_goes_on(spark, tmp_path, reads):
    """A run that ends after half of the datasets is finished by the next one; a third has nothing to do."""
    tables = {f"d{k}": table(spark, k, 20 + 40 * k) for k in range(4)}
    for name, df in tables.items():
        sinks.write_tsv(df.coalesce(1), str(tmp_path / "in" / name))
    here, out = str(tmp_path / "in"), str(tmp_path / "out")
    options = {"dataset": folder_name, "batch_datasets": 1}
    first = profile_runs.update(spark, here, out, max_batches=2, **options).collect()
    assert [r.dataset for r in first] == ["d0", "d1"] and reads == [["d0"], ["d1"]]
    assert shown(profile_runs.profile(spark, out)) == expected(spark, {n: tables[n] for n in ("d0", "d1")})
    second = profile_runs.update(spark, here, out, **options).collect()
    assert [r.dataset for r in second] == ["d2", "d3"] and reads[2:] == [["d2"], ["d3"]]
    assert shown(profile_runs.profile(spark, out)) == expected(spark, tables)
    assert profile_runs.update(spark, here, out, **options).collect() == [] and len(reads) == 4


def test_a_broken_batch_is_done_again(spark, tmp_path, reads, monkeypatch):
    """Records are there, the manifest is not: they are not shown, and the next run takes the dataset again."""
    tables = {f"d{k}": table(spark, k) for k in range(2)}
    for name, df in tables.items():
        sinks.write_tsv(df.coalesce(1), str(tmp_path / "in" / name))
    here, out = str(tmp_path / "in"), str(tmp_path / "out")
    original = profile_runs._overwrite

    def broken(df, path, *folders):
        if path.endswith("manifest"):
            raise OSError("lost")
        original(df, path, *folders)

    monkeypatch.setattr(profile_runs, "_overwrite", broken)
    with pytest.raises(OSError, match="lost"):
        profile_runs.update(spark, here, out, folder_name)
    assert profile_runs.manifest(spark, out).count() == 0 and profile_runs.profile(spark, out).count() == 0
    monkeypatch.setattr(profile_runs, "_overwrite", original)
    profile_runs.update(spark, here, out, folder_name)
    assert shown(profile_runs.profile(spark, out)) == expected(spark, tables)


def folders_and_times(path):
    return {(d, max(os.stat(os.path.join(path, d, f)).st_mtime_ns for f in os.listdir(os.path.join(path, d)))) for d in os.listdir(path) if "=" in d}


def test_one_changed_file(spark, tmp_path, reads):
    """Of a dataset of three files one is written anew: that file is read, that dataset's folder replaced. Files
    that come and go count as changes; a dataset without files is shown no more."""
    def path(name, k):
        return str(tmp_path / "in" / name / f"file{k}")

    def by_dataset(column):
        return F.regexp_extract(column, r"([^/]+)/[^/]+/[^/]*$", 1)

    parts = {(name, k): table(spark, 1, 10 + 10 * k) for name in ("a", "b") for k in range(3)}
    for key, df in parts.items():
        sinks.write_tsv(df.coalesce(1), path(*key))

    def answer():
        names = {n for n, _ in parts}
        rows = {n: None for n in names}
        for (n, _), df in parts.items():
            rows[n] = df if rows[n] is None else rows[n].unionByName(df)
        return expected(spark, rows)

    here, out = str(tmp_path / "in"), str(tmp_path / "out")
    profile_runs.update(spark, here, out, by_dataset)
    assert shown(profile_runs.profile(spark, out)) == answer() and len(reads[0]) == 6
    before = folders_and_times(str(tmp_path / "out" / "records"))
    parts["b", 1] = table(spark, 1, 77)
    sinks.write_tsv(parts["b", 1].coalesce(1), path("b", 1))
    (row,) = profile_runs.update(spark, here, out, by_dataset).collect()
    assert (row.dataset, row.files_read, row.files) == ("b", 1, 3) and reads[1] == ["file1"]
    changed = folders_and_times(str(tmp_path / "out" / "records")) - before
    assert {d for d, _ in changed} == {"dataset=b"} and shown(profile_runs.profile(spark, out)) == answer()
    for key in [("b", 2), ("a", 0), ("a", 1), ("a", 2)]:
        del parts[key]
        for name in os.listdir(path(*key)):
            os.remove(os.path.join(path(*key), name))
    done = {r.dataset: (r.files_read, r.files) for r in profile_runs.update(spark, here, out, by_dataset).collect()}
    assert done == {"a": (0, 0), "b": (0, 2)} and len(reads) == 2
    assert shown(profile_runs.profile(spark, out)) == answer()
