"""Many datasets in few scans: Parquet files grouped by schema, JSON records through variants."""

from __future__ import annotations

import json
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from kolumna.operators.cells import all_cells, cells, value_frequencies
from kolumna.sources import tables


def folder_name(path):
    return F.regexp_extract(path, r"([^/]+)/[^/]*$", 1)


def test_two_thousand_datasets(spark, tmp_path):
    """2,000 datasets of 20 schemas: at most 20 scans in the plan, the cells of each dataset are its own."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    answer, paths = Counter(), []
    for d in range(2000):
        k = d % 20
        names = [f"c{k}", "shared", *(["a.b"] if k % 3 == 0 else []), *([f"Extra {k}"] if k % 2 else [])]
        rows = {n: [None if (d + i) % 5 == 0 else (d * 10 + i if j % 2 == 0 else f"t{i}") for i in range(3)] for j, n in enumerate(names)}
        path = tmp_path / f"d{d}"
        path.mkdir()
        pq.write_table(pa.table(rows), path / "part.parquet")
        paths.append(str(path / "part.parquet"))
        for name, values in rows.items():
            answer.update((f"d{d}", name, None if v is None else str(v)) for v in values)
    found = tables.file_cells(spark, paths, folder_name)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) <= 20
    counted = {(r.dataset, r.column_name, r.value): r.n for r in value_frequencies(found).collect()}
    assert counted == dict(answer)


def test_types_and_names(spark, tmp_path):
    """The cells of files are those of the tables, for all types; names differ in case and hold dots."""
    spark.sql("""select 1 as a, 2.5D as `b.c`, timestamp'2015-01-02 03:04:05' as `d e`, true as F, cast(null as int) as g""").write.parquet(str(tmp_path / "one"))
    spark.sql("""select 'x' as a, date'2015-01-02' as `B.C`, array(1, 2) as `d``e`, cast(1.10 as decimal(5, 2)) as f""").write.parquet(str(tmp_path / "two"))
    names = {n: spark.read.parquet(str(tmp_path / n)) for n in ("one", "two")}
    paths = [p for df in names.values() for p in df.inputFiles()]
    found = tables.file_cells(spark, paths, folder_name)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, all_cells(names).collect()))
    assert tables.file_cells(spark, []).collect() == []


def test_json_records(spark, tmp_path):
    """Records of any fields against a plain count; one scan of all files."""
    rng = random.Random(2)
    kinds = [None, 1, 2.5, True, "text", "é\n\"", [1, {"q": 2}], {"n": None, "m": "z"}]
    answer = {}
    for d in range(12):
        rows = [{rng.choice("abcdef"): rng.choice(kinds) for _ in range(rng.randint(0, 5))} for _ in range(rng.randint(1, 30))]
        folder = tmp_path / f"d{d}"
        folder.mkdir()
        lines = [json.dumps(r) for r in rows] + (["[1, 2]", "3", "no json"] if d % 2 else [])
        for k in range(2):
            (folder / f"part{k}.json").write_text("\n".join(lines[k::2]) + "\n")
        for name in {n for r in rows for n in r}:
            values = Counter()
            for r in rows:
                v = r.get(name)
                values[v if v is None or isinstance(v, str) else json.dumps(v, separators=(",", ":"), sort_keys=True)] += 1
            values[None] += len(lines) - len(rows)
            answer.update({(f"d{d}", name, v): n for v, n in values.items() if n})
    found = tables.record_frequencies(spark, [str(tmp_path / f"d{d}") for d in range(12)], folder_name)
    assert {(r.dataset, r.column_name, r.value): r.n for r in found.collect()} == answer


def test_json_of_a_table(spark, tmp_path):
    rows = spark.range(50).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("v "), F.col("id") % 4)).alias("v"))
    rows.write.json(str(tmp_path / "d"))
    found = tables.record_frequencies(spark, [str(tmp_path / "d")], folder_name)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, value_frequencies(cells(rows, "d")).collect()))
