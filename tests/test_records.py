"""Quoted files read by many tasks give the cells that one reader of the whole file gives."""

from __future__ import annotations

import gzip
import random

import pytest
from pyspark.sql import functions as F

from kolumna.operators.cells import cells, value_frequencies
from kolumna.queries.data import dataset
from kolumna.sinks import files as sinks
from kolumna.sources import files
from kolumna.sources import records as sources
from kolumna.sources.records import end_state, records

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def split_bytes(spark, monkeypatch):
    """Sets the size of the splits in which files are read as lines."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    old = {name: spark.conf.get(name, None) for name in names}
    original, sizes, blocks = sources.lines, [1 << 20], []

    def lines(*args):
        for name, value in zip(names, (sizes[-1], 0, 1)):
            spark.conf.set(name, str(value))
        try:
            found = original(*args)
        finally:
            for name, value in old.items():
                spark.conf.unset(name) if value is None else spark.conf.set(name, value)
        blocks.append(found.select("file", "block").distinct().count())
        return found

    def use(n):
        sizes.append(n)
        return blocks

    monkeypatch.setattr(sources, "lines", lines)
    return use


def quoted(cell):
    return '"' + cell.replace('"', '""') + '"' if any(c in cell for c in '"\t\n') else cell


def random_rows(rng, n, width):
    letters = ['"', "\t", "\n", "a", "b", " ", "é", '""', "\n\n", '"\n', "\n\"", "long word", "\r"]
    return [["".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(width)] for _ in range(n)]


def whole_file(spark, path, width):
    """The cells of a file by the reader that takes it whole."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    return sorted(map(repr, (list(r) for r in spark.read.csv(path, sep="\t", header=False, schema=schema, **files.READ_OPTIONS).collect())))


def by_lines(spark, path, width):
    found = files.cells_of_records(records(spark, [path])).collect()
    return sorted(repr(r.cells[:width] + [None] * (width - len(r.cells))) for r in found)


@pytest.mark.parametrize("seed", range(2))
def test_breaks_across_every_border(spark, tmp_path, split_bytes, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 8, 3)
    path = str(tmp_path / "odd.tsv")
    with open(path, "w", newline="") as f:
        f.write("\n".join("\t".join(map(quoted, row)) for row in rows) + rng.choice(["", "\n"]))
    answer = sorted(map(repr, rows))
    assert whole_file(spark, path, 3) == answer
    for size in (3, 17, 1 << 20):
        blocks = split_bytes(size)
        assert by_lines(spark, path, 3) == answer, size
        assert (blocks[-1] > 3) == (size < 100)


def test_odd_quotes(spark, tmp_path, split_bytes):
    """Quotes that a careful writer would not leave: within cells, after closing ones, never closed."""
    texts = ['a\t5" pipe\tb\nc\t"d\ne"\tf\n', 'a\tb"c"d\t"e"\n"x""y"\t""\t"""z"""\n', 'a"\n"b\tc"\n', "\n\na\tb\n\n\nc\n", 'one\ttwo\n1\t"never\nclosed\n2',
             '"\n"\t"\n"\n"\n\n\n"\n', "only", "", '""\n""\n', 'x\t" y "\t z \n', '\t\t\n\t"\t"\t\n']
    paths = []
    for i, text in enumerate(texts):
        paths.append(str(tmp_path / f"{i}.tsv"))
        with open(paths[-1], "w", newline="") as f:
            f.write(text)
    for size in (3, 1 << 20):
        split_bytes(size)
        found = files.cells_of_records(records(spark, paths)).collect()
        for path, text in zip(paths, texts):
            ours = sorted(repr((r.cells + [None] * 3)[:3]) for r in found if r.file.endswith(path))
            assert ours == whole_file(spark, path, 3), (text, size)


def test_states(spark):
    """The state at the end of a line against a reader of single characters."""
    def plain(line, inside):
        state = "inside" if inside else "start"
        for c in line:
            if c == '"':
                state = {"start": "inside", "inside": "behind", "behind": "inside", "plain": "plain"}[state]
            elif state != "inside":
                state = "start" if c == "\t" else "plain"
        return int(state == "inside")

    rng = random.Random(1)
    texts = ["".join(rng.choice('"\tab') for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", end_state(F.col("t"), False).alias("o"), end_state(F.col("t"), True).alias("i"))
    for r in rows.collect():
        assert (r.o, r.i) == (plain(r.t, False), plain(r.t, True)), r.t


def test_long_records_over_many_blocks(spark, tmp_path, split_bytes):
    """Cells that run over many blocks and stretches of lines, in several files of one reading."""
    made = {}
    for k in range(3):
        rows = [["id", "note"], *([str(i), f"{'line' if i % 50 == k else 'n'}\n" * (3000 if i % 50 == k else 1)] for i in range(120))]
        path = str(tmp_path / f"f{k}.tsv")
        made[path] = rows
        with open(path, "w") as f:
            f.write("\n".join("\t".join(map(quoted, row)) for row in rows))
    split_bytes(20_000)
    found = files.cells_of_records(records(spark, list(made))).collect()
    answer = {(path, *row) for path, rows in made.items() for row in rows}
    assert {(r.file.removeprefix("file://").removeprefix("file:"), *r.cells) for r in found} == answer and len(found) == len(answer)


def test_frequencies_of_large_files(spark, tmp_path, split_bytes):
    """A plain file in many tasks and a compressed one give the frequencies of the table."""
    docs = dataset(spark, SF_DIR, "documents")
    folder = str(tmp_path / "documents")
    sinks.write_tsv(docs.coalesce(1), folder)
    (path,) = [r.path for r in files.dataset_files(files.list_files(spark, folder)).collect()]
    plain = str(tmp_path / "plain.tsv")
    with gzip.open(path.replace("file:", ""), "rb") as packed, open(plain, "wb") as out:
        out.write(packed.read())
    blocks = split_bytes(20_000)
    answer = sorted(map(repr, value_frequencies(cells(docs, "d")).collect()))
    for one in (path, plain):
        assert sorted(map(repr, files.tsv_frequencies(spark, [one], F.lit("d")).collect())) == answer
    assert blocks[0] == 1 and blocks[1] > 20
