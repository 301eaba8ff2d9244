"""Records of quoted text files, read by many tasks.

A quoted cell may hold line breaks, so that a task in the middle of a file cannot tell whether its
first line starts a record. Files are therefore read as lines, and for every line with a quote it is
found in which state the line ends, outside or inside a quoted cell, for either state at its start. These
steps are chained within each block of a file first, then over its blocks; the state at the start of
every block tells which lines continue a record. Only such lines are shuffled and joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kolumna.session import written

QUOTE = '"'
#: Lines that meet the intervals of joined lines together.
STRETCH_BITS = 10

# Where a line is between two quotes: at the start of a cell, further on in a cell without quotes or after its
# closing quote, inside quotes, and behind a quote inside quotes, which closes the cell or doubles a quote.
_START, _PLAIN, _INSIDE, _BEHIND = range(4)


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, line, value) of all lines: ``line`` grows within a block, blocks within a file.

    A file that is not compressed has a block for each split. Written once, as numbers of lines are those of
    one reading.
    """
    rows = spark.read.text(paths, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
    )
    return written(rows, "lines")


def end_state(line: Column, inside: bool, separator: str = "\t") -> Column:
    """1 if ``line`` ends inside a quoted cell, 0 if not; ``inside``: whether it starts there."""
    parts = F.split(line, QUOTE, -1)
    after_quote = F.array(*[F.lit(x) for x in (_INSIDE, _PLAIN, _BEHIND, _INSIDE)])

    def moved(state: Column, part: Column) -> Column:
        return F.when((part == "") | (state == _INSIDE), state).when(part.endswith(separator), _START).otherwise(_PLAIN)

    first = moved(F.lit(_INSIDE if inside else _START), F.get(parts, F.lit(0)))
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    last = F.aggregate(rest, first, lambda state, part: moved(F.get(after_quote, state), part))
    return (last == _INSIDE).cast("int")


def _chained(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add (fixed, bit) of all steps up to each row: the state after them is ``bit`` if ``fixed``, else the
    state before them changed by ``bit``. A step is (from_out, from_in)."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.sum(F.when((F.col("from_out") == 1) & (F.col("from_in") == 0), 1).otherwise(0)).over(window)
    df = df.withColumn("swaps", swaps)
    reset = F.last(F.when(F.col("from_out") == F.col("from_in"), F.struct("from_out", "swaps")), ignorenulls=True).over(window)
    df = df.withColumn("reset", reset)
    bit = F.coalesce(F.col("reset.from_out") - F.col("reset.swaps"), F.lit(0)) + F.col("swaps")
    return df.withColumns({"fixed": F.col("reset").isNotNull(), "bit": F.pmod(bit, F.lit(2)).cast("int")}).drop("swaps", "reset")


def _state(start: Column) -> Column:
    return F.when(F.col("fixed"), F.col("bit")).otherwise((start + F.col("bit")) % 2)


def joined_intervals(rows: DataFrame, separator: str = "\t") -> DataFrame:
    """(file, block, low, high, start): lines that belong to a record of several lines, which starts at ``start``
    (block, line). Works on lines that hold a quote, and on one row for each block."""
    value = F.col("value")
    marks = rows.where(value.contains(QUOTE)).select(
        "file", "block", "line", end_state(value, False, separator).alias("from_out"), end_state(value, True, separator).alias("from_in")
    )
    marks = written(_chained(marks, ["file", "block"], "line"), "marks")
    whole = marks.groupBy("file", "block").agg(F.max_by(F.struct("fixed", "bit"), "line").alias("last"), F.min("line").alias("first_mark"))
    blocks = rows.groupBy("file", "block").agg(F.min("line").alias("first_line"), F.max("line").alias("last_line"))
    blocks = blocks.join(whole, ["file", "block"], "left")
    fixed, bit = F.coalesce("last.fixed", F.lit(False)), F.coalesce("last.bit", F.lit(0))
    blocks = blocks.withColumns({"from_out": bit, "from_in": F.when(fixed, bit).otherwise(1 - bit)}).drop("last")
    blocks = _chained(blocks, ["file"], "block")
    earlier = Window.partitionBy("file").orderBy("block")
    blocks = blocks.withColumn("start_state", F.lag(_state(F.lit(0)), 1, 0).over(earlier))
    blocks = written(blocks.select("file", "block", "first_line", "last_line", "first_mark", "start_state"), "blocks")

    marks = marks.join(blocks, ["file", "block"]).withColumn("after", _state(F.col("start_state")))
    in_block = Window.partitionBy("file", "block").orderBy("line")
    marks = marks.withColumns({
        "before": F.coalesce(F.lag("after").over(in_block), "start_state"), "until": F.coalesce(F.lead("line").over(in_block), "last_line"),
    })
    start = F.when((F.col("before") == 0) & (F.col("after") == 1), F.struct("block", "line"))
    marks = marks.withColumn("own_start", F.last(start, ignorenulls=True).over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
    marks = marks.where("after = 1").select("file", "block", "line", "before", "until", "own_start")

    # The start of the record that is open when a block begins: the last one of the blocks before it.
    last_starts = marks.groupBy("file", "block").agg(F.max("own_start").alias("last_start"))
    carried = F.last("last_start", ignorenulls=True).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.join(last_starts, ["file", "block"], "left").withColumn("carried", carried).where("start_state = 1")
    begun = blocks.select("file", "block", F.col("first_line").alias("low"), F.coalesce("first_mark", "last_line").alias("high"), F.col("carried").alias("start"))
    carried = blocks.select("file", "block", "carried")
    going_on = marks.join(carried, ["file", "block"], "left").select(
        "file", "block", (F.col("line") + F.col("before")).alias("low"), F.col("until").alias("high"), F.coalesce("own_start", "carried").alias("start")
    )
    return begun.unionByName(going_on).where("low <= high")


def separators(text: Column, separator: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(separator), F.lit("")))


def records(spark: SparkSession, paths: list[str], separator: str = "\t") -> DataFrame:
    """(file, row, record) of all records of quoted text files, ``row`` ordered as in the file (a struct).

    A cell is quoted if it begins with a quote and then runs to the closing one; quotes elsewhere in a cell are
    text, quotes inside quotes are doubled. Empty lines are no records. A quote that is never closed makes the rest
    of its file one record, without a line break at the end.
    """
    return wide_records(spark, paths, separator)[0]


def first_rows(rows: DataFrame) -> DataFrame:
    """(file, head): where the first record of each file starts, which is its first line that is not empty."""
    starts = rows.where("value <> ''").groupBy("file", "block").agg(F.min("line").alias("line"))
    return starts.groupBy("file").agg(F.min(F.struct("block", "line")).alias("head"))


def wide_records(spark: SparkSession, paths: list[str], separator: str = "\t") -> tuple[DataFrame, int, DataFrame]:
    """``records``, how many cells one of them has at most (separators inside quotes count as well), and ``first_rows``."""
    rows = lines(spark, paths)
    parts = joined_intervals(rows, separator).select(
        F.col("file").alias("f"), F.col("block").alias("b"), "low", "high", "start",
        F.explode(F.sequence(F.shiftright("low", STRETCH_BITS), F.shiftright("high", STRETCH_BITS))).alias("stretch"),
    )
    parts = written(parts, "parts")
    meets = (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")) & (F.shiftright("line", STRETCH_BITS) == F.col("stretch"))
    tagged = rows.join(parts, meets & F.col("line").between(F.col("low"), F.col("high")), "left")
    alone = tagged.where("start is null").select("file", F.struct("block", "line").alias("row"), F.col("value").alias("record"))
    ordered = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    several = tagged.where("start is not null").groupBy("file", "start").agg(F.array_join(ordered["value"], "\n").alias("record"))
    several = written(several.withColumnRenamed("start", "row"), "joined-records")
    most = [df.agg(F.max(separators(F.col(name), separator))).first()[0] or 0 for df, name in ((rows, "value"), (several, "record"))]
    return alone.unionByName(several).where("record <> ''"), 1 + max(most), first_rows(rows)
