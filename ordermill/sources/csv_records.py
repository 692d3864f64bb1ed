"""Records of CSV files whose quoted fields span lines, found in parallel.

Spark's own reader takes such a file in one task, as a line end may lie inside
quotes. Here every byte range is read as lines by its own task. A line is a
function from "the text before it ended inside quotes, or not" to the same
question after it. Composed over the lines of a range, and then over the
ranges of a file in order, these functions tell of each line whether it starts
a record; lines that neither start nor end inside quotes are records as they
are, and only the few others are brought together. Nothing but one small row a
range is in one place.

Quotes open a field only at its start and close it at the first quote that is
not doubled, as Spark's reader has it; a stray quote inside a plain field is a
character, so one bad row does not turn the rest of the file inside out. A
line end inside quotes stays as it is; records may end in LF or CRLF.

A quote that is never closed makes one record of all that follows. Beyond
``MOST_LINES`` lines such a record is not put together: each of its lines
becomes a record of its own, and the schema rejects it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.session import shared_dir

MOST_LINES = 100_000
_QUOTE = '"'


def _after(line: Column, inside: int) -> Column:
    """Whether text is inside quotes (1) or not (0) after ``line``, if it was
    ``inside`` before it."""
    def step(state: Column, piece: Column) -> Column:
        opened = piece.startswith(_QUOTE)
        text = F.when(state == 1, piece).otherwise(F.substring(piece, F.lit(2), F.length(piece)))
        closed = F.contains(F.replace(text, F.lit('""'), F.lit("")), F.lit(_QUOTE))
        return F.when((state == 1) | opened, F.when(closed, 0).otherwise(1)).otherwise(0)
    pieces = F.split(line, ",", -1)
    return F.when(F.contains(line, F.lit(_QUOTE)), F.aggregate(pieces, F.lit(inside), step)).otherwise(F.lit(inside))


def _entered(order: Window, after0: str, after1: str) -> tuple[Column, Column]:
    """The state before each row of ``order`` if the first is entered outside
    and inside quotes: that after the last row which sets it whatever came
    before, turned over by every row since that swaps it."""
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col(after0) == F.col(after1)
    swaps = ((F.col(after0) == 1) & (F.col(after1) == 0)).cast("int")
    turned = F.coalesce(F.sum(swaps).over(before), F.lit(0))
    upto = F.sum(swaps).over(order.rowsBetween(Window.unboundedPreceding, 0))
    last = F.last(F.when(sets, F.struct(F.col(after0).alias("state"), upto.alias("turned"))), ignorenulls=True).over(before)
    known = F.pmod(last["state"] + turned - last["turned"], F.lit(2))
    return tuple(F.when(last.isNull(), F.pmod(F.lit(e) + turned, F.lit(2))).otherwise(known).cast("int") for e in (0, 1))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place: file, first byte of the range, position (rising
    within a range), and the line's effect on the state."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))
            .withColumns({"after0": _after(F.col("line"), 0), "after1": _after(F.col("line"), 1)}))


def csv_records(spark: SparkSession, path: str, staging: str | None = None, most_lines: int = MOST_LINES) -> DataFrame:
    """One row per record of the files at ``path`` (column ``record``), without
    each file's header line and without empty lines.

    The lines are staged once, under ``staging`` or the session's shared
    folder, so that what the ranges tell of each other is known before the
    records are read.
    """
    staging = staging or shared_dir(spark, "csv_lines")
    within = Window.partitionBy("file", "block").orderBy("pos")
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    in0, in1 = _entered(within, "after0", "after1")
    lines = _lines(spark, path).withColumns({"in0": in0, "in1": in1})
    starts = {f"start{e}": F.last(F.when(F.col(f"in{e}") == 0, F.col("pos")), ignorenulls=True).over(upto) for e in (0, 1)}
    lines.withColumns(starts).write.mode("overwrite").parquet(staging)
    lines = spark.read.parquet(staging)

    def left(e: int) -> Column:
        return F.when(F.col(f"in{e}") == 0, F.col("after0")).otherwise(F.col("after1"))
    ranges = lines.groupBy("file", "block").agg(
        F.max_by(left(0), "pos").alias("out0"), F.max_by(left(1), "pos").alias("out1"),
        F.max("start0").alias("last0"), F.max("start1").alias("last1"), F.min("pos").alias("first"))
    along = Window.partitionBy("file").orderBy("block")              # a row per range of a file
    entered, _ = _entered(along, "out0", "out1")
    ranges = ranges.withColumn("entered", entered)
    last = F.when(F.col("entered") == 0, F.col("last0")).otherwise(F.col("last1"))
    ranges = ranges.select(
        "file", "block", "entered", F.when(F.col("block") == 0, F.col("first")).alias("header"),
        F.last(last, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("open"))

    inside = F.when(F.col("entered") == 0, F.col("in0")).otherwise(F.col("in1"))
    start = F.coalesce(F.when(F.col("entered") == 0, F.col("start0")).otherwise(F.col("start1")), F.col("open"))
    ends = F.when(inside == 0, F.col("after0")).otherwise(F.col("after1"))
    placed = (lines.join(ranges, ["file", "block"])
              .select("pos", "line", "header", start.alias("start"), ((inside == 0) & (ends == 0)).alias("whole"))
              .where(F.col("header").isNull() | (F.col("start") != F.col("header"))))
    single = placed.where("whole").select("line")
    parts = placed.where(~F.col("whole"))
    sizes = parts.groupBy("start").agg((F.count(F.lit(1)) > most_lines).alias("endless"))
    parts = parts.join(sizes, "start")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "line")))
    joined = parts.where("NOT endless").groupBy("start").agg(
        F.array_join(F.transform(ordered, lambda p: p["line"]), "\n").alias("line")).select("line")
    records = single.unionByName(joined).unionByName(parts.where("endless").select("line"))
    return (records.select(F.regexp_replace("line", "\r$", "").alias("record")).where("record <> ''"))
