"""Distinct counts that merge: one bitmap of ids per hour.

COUNT(DISTINCT) of a trailing window has to read every row of the window
again. Here each id gets a dense number once (``number_ids``), each hour keeps
the set of its numbers as bitmaps of 32,768 bits, and any window is the union
of its hours' bitmaps: exact, and independent of how the rows came in, so
batches, replays and late rows merge by ``merge``. Numbers are dense so that a
bitmap of 4 KB holds as many ids as it can.

All counts leave out null ids, as COUNT(DISTINCT) does, and rows without a
time belong to no hour. Empty tables give no bitmaps and no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.time import hour_bucket

TS = "order_timestamp"
SLICES = 1024


def number_ids(ids: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(``column``, number): a dense number from 1 for each distinct non-null
    id, in addition to those ``known`` already, which keep theirs.

    Ids are dealt by hash into slices and numbered within their slice; the
    slices' sizes, one row each, give where a slice starts. The result must be
    written before it is used further: it is the dictionary of the bitmaps.
    """
    new = ids.select(column).where(F.col(column).isNotNull()).distinct()
    start = F.lit(0)
    if known is not None:
        new = new.join(known.select(column), column, "left_anti")
        start = known.select(F.coalesce(F.max("number"), F.lit(0))).scalar()
    new = new.withColumn("slice", F.pmod(F.xxhash64(column), F.lit(SLICES)).cast("int"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)   # at most SLICES rows
    sizes = new.groupBy("slice").count().select(
        "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("slice").orderBy(column))
    numbered = new.withColumn("within", within).join(sizes, "slice").select(
        column, (start + F.col("offset") + F.col("within")).cast("long").alias("number"))
    return numbered if known is None else known.select(column, "number").unionByName(numbered)


def bitmaps(rows: DataFrame, slot: str, column: str, numbers: DataFrame) -> DataFrame:
    """(``slot``, part, bits): the ids of each slot; a number's part is its
    bitmap of 32,768. Rows are reduced to distinct (slot, id) before the join,
    so a hot id is joined once a slot."""
    pairs = rows.select(slot, column).where(F.col(slot).isNotNull()).distinct()
    found = pairs.join(numbers, column).select(
        slot, F.bitmap_bucket_number("number").alias("part"), F.bitmap_bit_position("number").alias("bit"))
    return found.groupBy(slot, "part").agg(F.bitmap_construct_agg("bit").alias("bits"))


def hourly_bitmaps(orders: DataFrame, column: str, numbers: DataFrame) -> DataFrame:
    """(hour, part, bits) of the ids in ``column`` by clock hour of the order."""
    return bitmaps(orders.select(hour_bucket(TS).alias("hour"), column), "hour", column, numbers)


def merge(*tables: DataFrame) -> DataFrame:
    """The union of tables of bitmaps, e.g. of an earlier state and a batch."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    keys = [c for c in out.columns if c != "bits"]
    return out.groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_ids(maps: DataFrame, *by: Column | str, name: str = "ids") -> DataFrame:
    """(``by``, ``name``): how many ids the bitmaps of each group hold together."""
    parts = maps.groupBy(*by, "part").agg(F.bitmap_or_agg("bits").alias("bits"))
    names = [c for c in parts.columns if c not in ("part", "bits")]
    return parts.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias(name))


def trailing_days(hourly: DataFrame, days: int = 7) -> DataFrame:
    """(day, ids, trailing_ids) of each day with ids: those of the day, and
    those of the ``days`` days that end with it. A day's bitmap goes to the
    days it is history for, a fixed fan-out of bitmaps, not of rows."""
    daily = merge(hourly.select(F.to_date("hour").alias("day"), "part", "bits"))
    own = distinct_ids(daily, "day")
    ahead = F.explode(F.sequence(F.col("day"), F.date_add("day", days - 1), F.expr("interval 1 day")))
    spread = daily.select(ahead.alias("day"), "part", "bits").join(own.select("day"), "day", "left_semi")
    return own.join(distinct_ids(spread, "day", name="trailing_ids"), "day")


def ids_since(orders: DataFrame, hourly: DataFrame, column: str, numbers: DataFrame, start: Column,
              name: str = "ids") -> DataFrame:
    """One row: the distinct ids of orders since ``start``, which need not be
    a full hour. Full hours come from their bitmaps; only the rows of the hour
    that ``start`` cuts are read again."""
    first_full = F.when(hour_bucket(start) == start, start).otherwise(hour_bucket(start) + F.expr("interval 1 hour"))
    full = hourly.where(F.col("hour") >= first_full)
    cut = orders.where((F.col(TS) >= start) & (F.col(TS) < first_full))
    both = full.select("part", "bits").unionByName(hourly_bitmaps(cut, column, numbers).select("part", "bits"))
    parts = both.groupBy("part").agg(F.bitmap_or_agg("bits").alias("bits"))
    return parts.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))
