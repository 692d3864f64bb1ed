"""Live hourly metrics in keyed state: one record per hour and landed batch.

The landing stream's rows are summed per hour and batch inside each task, so a
current hour with most of the rows reaches its state as a few partial sums.
The state of an hour (``transformWithState``, RocksDB) holds one record per
landed batch, stamped with the batch's arrival time, and the hour's total:

- rows of the same writing of a batch add to its record, however the stream
  deals its files over micro-batches;
- a batch that was landed again (a replay writes the same messages under new
  files with a later arrival) takes the place of its record, so it does not
  count twice; files of the older writing that come late are ignored;
- a row counts however late it lands, and touches its own hour alone: nothing
  of the landing table is read again.

There is no watermark. The state holds a record of six numbers for each hour
and batch that meet, so it grows with batches, not with orders.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ordermill.functions.money import money_of, to_double
from ordermill.functions.time import hour_bucket
from ordermill.streaming.ingest import landing_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
MONEY = T.DecimalType(38, 6)
_SUMS = [("orders", T.LongType()), ("revenue", MONEY), ("priced", T.LongType()),
         ("items", T.LongType()), ("counted", T.LongType())]
RECORD = T.StructType([T.StructField("written", T.LongType()), *[T.StructField(n, t) for n, t in _SUMS]])
TOTAL = T.StructType([T.StructField(n, t) for n, t in _SUMS])
BATCH = T.StructType([T.StructField("batch_id", T.LongType())])
PARTIAL = T.StructType([T.StructField("hour", T.TimestampNTZType()), T.StructField("batch_id", T.LongType()),
                        *RECORD.fields])
OUTPUT = T.StructType([T.StructField("hour", T.TimestampNTZType()), *TOTAL.fields])
_EXACT = decimal.Context(prec=60)
_NOTHING = (0, decimal.Decimal(0), 0, 0, 0)
_KEYS = ["hour", "batch_id", "written"]


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of each Arrow batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sums = pa.Table.from_batches([batch]).group_by(_KEYS).aggregate(
            [("one", "sum"), ("revenue", "sum"), ("revenue", "count"), ("quantity", "sum"), ("quantity", "count")])
        columns = [*_KEYS, "one_sum", "revenue_sum", "revenue_count", "quantity_sum", "quantity_count"]
        names = [f.name for f in PARTIAL.fields]
        zero = {"revenue_sum": decimal.Decimal(0), "quantity_sum": 0}
        arrays = [sums[c].fill_null(zero[c]) if c in zero else sums[c] for c in columns]
        arrays = [a.cast(pa.decimal128(38, 6)) if n == "revenue" else a for n, a in zip(names, arrays)]
        yield from pa.table(arrays, names=names).to_batches()


def partial_sums(orders: DataFrame) -> DataFrame:
    """Landing rows -> sums per hour, batch and arrival, as the tasks see them."""
    revenue = (money_of(orders, "price") * F.col("quantity")).cast(MONEY)
    rows = orders.where(F.col("order_timestamp").isNotNull()).select(
        hour_bucket("order_timestamp").alias("hour"), F.col("batch_id").cast("long").alias("batch_id"),
        F.unix_micros(F.col("insert_timestamp").cast("timestamp")).alias("written"),
        F.lit(1).cast("long").alias("one"), revenue.alias("revenue"), F.col("quantity").cast("long").alias("quantity"))
    return rows.mapInArrow(_combine, PARTIAL)


def _add(a: tuple, b: tuple, sign: int = 1) -> tuple:
    return tuple(_EXACT.add(x, y if sign > 0 else -y) if isinstance(x, decimal.Decimal) else x + sign * y
                 for x, y in zip(a, b))


class HourRecords(StatefulProcessor):
    """The records and the total of each hour; emits the totals that change."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.records = handle.getMapState("batches", BATCH, RECORD)
        self.total = handle.getValueState("total", TOTAL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = tuple(self.total.get() or _NOTHING)
        total = before
        for row in rows:
            batch, sums = (row["batch_id"],), tuple(row[n] for n, _ in _SUMS)
            held = tuple(self.records.getValue(batch) or ())
            if held and held[0] > row["written"]:
                continue                               # of a writing that was replaced
            if held and held[0] == row["written"]:
                record = _add(held[1:], sums)
            else:
                record = sums
                total = _add(total, held[1:], -1) if held else total
            total = _add(total, sums)
            self.records.updateValue(batch, (row["written"], *record))
        if total != before:
            self.total.update(total)
            yield Row(hour=key[0], **dict(zip(TOTAL.names, total)))

    def close(self) -> None:
        pass


def hourly_records(orders: DataFrame) -> DataFrame:
    """Streaming DataFrame of the hours that change: hour, orders_count,
    total_revenue, items_count, as :func:`realtime.hourly_series` counts them.

    ``orders``: the landing table as a stream, with ``batch_id`` and
    ``insert_timestamp``. Rows without an order time are not counted; an hour's
    revenue is null while none of its rows has a price.
    """
    changed = partial_sums(orders).groupBy("hour").transformWithState(
        statefulProcessor=HourRecords(), outputStructType=OUTPUT, outputMode="Update", timeMode="None")
    return changed.select(
        "hour", F.col("orders").alias("orders_count"),
        F.when(F.col("priced") > 0, to_double(F.col("revenue"))).alias("total_revenue"),
        F.when(F.col("counted") > 0, F.col("items")).alias("items_count"))


def start_hourly_state(spark: SparkSession, landing: str, path: str, checkpoint: str,
                       available_now: bool = False, processing_time: str = "5 seconds",
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Keep the live hourly table at ``path`` (a partition per hour) from the
    landing table's keyed state. Only the hours that change are written; their
    partitions are replaced, so a repeated micro-batch gives the same table.
    The number of state partitions is ``spark.sql.shuffle.partitions`` at the
    first start."""
    from ordermill.streaming.hourly import upsert_hours

    hours = hourly_records(landing_stream(spark, landing, max_files_per_trigger, ignore_missing=True))
    writer = (hours.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, _batch_id: upsert_hours(batch, path)))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    provider = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)                  # a query keeps what it started with
    try:
        return writer.start()
    finally:
        if provider is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, provider)
