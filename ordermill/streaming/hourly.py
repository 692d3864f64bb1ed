"""Incremental hourly metrics: the streaming twin of the hourly series.

Tumbling one-hour windows over the order time with a watermark, so state
for an hour is dropped once the stream is ``watermark`` past it; rows
later than that are not counted (the batch series over the landing table
counts them). Watermarks need a zoned TIMESTAMP, so the NTZ order time is
reinterpreted in the session zone and converted back on output; run streams
with the session zone at UTC (``build_session`` sets it), where that round
trip is exact.

The state store's partition count is taken from
``spark.sql.shuffle.partitions`` when a query first starts and is then fixed
by its checkpoint; the state is one row per hour, so start these queries
with a small value (the ``hourly`` job uses 16), not a cluster-wide 20 000.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.functions.money import exact_sum, money_of, to_double
from ordermill.functions.time import hour_bucket
from ordermill.operators.realtime import hourly_series
from ordermill.streaming.ingest import landing_stream, read_landing


def hourly_stream(orders: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Streaming DataFrame of (hour, orders_count, total_revenue, items_count)."""
    timed = orders.withColumn("event_time", F.col("order_timestamp").cast("timestamp"))
    revenue = exact_sum(money_of(orders, "price") * F.col("quantity"))
    return (timed.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("orders_count"),
                 to_double(revenue).alias("total_revenue"),
                 F.sum("quantity").alias("items_count"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("hour"),
                    "orders_count", "total_revenue", "items_count"))


def start_hourly_snapshot(hourly: DataFrame, path: str, checkpoint: str,
                          available_now: bool = False,
                          processing_time: str = "5 seconds") -> StreamingQuery:
    """Keep ``path`` holding the full current hourly table (complete mode).

    Each micro-batch rewrites the snapshot, open hours included. Complete
    mode keeps every hour in the state store (one row per hour: it grows
    with the time span, not with the order volume); for unbounded runs use
    ``start_hourly_append``, which drops closed hours.
    """
    def write(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = (hourly.writeStream.outputMode("complete").foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()


def start_hourly_append(hourly: DataFrame, path: str, checkpoint: str,
                        available_now: bool = False,
                        processing_time: str = "5 seconds") -> StreamingQuery:
    """Append each hour to a Parquet table once the watermark has passed it.

    The production mode: an hour is written exactly once (the file sink's
    own log makes replays idempotent) and its state is dropped, so the state
    store holds only the hours still open. Rows arriving after their hour
    was closed are not counted.
    """
    writer = (hourly.writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()


def upsert_hours(hours: DataFrame, path: str) -> None:
    """Replace the rows of ``hours`` in the hourly table, a partition each."""
    # a count of its own, so that a backlog of many hours is not written by one task
    writers = int(hours.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (hours.withColumn("hour_key", F.date_format("hour", "yyyy-MM-dd-HH"))
     .repartition(writers, "hour_key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("hour_key").parquet(path))


def start_hourly_updates(hourly: DataFrame, path: str, checkpoint: str,
                         available_now: bool = False,
                         processing_time: str = "5 seconds") -> StreamingQuery:
    """Live hourly table: open hours visible, closed hours' state dropped.

    Update mode emits, per micro-batch, the new totals of the hours that
    changed. Each is written into its own ``hour_key`` partition with
    dynamic partition overwrite, which replaces that hour's previous row:
    an upsert keyed by hour, idempotent when a batch is replayed.
    """
    writer = (hourly.writeStream.outputMode("update").foreachBatch(lambda batch, _batch_id: upsert_hours(batch, path))
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()


def start_hourly_recount(spark: SparkSession, landing: str, path: str, checkpoint: str,
                         available_now: bool = False,
                         processing_time: str = "5 seconds") -> StreamingQuery:
    """Live hourly table that stays right when batches are replayed or late.

    The landing stream only tells which hours changed; those hours are counted
    anew from the landing table itself and replace their rows. A replayed
    ingest batch (rewritten under new file names) therefore cannot count
    twice, and a row counts however late it lands. There is no state and no
    watermark. The scan of the landing table is bounded by a pushed time range.
    """
    def recount(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        hours = batch.select(hour_bucket("order_timestamp").alias("hour")).where(
            F.col("hour").isNotNull()).distinct()
        low, high = hours.agg(F.min("hour"), F.max("hour")).first()
        if low is None:
            return
        after = F.lit(high).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")
        orders = read_landing(session, landing).where(
            (F.col("order_timestamp") >= F.lit(low).cast("timestamp_ntz"))
            & (F.col("order_timestamp") < after))
        upsert_hours(hourly_series(orders).join(hours, "hour", "left_semi"), path)

    writer = (landing_stream(spark, landing, ignore_missing=True).writeStream.foreachBatch(recount)
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()
