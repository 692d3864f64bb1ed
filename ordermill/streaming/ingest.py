"""Stream ingest: order messages -> landing table, with a quarantine.

Source: a topic of JSON order messages (``kafka_order_source``) or, for
tests and replays, a folder of text files (``text_order_source``); both
give one string column ``value``. Each micro-batch is decoded, stamped
with its arrival time and written by ``foreachBatch`` into
``<landing>/batch_id=N/ingest_hour=H`` (good rows, by hour of arrival) and
``<quarantine>/batch_id=N`` (malformed or incomplete messages). A batch replayed after a failure
overwrites its own folder, so every message lands exactly once.

Batch size follows the trigger: ``processing_time`` sets the flush
interval and ``max_per_trigger`` caps the rows (topic offsets) or files of
one micro-batch (``max_bytes``: their bytes), ``flush_rows`` those of a landed file. ``available_now=True`` drains what is there and stops.

Messages of a topic keep their key, partition and offset in the landing table
and the quarantine. A sink that has lost its checkpoint then takes the topic
from the start again and skips what has landed (:class:`Landed`); of a source
without offsets it refuses to start. :func:`position_faults` checks that each
offset landed once and each key in one partition, so that offsets order it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ordermill.functions.text import (CORRUPT, REQUIRED_KEYS, parse_order_json,
                                      parse_timestamp, strip_quotes)
from ordermill.functions.time import ingest_hour, now_ntz
from ordermill.sources.files import partition_values
from ordermill.sources.schemas import LANDING_TABLE, POSITION, TOPIC_RECORD

LANDING_COLUMNS = ("order_id", "customer_id", "product_id", "seller_id", "quantity",
                   "price", "order_timestamp")
POSITION_COLUMNS = tuple(POSITION.names)


def _reject_reason(msg: Column, ts: Column) -> Column:
    missing = [F.when(msg[k].isNull(), F.lit(k)) for k in REQUIRED_KEYS]
    return (F.when(msg[CORRUPT].isNotNull(), F.lit("malformed"))
            .when(F.concat_ws(",", *missing) != "",
                  F.concat(F.lit("missing:"), F.concat_ws(",", *missing)))
            .when(ts.isNull(), F.lit("bad_timestamp")))


def decode_orders(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON order messages -> landing columns plus ``reject_reason``.

    ``reject_reason`` is NULL for a good row; otherwise 'malformed' (broken
    JSON or a mistyped value), 'missing:<keys>' or 'bad_timestamp'. Product
    and seller ids lose stray ``"`` at both ends (the producer takes them from
    a naive CSV split); order and customer ids are kept as sent. ``raw``
    keeps the message text. Position columns are kept where there are any.
    """
    position = [c for c in POSITION_COLUMNS if c in messages.columns]
    # behind a generator, so that filters read the parsed record and do not parse again
    messages = messages.select(F.col(value), *position, F.explode(F.array(parse_order_json(F.col(value)))).alias("_msg"))
    msg = F.col("_msg")
    ts = parse_timestamp(msg["timestamp"])
    return messages.select(
        msg["order_id"].alias("order_id"),
        msg["customer_id"].alias("customer_id"),
        strip_quotes(msg["product_id"]).alias("product_id"),
        strip_quotes(msg["seller_id"]).alias("seller_id"),
        msg["quantity"].alias("quantity"),
        msg["price"].alias("price"),
        ts.alias("order_timestamp"),
        _reject_reason(msg, ts).alias("reject_reason"),
        F.col(value).alias("raw"), *position)


def topic_options(bootstrap_servers: str, topic: str = "orders",
                  max_per_trigger: int | None = 1_000_000) -> dict[str, str]:
    """What the topic reader is told: the whole topic from its first offset, and
    a stop, not a silent gap, where offsets were removed before they were read."""
    options = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
               "startingOffsets": "earliest", "failOnDataLoss": "true"}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def positioned(records: DataFrame) -> DataFrame:
    """Records as a topic reader gives them -> ``value`` and where it stood."""
    return records.select(
        F.col("value").cast("string").alias("value"), F.col("key").cast("string").alias("message_key"),
        F.col("partition").alias("topic_partition"), F.col("offset").alias("topic_offset"))


def kafka_order_source(spark: SparkSession, bootstrap_servers: str, topic: str = "orders",
                       max_per_trigger: int | None = 1_000_000) -> DataFrame:
    """Topic of order messages from the earliest offset (needs the Kafka
    connector on the classpath). Offsets live in the query checkpoint, and
    with each landed message.

    ``max_per_trigger`` caps the offsets of one micro-batch, so a cold start
    on a long backlog is drained in bounded batches instead of one.
    """
    reader = spark.readStream.format("kafka").options(**topic_options(bootstrap_servers, topic, max_per_trigger))
    return positioned(reader.load())


def recorded_topic_source(spark: SparkSession, path: str, max_per_trigger: int | None = None) -> DataFrame:
    """A topic recorded as Parquet files (key, value, partition, offset), each
    file after those of smaller offsets of its partitions."""
    reader = spark.readStream.schema(TOPIC_RECORD)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    return positioned(reader.parquet(path))


def text_order_source(spark: SparkSession, path: str, max_per_trigger: int | None = None,
                      max_bytes: int | None = None) -> DataFrame:
    """Folder of text files, one JSON message per line. A micro-batch takes at
    most ``max_per_trigger`` files, or files of ``max_bytes`` together (one at
    least); Spark takes one of the two."""
    reader = spark.readStream.format("text")
    if max_per_trigger and max_bytes:
        raise ValueError("give max_per_trigger or max_bytes, not both")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.load(path)


def _has_files(spark: SparkSession, path: str, pattern: str = "*") -> bool:
    """Whether any file under ``path`` matches ``pattern`` (contents not read)."""
    try:
        return bool(spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                    .option("pathGlobFilter", pattern)
                    .load(path).select("path").limit(1).count())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":   # a failed listing must not look empty
            raise
        return False


@dataclass(frozen=True)
class Landed:
    """What had landed when a sink lost its checkpoint: the first batch id that
    is free, and per topic partition the last offset landed. One row a topic
    partition, kept beside the new checkpoint as Parquet.

    A batch holds the next offsets of its partitions, and its good rows are
    committed before its rejects. So a good row has landed if its offset is no
    greater than the last good one; a reject, if no greater than the last
    offset of the batches whose rejects are there.
    """

    first_batch: int
    marks: DataFrame

    @staticmethod
    def find(spark: SparkSession, landing: str, quarantine: str) -> DataFrame:
        """(first_batch, topic_partition, good_mark, reject_mark); the row of a
        null partition is always there. Reads the positions alone."""
        ids = [[int(v) for v in partition_values(spark, path, "batch_id")] for path in (landing, quarantine)]
        first, whole = max(max(i, default=-1) for i in ids) + 1, max(ids[1], default=-1)
        schema = T.StructType([*POSITION.fields, T.StructField("batch_id", T.LongType())])
        good, bad = [spark.read.schema(schema).parquet(path).select(*schema.names) if i else spark.createDataFrame([], schema)
                     for path, i in zip((landing, quarantine), ids)]
        both = good.withColumn("good", F.lit(True)).unionByName(bad.withColumn("good", F.lit(False)))
        marks = both.groupBy("topic_partition").agg(
            F.max(F.when(F.col("good"), F.col("topic_offset"))).alias("good_mark"),
            F.max(F.when(F.col("batch_id") <= whole, F.col("topic_offset"))).alias("reject_mark"))
        always = spark.range(1).select(F.lit(None).cast("int").alias("topic_partition"))
        return (marks.where("topic_partition IS NOT NULL").unionByName(always, allowMissingColumns=True)
                .select(F.lit(first).cast("long").alias("first_batch"), "*"))

    @staticmethod
    def read(spark: SparkSession, path: str) -> Landed:
        marks = spark.read.parquet(path)
        return Landed(marks.agg(F.max("first_batch")).first()[0], marks.drop("first_batch"))

    def unseen(self, decoded: DataFrame) -> DataFrame:
        """The decoded rows that have not landed; those without a position all."""
        mark = F.when(F.col("reject_reason").isNull(), F.col("good_mark")).otherwise(F.col("reject_mark"))
        return (decoded.join(self.marks, "topic_partition", "left")
                .where(F.coalesce(F.col("topic_offset") > mark, F.lit(True))).select(*decoded.columns))


@dataclass(frozen=True)
class LandingSink:
    """Where a stream of orders lands: good rows, rejects, and progress.

    ``arrival`` is the time of arrival of a decoded message: now, or, when
    history is replayed, an expression over the landing columns. ``flush_rows``
    caps the rows of one landed file, whatever the source gives at once: a
    writer closes its file at that count and opens the next.
    """

    landing: str
    quarantine: str
    checkpoint: str
    arrival: Column | None = None
    flush_rows: int | None = None

    def write_batch(self, batch: DataFrame, batch_id: int, landed: Landed | None = None) -> None:
        arrival = now_ntz() if self.arrival is None else self.arrival
        decoded = decode_orders(batch).withColumn("insert_timestamp", arrival)
        position = [c for c in POSITION_COLUMNS if c in decoded.columns]
        if landed:
            decoded, batch_id = landed.unseen(decoded), landed.first_batch + batch_id
        # One micro-batch is bounded by the trigger cap; keep it for the two
        # writes instead of decoding the input twice.
        decoded = decoded.persist()
        try:
            good = decoded.where(F.col("reject_reason").isNull()).select(
                *LANDING_COLUMNS, "insert_timestamp", *position, ingest_hour("insert_timestamp").alias("ingest_hour"))
            if self.arrival is not None:       # many hours: their folders dealt over the tasks
                writers = int(good.sparkSession.conf.get("spark.sql.shuffle.partitions"))
                good = good.repartition(writers, "ingest_hour")
            bad = decoded.where(F.col("reject_reason").isNotNull()).select(
                "raw", "reject_reason", "insert_timestamp", *position)
            (good.write.mode("overwrite").partitionBy("ingest_hour")
             .option("maxRecordsPerFile", self.flush_rows or 0)
             .parquet(os.path.join(self.landing, f"batch_id={batch_id}")))
            bad.write.mode("overwrite").parquet(
                os.path.join(self.quarantine, f"batch_id={batch_id}"))
        finally:
            decoded.unpersist()

    def start(self, source: DataFrame, processing_time: str | None = "5 seconds",
              available_now: bool = False) -> StreamingQuery:
        spark = source.sparkSession
        resumed = os.path.join(self.checkpoint, "landed")
        # Batch ids restart at 0 with a new checkpoint and would overwrite
        # landed data: go on behind it, or, without offsets, refuse.
        if (_has_files(spark, self.landing, "*.parquet")
                and not _has_files(spark, self.checkpoint)):
            if "topic_offset" not in source.columns:
                raise RuntimeError(f"landing table {self.landing} has data but checkpoint "
                                   f"{self.checkpoint} is empty; refusing to restart at batch 0")
            Landed.find(spark, self.landing, self.quarantine).coalesce(1).write.parquet(resumed)
        landed = Landed.read(spark, resumed) if _has_files(spark, resumed, "*.parquet") else None
        writer = (source.writeStream.foreachBatch(lambda batch, batch_id: self.write_batch(batch, batch_id, landed))
                  .option("checkpointLocation", self.checkpoint))
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif processing_time:
            writer = writer.trigger(processingTime=processing_time)
        return writer.start()


def read_landing(spark: SparkSession, landing: str) -> DataFrame:
    """The landing table (all batches) with its fixed schema; empty when new."""
    return spark.read.schema(LANDING_TABLE).parquet(landing)


def position_faults(landing: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """(fault, failures): offsets that landed more than once (``repeated_offset``),
    and keys met in several partitions (``split_key``), whose messages no
    offset orders. Rows without a position are left out."""
    columns = [*POSITION_COLUMNS]
    rows = landing.select(*columns) if rejects is None else landing.select(*columns).unionByName(rejects.select(*columns))
    repeated = (rows.where(F.col("topic_offset").isNotNull()).groupBy("topic_partition", "topic_offset")
                .agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("failures")))
    spread = (rows.where(F.col("message_key").isNotNull()).groupBy("message_key")
              .agg(F.min("topic_partition").alias("least"), F.max("topic_partition").alias("most"))
              .agg(F.count_if(F.col("least") < F.col("most")).alias("failures")))
    return (repeated.select(F.lit("repeated_offset").alias("fault"), "failures")
            .unionByName(spread.select(F.lit("split_key").alias("fault"), "failures")))


def newest_arrival(spark: SparkSession, landing: str) -> str | None:
    """The time of the last arrival: only the newest hour's folders are read."""
    hours = partition_values(spark, landing, "ingest_hour")
    if not hours:
        return None
    newest = read_landing(spark, landing).where(F.col("ingest_hour") == hours[-1])
    return newest.agg(F.max("insert_timestamp").cast("string")).first()[0]


def landing_stream(spark: SparkSession, landing: str,
                   max_files_per_trigger: int | None = None,
                   ignore_missing: bool = False) -> DataFrame:
    """The landing table as a stream: each new batch folder is picked up
    once (the file source's log), e.g. to feed the live hourly table. The log
    knows files, not batches: a replayed batch comes again under new names.
    ``ignore_missing`` skips files that a replay has replaced meanwhile."""
    reader = spark.readStream.schema(LANDING_TABLE)
    if ignore_missing:
        reader = reader.option("ignoreMissingFiles", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(landing)


# --- compaction -----------------------------------------------------------

def compact_landing(spark: SparkSession, landing: str, table: str, start_date: str,
                    end_date: str) -> None:
    """Rewrite the landed orders of [start_date, end_date] into ``table``,
    partitioned by ``order_date``.

    Micro-batches leave many small files laid out by batch; the dashboard
    reads by time. Each run replaces exactly the date partitions it covers
    (dynamic partition overwrite), so a rerun after a failure gives the
    same table. The write is rebalanced on order_date (Spark's REBALANCE
    hint): AQE splits a date holding most of the rows over several tasks and
    merges small ones, so files come out evenly sized. Orders that
    land after their date was compacted appear once the date is compacted
    again (each run rebuilds whole dates from the landing table).
    """
    ts = F.col("order_timestamp")
    start = F.to_date(F.lit(start_date))
    end = F.to_date(F.lit(end_date))
    rows = (read_landing(spark, landing)
            .where((ts >= start.cast("timestamp_ntz"))
                   & (ts < F.date_add(end, 1).cast("timestamp_ntz")))
            .drop("batch_id", "ingest_hour")
            .withColumn("order_date", F.to_date(ts)))
    (rows.hint("rebalance", "order_date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("order_date").parquet(table))


def live_orders(spark: SparkSession, landing: str, table: str, cutoff_date: str) -> DataFrame:
    """All orders: compacted dates before ``cutoff_date`` from ``table``, the
    rest from the landing table, each row exactly once. Both parts carry
    ``order_date``, so date predicates prune the compacted partitions."""
    cutoff = F.to_date(F.lit(cutoff_date))
    old = spark.read.parquet(table).where(F.col("order_date") < cutoff)
    recent = (read_landing(spark, landing).drop("batch_id", "ingest_hour")
              .where(F.col("order_timestamp") >= cutoff.cast("timestamp_ntz"))
              .withColumn("order_date", F.to_date("order_timestamp")))
    return old.unionByName(recent, allowMissingColumns=True)
