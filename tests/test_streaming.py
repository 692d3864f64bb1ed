"""Stream ingest (file source, availableNow) and the hourly twin."""

from __future__ import annotations

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from ordermill.operators import realtime
from ordermill.plans import catalog
from ordermill.plans.audit import plan_text
from ordermill.sources import fixtures as fx
from ordermill.streaming import hourly, ingest


def _msg(i, **over):
    m = {"order_id": f"ORDER_20240101_{i}", "customer_id": f"CUST_{i}",
         "product_id": f'"p{i}"', "seller_id": f'"s{i % 3}"', "quantity": 1 + i % 5,
         "price": 10.5 + i, "timestamp": f"2024-01-01T10:{i:02d}:00.123456"}
    m.update(over)
    return json.dumps(m)


def _drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_decode_flags_bad_messages(spark):
    rows = [_msg(1), _msg(2, timestamp="2024-01-01T10:02:00"), "{broken",
            _msg(3, quantity="three"), json.dumps({"order_id": "x"}),
            _msg(4, timestamp="yesterday")]
    df = ingest.decode_orders(spark.createDataFrame([(r,) for r in rows], "value string"))
    got = {r["raw"]: r for r in df.collect()}
    ok = got[rows[0]]
    assert ok["reject_reason"] is None and ok["product_id"] == "p1" and ok["seller_id"] == "s1"
    assert ok["order_timestamp"] == dt.datetime(2024, 1, 1, 10, 1, 0, 123456)
    assert got[rows[1]]["reject_reason"] is None      # ISO text without fraction
    assert got["{broken"]["reject_reason"] == "malformed"
    assert got[rows[3]]["reject_reason"] == "malformed"
    assert got[rows[4]]["reject_reason"].startswith("missing:customer_id")
    assert got[rows[5]]["reject_reason"] == "bad_timestamp"


def test_landing_exactly_once_with_quarantine_and_replay(spark, tmp):
    src, land, bad, ckpt = (os.path.join(tmp, d) for d in ("in", "land", "bad", "ckpt"))
    sink = ingest.LandingSink(land, bad, ckpt)
    _drop(src, "f1.json", [_msg(i) for i in range(5)] + ["{oops"])
    sink.start(ingest.text_order_source(spark, src, 1), available_now=True).awaitTermination()
    assert spark.read.parquet(land).count() == 5
    assert spark.read.parquet(bad).count() == 1
    # Restart without new input: nothing is written twice.
    sink.start(ingest.text_order_source(spark, src, 1), available_now=True).awaitTermination()
    assert spark.read.parquet(land).count() == 5
    # New file: one more batch.
    _drop(src, "f2.json", [_msg(i) for i in range(5, 8)])
    sink.start(ingest.text_order_source(spark, src, 1), available_now=True).awaitTermination()
    landed = spark.read.parquet(land)
    assert landed.count() == 8
    assert landed.select(F.countDistinct("batch_id")).first()[0] == 2
    assert landed.where(F.col("insert_timestamp").isNull()).count() == 0
    # Replaying a batch overwrites its own folder.
    sink.write_batch(spark.read.text(os.path.join(src, "f2.json")), 1)
    assert spark.read.parquet(land).count() == 8


def test_rows_and_bytes_of_a_flush(spark, tmp):
    src, land, bad = (os.path.join(tmp, d) for d in ("in", "land", "bad"))
    for k in range(3):
        _drop(src, f"f{k}.json", [_msg(i) for i in range(25)])
    size = os.path.getsize(os.path.join(src, "f0.json"))
    sink = ingest.LandingSink(land, bad, os.path.join(tmp, "c"), flush_rows=10)
    sink.start(ingest.text_order_source(spark, src, max_bytes=size), available_now=True).awaitTermination()
    landed = ingest.read_landing(spark, land).select("batch_id", F.input_file_name().alias("file"))
    assert {r["count"] for r in landed.groupBy("batch_id").count().collect()} == {25}
    per_file = [r["count"] for r in landed.groupBy("file").count().collect()]
    assert max(per_file) == 10 and sum(per_file) == 75
    with pytest.raises(ValueError, match="not both"):
        ingest.text_order_source(spark, src, 1, 1)


def test_refuses_restart_on_lost_checkpoint(spark, tmp):
    src, land, bad = (os.path.join(tmp, d) for d in ("in", "land", "bad"))
    _drop(src, "f1.json", [_msg(1)])
    ingest.LandingSink(land, bad, os.path.join(tmp, "c1")).start(
        ingest.text_order_source(spark, src), available_now=True).awaitTermination()
    with pytest.raises(RuntimeError, match="refusing"):
        ingest.LandingSink(land, bad, os.path.join(tmp, "c2")).start(
            ingest.text_order_source(spark, src), available_now=True)


def test_hourly_stream_equals_batch_series(spark, sf_dir):
    streamed = {tuple(r) for r in catalog.stream_hourly(spark, sf_dir)
                .select("hour", "orders_count", "total_revenue", "items_count").collect()}
    batch = {tuple(r) for r in realtime.hourly_series(fx.raw_orders_stream(spark, sf_dir))
             .select("hour", "orders_count", "total_revenue", "items_count").collect()}
    assert streamed == batch


def test_hourly_stream_drops_rows_past_the_watermark(spark, tmp):
    src = os.path.join(tmp, "ev")
    schema = "order_timestamp timestamp_ntz, price double, quantity bigint"
    t = dt.datetime(2024, 1, 1, 10, 30)
    out, ckpt = os.path.join(tmp, "out"), os.path.join(tmp, "ck")

    def run():
        stream = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
                  .parquet(src))
        hourly.start_hourly_append(hourly.hourly_stream(stream), out, ckpt,
                                   available_now=True).awaitTermination()

    spark.createDataFrame([(t, 1.0, 1), (t + dt.timedelta(hours=5), 1.0, 1)], schema) \
        .write.parquet(os.path.join(src, "a"))
    run()
    # Arrives after the stream has moved 5 hours past it: later than the watermark.
    spark.createDataFrame([(t, 1.0, 1)], schema).write.parquet(os.path.join(src, "b"))
    run()
    # Closing the 15:00 hour needs an event past it.
    spark.createDataFrame([(t + dt.timedelta(hours=7), 1.0, 1)], schema) \
        .write.parquet(os.path.join(src, "c"))
    run()
    rows = {r["hour"]: r["orders_count"] for r in spark.read.parquet(out).collect()}
    assert rows[dt.datetime(2024, 1, 1, 10)] == 1      # the late row was not counted
    assert rows[dt.datetime(2024, 1, 1, 15)] == 1      # each closed hour written once
    assert len(spark.read.parquet(out).where("hour = '2024-01-01 10:00:00'").collect()) == 1


def test_compaction_is_idempotent_and_read_once(spark, tmp):
    src, land, bad, ckpt = (os.path.join(tmp, d) for d in ("in", "land", "bad", "ckpt"))
    days = [f"2024-01-0{d}T{h:02d}:30:00" for d in (1, 2, 3) for h in (0, 12, 23)]
    _drop(src, "f.json", [_msg(i, timestamp=t) for i, t in enumerate(days)])
    ingest.LandingSink(land, bad, ckpt).start(
        ingest.text_order_source(spark, src), available_now=True).awaitTermination()
    table = os.path.join(tmp, "orders_by_date")
    for _ in range(2):   # a rerun replaces the same partitions
        ingest.compact_landing(spark, land, table, "2024-01-01", "2024-01-02")
    compacted = spark.read.parquet(table)
    assert compacted.count() == 6
    assert {r[0] for r in compacted.select("order_date").distinct().collect()} == {
        dt.date(2024, 1, 1), dt.date(2024, 1, 2)}
    live = ingest.live_orders(spark, land, table, "2024-01-03")
    assert live.count() == 9 and live.select("order_id").distinct().count() == 9
    # Trailing windows prune on order_date and still see the right rows.
    as_of = dt.datetime(2024, 1, 3, 0, 10)
    # 2024-01-02 23:30 (compacted) plus the three later rows (no upper bound).
    kpi = realtime.kpi_last_hour(live, as_of)
    assert kpi.first()["orders_count"] == 4
    # Only date partitions from the window start on are read.
    assert re.search(r"PartitionFilters: \[[^\]]*order_date#\d+ >= 2024-01-02", plan_text(kpi))
    top = realtime.top_sellers(live, "week", as_of).collect()
    assert sum(1 for _ in top) >= 1


def test_hourly_updates_upsert_open_hours(spark, tmp):
    src = os.path.join(tmp, "ev")
    schema = "order_timestamp timestamp_ntz, price double, quantity bigint"
    t = dt.datetime(2024, 1, 1, 10, 5)
    out, ckpt = os.path.join(tmp, "out"), os.path.join(tmp, "ck")

    def run():
        stream = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
                  .parquet(src))
        hourly.start_hourly_updates(hourly.hourly_stream(stream), out, ckpt,
                                    available_now=True).awaitTermination()

    spark.createDataFrame([(t, 2.5, 2)], schema).write.parquet(os.path.join(src, "a"))
    run()
    spark.createDataFrame([(t + dt.timedelta(minutes=20), 1.0, 1),
                           (t + dt.timedelta(hours=1), 3.0, 1)], schema) \
        .write.parquet(os.path.join(src, "b"))
    run()
    rows = {r["hour"]: r for r in spark.read.parquet(out).collect()}
    assert len(rows) == 2                                  # one row per hour, no duplicates
    ten = rows[dt.datetime(2024, 1, 1, 10)]
    assert (ten["orders_count"], ten["items_count"], ten["total_revenue"]) == (2, 3, 6.0)


def test_only_product_and_seller_ids_are_unquoted(spark):
    m = _msg(1, order_id='"ORDER_1"', customer_id='"CUST_1"')
    r = ingest.decode_orders(spark.createDataFrame([(m,)], "value string")).first()
    assert (r["order_id"], r["customer_id"]) == ('"ORDER_1"', '"CUST_1"')
    assert (r["product_id"], r["seller_id"]) == ("p1", "s1")


def test_live_chain_sink_to_landing_to_hourly_table(spark, tmp):
    from ordermill.sources import files
    src, land, bad, ckpt = (os.path.join(tmp, d) for d in ("in", "land", "bad", "ckpt"))
    files.ensure_landing_table(spark, land)
    sink = ingest.LandingSink(land, bad, ckpt)
    out, hck = os.path.join(tmp, "hourly"), os.path.join(tmp, "hck")

    def step(name, stamps):
        _drop(src, name, [_msg(i, timestamp=t) for i, t in enumerate(stamps)])
        sink.start(ingest.text_order_source(spark, src), available_now=True).awaitTermination()
        hourly.start_hourly_updates(hourly.hourly_stream(ingest.landing_stream(spark, land)),
                                    out, hck, available_now=True).awaitTermination()

    step("a.json", ["2024-01-01T10:05:00", "2024-01-01T10:15:00"])
    step("b.json", ["2024-01-01T10:45:00", "2024-01-01T11:10:00"])
    rows = {r["hour"]: r["orders_count"] for r in spark.read.parquet(out).collect()}
    assert rows == {dt.datetime(2024, 1, 1, 10): 3, dt.datetime(2024, 1, 1, 11): 1}
    batch = {r["hour"]: r["orders_count"] for r in
             realtime.hourly_series(ingest.read_landing(spark, land)).collect()}
    assert rows == batch


def test_recompaction_picks_up_late_orders(spark, tmp):
    src, land, bad, ckpt = (os.path.join(tmp, d) for d in ("in", "land", "bad", "ckpt"))
    sink = ingest.LandingSink(land, bad, ckpt)
    _drop(src, "a.json", [_msg(1, timestamp="2024-01-01T10:00:00")])
    sink.start(ingest.text_order_source(spark, src), available_now=True).awaitTermination()
    table = os.path.join(tmp, "by_date")
    ingest.compact_landing(spark, land, table, "2024-01-01", "2024-01-01")
    _drop(src, "b.json", [_msg(2, timestamp="2024-01-01T11:00:00")])   # late for that date
    sink.start(ingest.text_order_source(spark, src), available_now=True).awaitTermination()
    assert ingest.live_orders(spark, land, table, "2024-01-02").count() == 1
    ingest.compact_landing(spark, land, table, "2024-01-01", "2024-01-01")
    assert ingest.live_orders(spark, land, table, "2024-01-02").count() == 2


def test_duplicate_order_ids_are_kept(spark, tmp):
    # The producer's order ids repeat; nothing downstream may drop either row.
    src, land, bad, ckpt = (os.path.join(tmp, d) for d in ("in", "land", "bad", "ckpt"))
    _drop(src, "a.json", [_msg(1, order_id="ORDER_20240101_1234"),
                          _msg(2, order_id="ORDER_20240101_1234")])
    ingest.LandingSink(land, bad, ckpt).start(
        ingest.text_order_source(spark, src), available_now=True).awaitTermination()
    landed = ingest.read_landing(spark, land)
    assert landed.count() == 2 and landed.select("order_id").distinct().count() == 1
    assert realtime.kpi_last_hour(landed, dt.datetime(2024, 1, 1, 10, 30)).first()["orders_count"] == 2


def test_recounted_hours_survive_a_replayed_batch_and_late_rows(spark, tmp):
    src, land, bad, ckpt, out, hck = (os.path.join(tmp, d) for d in ("in", "land", "bad", "ckpt", "out", "hck"))
    sink = ingest.LandingSink(land, bad, ckpt)

    def ingest_and_count():
        sink.start(ingest.text_order_source(spark, src), available_now=True).awaitTermination()
        hourly.start_hourly_recount(spark, land, out, hck, available_now=True).awaitTermination()
        return {r["hour"].hour: r["orders_count"] for r in spark.read.parquet(out).collect()}

    _drop(src, "a.json", [_msg(i, timestamp=f"2024-01-01T10:{i:02d}:00") for i in range(10)])
    assert ingest_and_count() == {10: 10}
    # The batch was written but not committed: it is written again under new file names.
    sink.write_batch(spark.read.text(os.path.join(src, "a.json")), 0)
    _drop(src, "b.json", [_msg(20, timestamp="2024-01-01T18:00:00")])
    assert ingest_and_count() == {10: 10, 18: 1}
    _drop(src, "c.json", [_msg(21, timestamp="2024-01-01T10:59:59")])       # eight hours late
    assert ingest_and_count() == {10: 11, 18: 1}


def test_keyed_hours_survive_replays_late_rows_and_split_batches(spark, tmp):
    from ordermill.streaming import hour_state
    src, land, bad, ckpt, out, hck = (os.path.join(tmp, d) for d in ("in", "land", "bad", "ckpt", "out", "hck"))
    sink = ingest.LandingSink(land, bad, ckpt)

    def ingest_and_count(per_trigger=None):
        sink.start(ingest.text_order_source(spark, src), available_now=True).awaitTermination()
        hour_state.start_hourly_state(spark, land, out, hck, available_now=True,
                                      max_files_per_trigger=per_trigger).awaitTermination()
        table = spark.read.parquet(out)
        expected = {tuple(r) for r in realtime.hourly_series(ingest.read_landing(spark, land)).collect()}
        assert {tuple(r) for r in table.drop("hour_key").collect()} == expected
        return {(r["hour"].year, r["hour"].hour): r["orders_count"] for r in table.collect()}

    _drop(src, "a.json", [_msg(i, timestamp=f"2024-01-01T10:{i:02d}:00") for i in range(10)])
    assert ingest_and_count() == {(2024, 10): 10}
    # The batch is landed again under new file names, in two files that two micro-batches read.
    again = spark.read.text(os.path.join(src, "a.json")).repartition(2)
    sink.write_batch(again, 0)
    _drop(src, "b.json", [_msg(20, timestamp="2024-01-01T18:00:00")])
    assert ingest_and_count(per_trigger=1) == {(2024, 10): 10, (2024, 18): 1}
    before = {n: os.stat(os.path.join(out, n)).st_mtime_ns for n in os.listdir(out) if n.startswith("hour_key=")}
    _drop(src, "c.json", [_msg(21, timestamp="2023-01-01T10:59:59")])       # a year late
    assert ingest_and_count() == {(2023, 10): 1, (2024, 10): 10, (2024, 18): 1}
    after = {n: os.stat(os.path.join(out, n)).st_mtime_ns for n in before}
    assert before == after                              # only its own hour was touched


def test_partial_sums_keep_money_exact_and_nulls_apart(spark):
    from ordermill.streaming import hour_state
    t = dt.datetime(2024, 1, 1, 10, 30)
    rows = [(t, 0.1, 3, 0, t), (t, 0.2, 1, 0, t), (t, None, 2, 1, t), (None, 1.0, 1, 1, t)]
    df = spark.createDataFrame(rows, "order_timestamp timestamp_ntz, price double, quantity bigint, batch_id long, "
                                     "insert_timestamp timestamp_ntz").coalesce(1)
    got = {r["batch_id"]: (float(r["revenue"]), r["priced"], r["orders"], r["items"])
           for r in hour_state.partial_sums(df).collect()}
    assert got == {0: (0.5, 2, 2, 4), 1: (0.0, 0, 1, 2)}


def test_freshness_and_newest_hours_read_their_partitions_alone(spark, tmp):
    from ordermill.sources import files
    src, land, bad, ckpt, table = (os.path.join(tmp, d) for d in ("in", "land", "bad", "ckpt", "by_date"))
    assert ingest.newest_arrival(spark, land) is None
    sink = ingest.LandingSink(land, bad, ckpt, arrival=F.col("order_timestamp"))
    stamps = [f"2024-01-{d:02d}T{h:02d}:58:00" for d in range(1, 11) for h in (0, 5, 23)] + ["2024-01-10T23:59:30"]
    _drop(src, "a.json", [_msg(i, timestamp=t) for i, t in enumerate(stamps)])
    sink.start(ingest.text_order_source(spark, src), available_now=True).awaitTermination()
    newest = ingest.newest_arrival(spark, land)
    assert newest == "2024-01-10 23:59:30"
    fresh = realtime.recent_inserts(ingest.read_landing(spark, land), newest)
    assert fresh.first()["recent_orders"] == 2
    assert re.search(r"PartitionFilters: \[[^\]]*ingest_hour#\d+ >= 2024-01-10-23", plan_text(fresh))
    # across midnight the day before is read, too
    assert realtime.recent_inserts(ingest.read_landing(spark, land), "2024-01-10 00:02:00").first()["recent_orders"] == 5
    ingest.compact_landing(spark, land, table, "2024-01-01", "2024-01-10")
    dates = files.partition_values(spark, table, "order_date")
    assert dates == [f"2024-01-{d:02d}" for d in range(1, 11)]
    by_date = spark.read.parquet(table)
    for hours in (2, 4, 13, 100):
        got = realtime.newest_hours(by_date, dates, hours)
        assert got.collect() == realtime.hourly_metrics(by_date, hours).collect()
    few = plan_text(realtime.newest_hours(by_date, dates, 4))
    assert re.search(r"PartitionFilters: \[[^\]]*order_date#\d+ >= 2024-01-09", few)
