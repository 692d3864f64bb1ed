"""Named queries over the test tables: one per operator of the survey.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built
from the parquet tables in ``sf_dir`` through the staging views of
``ordermill.sources.fixtures``. Names and column aliases match the SQL in
``ordermill.plans.oracle``. Dashboard queries take ``as_of`` = the newest
order time (a literal, found by a job of its own), so results do not depend
on the clock. Loads, streams and landed tables run when their query is called.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions import money as fm
from ordermill.functions import time as tf
from ordermill.operators import distinct_bitmaps, footers, marts, quality, realtime
from ordermill.operators.unified import unified_orders as _unified
from ordermill.plans import dashboard, refresh, sql_functions
from ordermill.plans.daily import NOT_NULL_TESTS, UNIQUE_TESTS, write_marts
from ordermill.session import shared_dir
from ordermill.sources import bucketed, files
from ordermill.sources import fixtures as fx
from ordermill.sources.csv_load import load_csv
from ordermill.sources.schemas import RAW_FILES
from ordermill.streaming import hour_state, hourly, ingest

Query = Callable[[SparkSession, str], DataFrame]


# --- marts ----------------------------------------------------------------

def fact_orders(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fact_orders(fx.stg_orders(spark, sf), fx.stg_order_items(spark, sf),
                             fx.stg_order_payments(spark, sf), fx.stg_order_reviews(spark, sf))


def fact_orders_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The order fact over staging tables that lie in buckets of order_id."""
    stg, root = fx.staging(spark, sf), shared_dir(spark, "bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = bucketed.write_bucketed(spark, {name: stg[name] for name in bucketed.ORDER_TABLES}, "order_id",
                                     buckets, root, suffix="_" + os.path.basename(root))
    return bucketed.fact_orders_of(spark, tables, root, buckets)


def dim_sellers(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_sellers(fx.stg_sellers(spark, sf), fx.stg_order_items(spark, sf))


def dim_products(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_products(fx.stg_products(spark, sf), fx.stg_order_items(spark, sf))


def dim_customers(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_customers(fx.stg_customers(spark, sf), fx.stg_orders(spark, sf))


def _marts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"dim_customers": dim_customers(spark, sf), "dim_products": dim_products(spark, sf),
            "dim_sellers": dim_sellers(spark, sf), "fact_orders": fact_orders(spark, sf)}


def _earlier(df: DataFrame, key: str, kept: dict[str, object]) -> DataFrame:
    """An earlier state of a staging table: a seventh of the keys not there
    yet, an eleventh with other values, and rows that were removed since."""
    k = F.xxhash64(key)
    altered = F.pmod(k, F.lit(11)) == 3
    was = df.where(F.coalesce(F.pmod(k, F.lit(7)) != 2, F.lit(True))).select(*[
        F.when(altered, F.lit(kept[c]).cast(t)).otherwise(F.col(c)).alias(c) if c in kept else F.col(c)
        for c, t in df.dtypes])
    removed = df.where(F.pmod(k, F.lit(13)) == 5).withColumn(key, -F.col(key) - 1)
    return was.unionByName(removed)


def _refreshed(name: str) -> Query:
    """The mart built over an earlier state, then refreshed by the changes."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        other = {"order_status": "X", "price": 1, "payment_value": 2, "review_score": 3, "customer_city": "was",
                 "product_category_name": "was", "seller_city": "was"}
        _, sources, _ = refresh.MARTS[name]
        all_stg = fx.staging(spark, sf)
        stg = {s: all_stg[s] for s in sources}
        keys = {"stg_customers": "customer_id", "stg_products": "product_id", "stg_sellers": "seller_id"}
        before = {s: _earlier(df, keys.get(s, "order_id"), other) for s, df in stg.items()}
        root = shared_dir(spark, "refreshed")
        refresh.build(before, name, root)
        changes = {s: refresh.differences(before[s], stg[s]) for s in sources}
        return refresh.refresh(spark, stg, changes, name, root)
    run.__name__ = f"{name}_refreshed"
    return run


# --- single operators -----------------------------------------------------

def price_range(spark: SparkSession, sf: str) -> DataFrame:
    # Mean part prices lie between 33k and 76k here, so cut points inside
    # that range exercise all three bands.
    return (marts.dim_products(fx.stg_products(spark, sf), fx.stg_order_items(spark, sf),
                               low_cut=50000, high_cut=55000)
            .select("product_id", "avg_price", "price_range"))


def order_left_join_chain(spark: SparkSession, sf: str) -> DataFrame:
    j = marts.order_left_join_chain(fx.stg_orders(spark, sf), fx.stg_order_items(spark, sf),
                                    fx.stg_order_payments(spark, sf),
                                    fx.stg_order_reviews(spark, sf))
    return j.select("order_id", "customer_id", "total_items",
                    fm.to_double(F.col("total_payment")).alias("total_payment"),
                    "payment_installments", "review_count")


def two_distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return (marts.product_item_metrics(fx.stg_order_items(spark, sf))
            .select("product_id", "total_orders", "total_sellers"))


def order_item_arrays(spark: SparkSession, sf: str) -> DataFrame:
    # items of no order belong to no array; they must not meet in one task
    items = fx.stg_order_items(spark, sf).where(F.col("order_id").isNotNull())
    return marts.order_item_metrics(items).select("order_id", "product_ids", "seller_ids")


def latest_attributes(spark: SparkSession, sf: str) -> DataFrame:
    segment = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    customers = fx.stg_customers(spark, sf).join(segment, "customer_id")
    return marts.latest_customer_per(customers, fx.stg_orders(spark, sf), "segment")


def unified_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _unified(fx.stg_orders(spark, sf), fx.stg_order_items(spark, sf),
                    fx.raw_orders_stream(spark, sf))


def money_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue and mean price where prices reach 1e11 and have parts of a cent."""
    value, kind = F.col("price").cast("double"), F.col("customer_id") % 7
    price = (F.when(kind == 0, F.round(value) * 1e9).when(kind == 1, F.round(value) / 1000)
             .otherwise(value))
    orders = fx.raw_orders_stream(spark, sf).withColumn("price", fm.money(price))
    return orders.groupBy("quantity").agg(
        fm.to_double(fm.exact_sum(F.col("price") * F.col("quantity"))).alias("revenue"),
        fm.rounded_mean("price", 2).alias("avg_value"), fm.exact_mean("price").alias("mean_price"))


def date_functions(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.raw_orders_stream(spark, sf)
    as_of = realtime.latest_order_time(o)
    ts = F.col("order_timestamp")
    return o.select(
        "order_id",
        tf.hour_bucket(ts).alias("order_hour"),
        F.to_date(ts).cast("string").alias("order_date"),
        tf.day_name(ts).alias("day_of_week"),
        tf.hour_of_day(ts).alias("hour_of_day"),
        tf.days_between(ts, as_of).alias("days_before_as_of"),
        tf.within_last(ts, as_of, 1, "hour").alias("in_last_hour"),
        F.round("price", 1).cast("double").alias("price_rounded"))


def scalar_functions(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.stg_order_items(spark, sf)
    price, freight = F.col("price"), F.col("freight_value")
    return items.select(
        "order_id", "seller_id",
        F.when(price < 10000, "low").when(price < 50000, "mid").otherwise("high")
         .alias("price_band"),
        F.round(price + freight, 2).cast("double").alias("gross_value"),
        F.abs(freight - price).cast("double").alias("abs_gap"),
        F.coalesce(freight, F.lit(0)).cast("double").alias("freight_or_zero"),
        ((price <= 0) | freight.isNull()).alias("flagged"))


def json_order_decode(spark: SparkSession, sf: str) -> DataFrame:
    messages = fx.table(spark, sf, "events").select(fx.order_message().alias("value"))
    decoded = ingest.decode_orders(messages)
    return decoded.where(F.col("reject_reason").isNull()).select(*ingest.LANDING_COLUMNS)


def stream_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Run the streaming hourly twin over ``events`` to completion, read it back."""
    orders = fx.orders_from_events(fx.events_stream(spark, sf))
    out = shared_dir(spark, "stream_hourly", "snapshot")
    q = hourly.start_hourly_snapshot(hourly.hourly_stream(orders), out,
                                     shared_dir(spark, "stream_hourly", "checkpoint"),
                                     available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out)


def stream_hourly_live(spark: SparkSession, sf: str) -> DataFrame:
    """The live hourly table, from keyed state, after two rounds of ingest; the
    second brings a third of the orders late, over the whole time span."""
    events = fx.table(spark, sf, "events")
    late = F.col("event_id") % 3 == 0
    root = shared_dir(spark, "stream_hourly_live")
    folder = lambda name: os.path.join(root, name)
    sink = ingest.LandingSink(folder("landing"), folder("rejects"), folder("ingest"))
    files.ensure_landing_table(spark, sink.landing)
    for part in (events.where(~late), events.where(late)):
        part.select(fx.order_message()).write.mode("append").text(folder("messages"))
        sink.start(ingest.text_order_source(spark, folder("messages")), available_now=True).awaitTermination()
        hour_state.start_hourly_state(spark, sink.landing, folder("hourly"), folder("state"),
                                      available_now=True).awaitTermination()
    return spark.read.parquet(folder("hourly")).drop("hour_key")


# --- ingest: the test tables as files with planted faults, loaded back -------

def _landed(spark: SparkSession, sf: str) -> ingest.LandingSink:
    root = shared_dir(spark, "landed")
    messages = fx.table(spark, sf, "events").select(fx.faulty_order_message())
    messages.write.text(os.path.join(root, "messages"))
    sink = ingest.LandingSink(*[os.path.join(root, x) for x in ("landing", "rejects", "checkpoint")])
    source = ingest.text_order_source(spark, os.path.join(root, "messages"))
    sink.start(source, available_now=True).awaitTermination()
    return sink


def _landed_topic(spark: SparkSession, sf: str) -> ingest.LandingSink:
    """A recorded topic of six partitions, landed in two rounds; between them
    the checkpoint is lost, so the second is given the whole topic again."""
    root = shared_dir(spark, "landed_topic")
    topic, landing, rejects, first, second = [
        os.path.join(root, x) for x in ("topic", "landing", "rejects", "checkpoint", "new_checkpoint")]
    events = fx.table(spark, sf, "events")
    middle = events.agg(F.avg("event_id")).first()[0]
    for part, checkpoint in ((F.col("event_id") <= middle, first), (F.col("event_id") > middle, second)):
        events.where(part).select(*fx.topic_record()).write.mode("append").parquet(topic)
        sink = ingest.LandingSink(landing, rejects, checkpoint)
        sink.start(ingest.recorded_topic_source(spark, topic), available_now=True).awaitTermination()
    return sink


def landed_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Where each message stood in its topic, and whether it landed or was rejected."""
    sink = _landed_topic(spark, sf)
    good = ingest.read_landing(spark, sink.landing).select(*ingest.POSITION_COLUMNS, F.lit("landed").alias("outcome"))
    return good.unionByName(spark.read.parquet(sink.quarantine).select(
        *ingest.POSITION_COLUMNS, F.col("reject_reason").alias("outcome")))


def landed_position_faults(spark: SparkSession, sf: str) -> DataFrame:
    sink = _landed_topic(spark, sf)
    return ingest.position_faults(ingest.read_landing(spark, sink.landing), spark.read.parquet(sink.quarantine))


def _landed_history(spark: SparkSession, sf: str) -> str:
    """The landing table of all events, each arrived when it was ordered."""
    root = shared_dir(spark, "landed_history")
    landing, rejects, checkpoint, messages = [os.path.join(root, x) for x in ("landing", "rejects", "checkpoint", "messages")]
    fx.table(spark, sf, "events").select(fx.order_message()).write.text(messages)
    sink = ingest.LandingSink(landing, rejects, checkpoint, arrival=F.col("order_timestamp"))
    sink.start(ingest.text_order_source(spark, messages), available_now=True).awaitTermination()
    return landing


def landed_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """The freshness check over a landing table: the last hour's folders alone."""
    landing = _landed_history(spark, sf)
    newest = ingest.newest_arrival(spark, landing)
    return realtime.recent_inserts(ingest.read_landing(spark, landing), newest, minutes=5)


def landed_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """When each order arrived, and the hour of arrival that its folder is of."""
    return ingest.read_landing(spark, _landed_history(spark, sf)).select("order_id", "insert_timestamp", "ingest_hour")


def landed_hourly_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The newest hours of the landed orders by date, found walking back."""
    landing = _landed_history(spark, sf)
    dates = ingest.read_landing(spark, landing).agg(*[f(F.to_date("order_timestamp")).cast("string")
                                                      for f in (F.min, F.max)]).first()
    by_date = shared_dir(spark, "orders_by_date")
    ingest.compact_landing(spark, landing, by_date, *dates)
    return realtime.newest_hours(spark.read.parquet(by_date), files.partition_values(spark, by_date, "order_date"))


def landing_rows(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.read_landing(spark, _landed(spark, sf).landing).select(*ingest.LANDING_COLUMNS)


def landing_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejects = spark.read.parquet(_landed(spark, sf).quarantine)
    return rejects.select(F.regexp_extract("raw", r"ORDER_\d+_(\d+)", 1).cast("long").alias("event_id"),
                          "reject_reason")


def _loaded(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """The report of a load of the exported files, and the folder it filled."""
    root = shared_dir(spark, "csv_exports")
    fx.write_csv_exports(spark, sf, os.path.join(root, "raw"))
    wanted = fx.CSV_FILES | {"absent.csv": ("absent", fx.CSV_FILES["orders.csv"][1])}
    report = files.load_files(spark, os.path.join(root, "raw"), os.path.join(root, "tables"),
                              os.path.join(root, "rejects"), wanted, multi_line=())
    return report, root


def load_report(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, sf)[0]


def csv_load_good(spark: SparkSession, sf: str) -> DataFrame:
    orders = spark.read.parquet(os.path.join(_loaded(spark, sf)[1], "tables", "raw_orders"))
    return orders.withColumn("total", F.col("total").cast("double"))


def csv_load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    root = _loaded(spark, sf)[1]
    parts = [spark.read.parquet(os.path.join(root, "rejects", name)).select(
                F.lit(name).alias("table_name"), F.col("_corrupt_record").alias("line"))
             for name, _ in fx.CSV_FILES.values()]
    return parts[0].unionByName(parts[1])


def category_names(spark: SparkSession, sf: str) -> DataFrame:
    """The products with the names that a lookup file, exported and loaded as
    the daily load does it, gives their categories."""
    root = shared_dir(spark, "lookup")
    name = "product_category_name_translation.csv"
    fx.write_category_names(spark, sf, os.path.join(root, "raw", name))
    files.require_inputs(spark, os.path.join(root, "raw"), (name,))
    files.load_files(spark, os.path.join(root, "raw"), os.path.join(root, "tables"), os.path.join(root, "rejects"),
                     {name: RAW_FILES[name]})
    lookup = spark.read.parquet(os.path.join(root, "tables", RAW_FILES[name][0]))
    return (fx.stg_products(spark, sf).select("product_id", "product_category_name")
            .join(lookup, "product_category_name", "left"))


def _loaded_lines(spark: SparkSession, sf: str):
    """The orders with a line end in each quoted note, loaded in many tasks."""
    root = shared_dir(spark, "csv_quoted_lines")
    fx.write_csv_exports(spark, sf, root, gap="\n")
    return load_csv(spark, os.path.join(root, "orders.csv"), fx.CSV_FILES["orders.csv"][1])


def csv_quoted_lines_good(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded_lines(spark, sf).good.withColumn("total", F.col("total").cast("double"))


def csv_quoted_lines_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded_lines(spark, sf).rejected.select(F.col("_corrupt_record").alias("line"))


# --- dashboard ------------------------------------------------------------

def _stream(spark: SparkSession, sf: str) -> tuple[DataFrame, F.Column | str]:
    o = fx.raw_orders_stream(spark, sf)
    return o, realtime.newest_order_time(o)


def kpi_last_hour(spark: SparkSession, sf: str) -> DataFrame:
    o, as_of = _stream(spark, sf)
    return realtime.kpi_last_hour(o, as_of)


def _seller_bitmaps(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(orders, seller numbers, hourly bitmaps), kept up in two batches: the
    second numbers the sellers that are new and merges its hours."""
    orders = fx.raw_orders_stream(spark, sf)
    late = F.coalesce(F.pmod(F.xxhash64("order_id"), F.lit(3)) == 1, F.lit(False))
    numbers = hourly = None
    for batch in (orders.where(~late), orders.where(late)):
        root = shared_dir(spark, "seller_bitmaps")
        distinct_bitmaps.number_ids(batch, "seller_id", numbers).write.parquet(os.path.join(root, "numbers"))
        numbers = spark.read.parquet(os.path.join(root, "numbers"))
        found = distinct_bitmaps.hourly_bitmaps(batch, "seller_id", numbers)
        (found if hourly is None else distinct_bitmaps.merge(hourly, found)).write.parquet(os.path.join(root, "hours"))
        hourly = spark.read.parquet(os.path.join(root, "hours"))
    return orders, numbers, hourly


def trailing_sellers(spark: SparkSession, sf: str) -> DataFrame:
    _, _, hourly = _seller_bitmaps(spark, sf)
    return distinct_bitmaps.trailing_days(hourly, 7).select(
        "day", F.col("ids").alias("sellers_count"), F.col("trailing_ids").alias("week_sellers_count"))


def kpi_sellers(spark: SparkSession, sf: str) -> DataFrame:
    orders, numbers, hourly = _seller_bitmaps(spark, sf)
    as_of = tf.resolve_as_of(realtime.newest_order_time(orders))
    counts = [distinct_bitmaps.ids_since(orders, hourly, "seller_id", numbers, as_of - tf.interval(n, unit),
                                         "sellers_count").select(F.lit(f"{n} {unit}").alias("period"), "sellers_count")
              for n, unit in ((1, "hour"), (1, "day"), (7, "day"), (90, "day"))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def hourly_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return realtime.hourly_metrics(fx.raw_orders_stream(spark, sf))


def _top(period: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        o, as_of = _stream(spark, sf)
        return realtime.top_sellers(o, period, as_of)
    run.__name__ = f"top_sellers_{period}"
    return run


def weekday_hour_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    return realtime.weekday_hour_heatmap(fx.raw_orders_stream(spark, sf))


def sales_spike_hours(spark: SparkSession, sf: str) -> DataFrame:
    return realtime.sales_spike_hours(fx.raw_orders_stream(spark, sf))


def sales_spike_status(spark: SparkSession, sf: str) -> DataFrame:
    o, as_of = _stream(spark, sf)
    return realtime.sales_spike_status(o, as_of)


def monitor_status(spark: SparkSession, sf: str) -> DataFrame:
    o, as_of = _stream(spark, sf)
    return realtime.monitor_status(o, as_of)


def sales_spike_alert(spark: SparkSession, sf: str) -> DataFrame:
    """The status as of the newest hour that is a spike."""
    o = fx.raw_orders_stream(spark, sf)
    spikes = realtime.sales_spike_hours(o).where("is_spike").withColumnRenamed("hour", realtime.TS)
    return realtime.sales_spike_status(o, realtime.newest_order_time(spikes))


def _sql_functions(spark: SparkSession, **views: DataFrame) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    sql_functions.register_functions(spark, list(views))


def _sql_status(function: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        orders = fx.raw_orders_stream(spark, sf)
        _sql_functions(spark, raw_orders_stream=orders)
        return spark.sql(f"SELECT * FROM {function}(CAST(:as_of AS TIMESTAMP_NTZ))",
                         {"as_of": realtime.newest_order_time(orders)})
    run.__name__ = f"sql_{function}"
    return run


def sql_not_positive(spark: SparkSession, sf: str) -> DataFrame:
    _sql_functions(spark, fact_orders=_defective_marts(spark, sf)["fact_orders"])
    return spark.sql("SELECT order_id, value AS total_order_value FROM fact_orders_not_positive('total_order_value')")


def dashboard_panels(spark: SparkSession, sf: str) -> DataFrame:
    o, as_of = _stream(spark, sf)
    return dashboard.as_rows(dashboard.panels(o, as_of, "week"))


# --- data quality ---------------------------------------------------------

def _defective_marts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The marts with planted faults, by their keys: repeated, missing and null
    keys, null attributes and times, totals that do not add up."""
    m = _marts(spark, sf)

    def twice(df: DataFrame, fault) -> DataFrame:
        copies = F.sequence(F.lit(1), F.when(fault, 2).otherwise(1))
        return df.withColumn("_copy", F.explode(copies)).drop("_copy")

    def spoil(df: DataFrame, **faults) -> DataFrame:
        return df.select(*[faults[c].alias(c) if c in faults else F.col(c) for c in df.columns])

    def null_if(fault, column: str):
        return F.when(~fault, F.col(column))

    customer, order, product = F.col("customer_id"), F.col("order_id"), F.col("product_id")
    total = F.col("total_order_value")
    customers = twice(m["dim_customers"].where(customer % 97 != 3), customer % 89 == 5)
    products = twice(m["dim_products"], product % 41 == 1)
    fact = twice(m["fact_orders"], order % 109 == 7)
    return m | {
        "dim_customers": spoil(customers, customer_id=null_if(customer % 79 == 8, "customer_id"),
                               customer_city=null_if(customer % 83 == 7, "customer_city")),
        "dim_products": spoil(products, product_id=null_if(product % 37 == 2, "product_id"),
                              product_category_name=null_if(product % 43 == 2, "product_category_name")),
        "fact_orders": spoil(
            fact, order_id=null_if(order % 113 == 9, "order_id"),
            customer_id=null_if(order % 107 == 6, "customer_id"),
            order_purchase_timestamp=null_if(order % 101 == 4, "order_purchase_timestamp"),
            total_order_value=F.when(order % 103 == 5, total + 1).when(order % 127 != 10, total))}


def _unique(m: dict[str, DataFrame]) -> DataFrame:
    parts = [quality.unique_violations(m[model], col).select(
                F.lit(model).alias("model"), F.lit(col).alias("column_name"),
                quality.as_text("unique_field").alias("unique_field"), "n_records")
             for model, col in UNIQUE_TESTS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Each check over a set of marts.
_CHECKS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "dq_unique": _unique,
    "dq_not_null": lambda m: quality.not_null_counts(m, NOT_NULL_TESTS),
    "dq_positive": lambda m: (m["fact_orders"].transform(quality.positive_value_violations, "total_order_value")
                              .select("order_id", "total_order_value")),
    "dq_price_consistency": lambda m: quality.price_consistency_violations(m["fact_orders"]),
    "dq_row_counts": quality.row_counts,
    "dq_duplicate_keys": lambda m: quality.duplicate_key_count(m["dim_customers"], "customer_id"),
    "dq_orphans": lambda m: quality.orphan_count(m["fact_orders"], m["dim_customers"], "customer_id"),
    "dq_null_counts": lambda m: quality.null_counts(m["fact_orders"], {
        "null_customers": "customer_id", "null_dates": "order_purchase_timestamp"}),
    "dq_report": lambda m: quality.quality_report(m["fact_orders"], m["dim_customers"]),
}


def _check(name: str, source: Callable[[SparkSession, str], dict[str, DataFrame]]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _CHECKS[name](source(spark, sf))
    run.__name__ = name
    return run


def written_extents(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, least and greatest key of the written marts, from their footers."""
    root = shared_dir(spark, "extents")
    write_marts(spark, _marts(spark, sf), root)
    return footers.extents(spark, {name: (os.path.join(root, name), key) for name, (key, _, _) in refresh.MARTS.items()})


def dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    o, as_of = _stream(spark, sf)
    return realtime.recent_inserts(o, as_of, minutes=5)


QUERIES: dict[str, Query] = {
    "fact_orders": fact_orders,
    "fact_orders_bucketed": fact_orders_bucketed,
    "money_extremes": money_extremes,
    "dim_sellers": dim_sellers,
    "dim_products": dim_products,
    "dim_customers": dim_customers,
    **{f"{name}_refreshed": _refreshed(name) for name in refresh.MARTS},
    "price_range": price_range,
    "order_left_join_chain": order_left_join_chain,
    "two_distinct_counts": two_distinct_counts,
    "order_item_arrays": order_item_arrays,
    "latest_attributes": latest_attributes,
    "unified_orders": unified_orders,
    "date_functions": date_functions,
    "scalar_functions": scalar_functions,
    "json_order_decode": json_order_decode,
    "stream_hourly": stream_hourly,
    "stream_hourly_live": stream_hourly_live,
    "landing_rows": landing_rows,
    "landing_rejects": landing_rejects,
    "landed_positions": landed_positions,
    "landed_position_faults": landed_position_faults,
    "csv_load_good": csv_load_good,
    "csv_load_rejects": csv_load_rejects,
    "load_report": load_report,
    "category_names": category_names,
    "csv_quoted_lines_good": csv_quoted_lines_good,
    "csv_quoted_lines_rejects": csv_quoted_lines_rejects,
    "kpi_last_hour": kpi_last_hour,
    "kpi_sellers": kpi_sellers,
    "trailing_sellers": trailing_sellers,
    "hourly_metrics": hourly_metrics,
    "top_sellers_hour": _top("hour"),
    "top_sellers_today": _top("today"),
    "top_sellers_week": _top("week"),
    "weekday_hour_heatmap": weekday_hour_heatmap,
    "sales_spike_hours": sales_spike_hours,
    "sales_spike_status": sales_spike_status,
    "sales_spike_alert": sales_spike_alert,
    "monitor_status": monitor_status,
    **{f"sql_{f}": _sql_status(f) for f in ("sales_spike_status", "kpi_last_hour", "recent_inserts")},
    "sql_not_positive": sql_not_positive,
    "dashboard_panels": dashboard_panels,
    **{name: _check(name, _marts) for name in _CHECKS},
    **{f"{name}_defects": _check(name, _defective_marts) for name in _CHECKS},
    "written_extents": written_extents,
    "dq_freshness": dq_freshness,
    "landed_freshness": landed_freshness,
    "landed_arrivals": landed_arrivals,
    "landed_hourly_metrics": landed_hourly_metrics,
}
