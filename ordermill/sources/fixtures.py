"""The driver's test tables seen through the staging contract.

The test data is a TPC-H-like schema plus an ``events`` table. These
functions derive, with plain projections and joins, the seven staging
tables and the landing table of streamed orders that the marts and the
dashboard read. Ids keep the test data's BIGINT. Every view is lazy, reads
only the columns it needs, and grows with the input tables.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.money import MONEY, RATE, money
from ordermill.functions.text import json_int

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation with its region name: the city / state of a customer or seller."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left")


def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    p = _place(spark, sf_dir)
    return (c.join(p, c.c_nationkey == p.n_nationkey, "left")
            .select(c.c_custkey.alias("customer_id"),
                    c.c_name.alias("customer_unique_id"),
                    p.n_name.alias("customer_city"),
                    p.r_name.alias("customer_state"),
                    c.c_nationkey.cast("string").alias("customer_zip_code_prefix")))


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    ts, status = F.col("o_orderdate"), F.col("o_orderstatus")
    shipped = status == "F"
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        ts.alias("order_purchase_timestamp"),
        F.when(status == "P", None).otherwise(ts + F.expr("INTERVAL 1 DAY"))
         .alias("order_approved_at"),
        F.when(shipped, ts + F.expr("INTERVAL 3 DAYS")).alias("order_delivered_carrier_date"),
        F.when(shipped, ts + F.expr("INTERVAL 7 DAYS")).alias("order_delivered_customer_date"),
        (ts + F.expr("INTERVAL 14 DAYS")).alias("order_estimated_delivery_date"))


def stg_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast(MONEY)
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        (price * F.col("l_tax").cast(RATE)).alias("freight_value"))


def stg_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        (F.col("l_extendedprice").cast(MONEY) * (F.lit(1) - F.col("l_discount").cast(RATE)))
        .alias("payment_value"))


def stg_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = json_int("props", "$.k")
    return ev.select(F.col("user_id").alias("order_id"), (k % 5 + 1).alias("review_score"))


def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    length, height, width = size + 10, size + 5, size + 2
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        (size * 100).cast("double").alias("product_weight_g"),
        length.cast("double").alias("product_length_cm"),
        height.cast("double").alias("product_height_cm"),
        width.cast("double").alias("product_width_cm"),
        (length * height * width).cast("double").alias("product_volume_cm3"),
        # Our own banding; the upstream rule is not published.
        F.when(size < 15, "light").when(size < 35, "medium").otherwise("heavy")
         .alias("weight_category"))


def stg_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    p = _place(spark, sf_dir)
    return (s.join(p, s.s_nationkey == p.n_nationkey, "left")
            .select(s.s_suppkey.alias("seller_id"),
                    p.n_name.alias("seller_city"),
                    p.r_name.alias("seller_state"),
                    s.s_nationkey.cast("string").alias("seller_zip_code_prefix")))


def stream_seller() -> Column:
    """Seller of an event's order: three users each, so sellers grow with users."""
    return F.expr("user_id div 3")


def order_message() -> Column:
    """The JSON order message of an ``events`` row, shaped like the producer's.

    Product and seller ids are wrapped in ``"`` the way the producer's naive
    CSV split leaves them; the decoder must strip them.
    """
    k = json_int("props", "$.k")
    quoted = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    return F.to_json(F.struct(
        F.concat(F.lit("ORDER_"), F.date_format("ts", "yyyyMMdd"), F.lit("_"),
                 F.col("event_id").cast("string")).alias("order_id"),
        F.concat(F.lit("CUST_"), F.col("user_id").cast("string")).alias("customer_id"),
        quoted(k).alias("product_id"),
        quoted(stream_seller()).alias("seller_id"),
        (k % 5 + 1).alias("quantity"),
        F.col("value").alias("price"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")))


def faulty_order_message() -> Column:
    """:func:`order_message` with planted faults: broken JSON, a missing key,
    a time that does not parse."""
    message, key = order_message(), F.col("event_id")
    return (F.when(key % 11 == 1, F.substring(message, 1, 70))
            .when(key % 13 == 2, F.regexp_replace(message, '"price":[^,]*,', ""))
            .when(key % 17 == 3, F.regexp_replace(message, '"timestamp":"[^"]*"', '"timestamp":"yesterday"'))
            .otherwise(message))


def topic_record() -> list[Column]:
    """The faulty order message of an ``events`` row as a topic holds it: keyed
    by customer, who stays in one of six partitions; the offset is the event's
    id, so offsets have gaps, as those of a compacted topic."""
    return [F.col("user_id").cast("string").cast("binary").alias("key"),
            faulty_order_message().cast("binary").alias("value"),
            F.pmod("user_id", F.lit(6)).cast("int").alias("partition"), F.col("event_id").cast("long").alias("offset")]


def orders_from_events(ev: DataFrame) -> DataFrame:
    """Landing-table rows from ``events`` rows; works on a stream too.

    ``insert_timestamp`` (arrival time) is not in the test data; we take the
    event time, so freshness checks look at the newest events.
    """
    k = json_int("props", "$.k")
    return ev.select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        k.alias("product_id"),
        stream_seller().alias("seller_id"),
        (k % 5 + 1).alias("quantity"),
        money("value").alias("price"),
        F.col("ts").alias("order_timestamp"),
        F.col("ts").alias("insert_timestamp"))


def raw_orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table of streamed orders, one row per event."""
    return orders_from_events(table(spark, sf_dir, "events"))


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """``events`` replayed as a file stream (the schema comes from the footer)."""
    schema = table(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema)
            .option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", str(max_files_per_trigger))
            .parquet(sf_dir))


STAGING = {
    "stg_customers": stg_customers,
    "stg_orders": stg_orders,
    "stg_order_items": stg_order_items,
    "stg_order_payments": stg_order_payments,
    "stg_order_reviews": stg_order_reviews,
    "stg_products": stg_products,
    "stg_sellers": stg_sellers,
}


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All seven staging views, keyed by their warehouse names."""
    return {name: build(spark, sf_dir) for name, build in STAGING.items()}


# --- exported files with planted faults ------------------------------------

CSV_FILES = {
    "orders.csv": ("raw_orders", T.StructType([
        T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
        T.StructField("order_status", T.StringType()), T.StructField("total", T.DecimalType(18, 2)),
        T.StructField("ordered_at", T.TimestampNTZType()), T.StructField("note", T.StringType())])),
    "order_items.csv": ("raw_order_items", T.StructType([
        T.StructField("order_id", T.LongType()), T.StructField("line", T.LongType()),
        T.StructField("product_id", T.LongType()), T.StructField("price", T.DecimalType(18, 2))])),
}


def _fields(*columns) -> Column:
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def write_csv_exports(spark: SparkSession, sf_dir: str, directory: str, gap: str = " ") -> None:
    """``orders`` and ``lineitem`` as folders of CSV files, one per entry of
    ``CSV_FILES``: quoted notes hold commas and quotes, and ``gap``, which may
    be a line end; some rows are short, some long and some mistyped."""
    key = F.col("o_orderkey")
    note = F.concat(F.lit(f'"ships ""soon"",{gap}'), F.col("o_orderpriority"), F.lit('"'))
    head = [key, F.col("o_custkey"), F.col("o_orderstatus")]
    tail = [F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), note]
    total = F.col("o_totalprice").cast("decimal(18,2)")
    orders = table(spark, sf_dir, "orders").select(
        F.when(key % 11 == 1, _fields(*head))
        .when(key % 13 == 2, _fields(*head, F.lit("n/a"), *tail))
        .when(key % 17 == 3, _fields(*head, total, *tail, F.lit("extra")))
        .otherwise(_fields(*head, total, *tail)).alias("line"))
    line = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 19 == 4, "first").otherwise(F.col("l_linenumber").cast("string"))
    items = table(spark, sf_dir, "lineitem").select(_fields(
        F.col("l_orderkey"), line, F.col("l_partkey"), F.col("l_extendedprice").cast("decimal(18,2)")).alias("line"))
    for lines, (name, (_, schema)) in zip((orders, items), CSV_FILES.items()):
        # lines as they stand; the first of each partition, and so of its file, brings the header
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        header = F.when(first, F.lit(",".join(schema.names) + "\n")).otherwise("")
        lines.select(F.concat(header, "line")).write.text(os.path.join(directory, name))


def write_category_names(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A lookup file of the products' categories: one line each with a readable
    name; categories that start with PROMO have none, so their lines are short."""
    kind = F.col("p_type")
    line = F.when(kind.startswith("PROMO"), kind).otherwise(
        F.concat(kind, F.lit(',"'), F.initcap(F.lower(kind)), F.lit('"')))
    lines = table(spark, sf_dir, "part").where(kind.isNotNull()).select(line.alias("line")).distinct().coalesce(1)
    first = F.monotonically_increasing_id() == 0
    header = F.when(first, F.lit("product_category_name,product_category_name_english\n")).otherwise("")
    lines.select(F.concat(header, "line")).write.text(path)
