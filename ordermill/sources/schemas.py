"""Explicit schemas for every table the order analytics touch.

Staging tables arrive from an upstream cleaning layer that is outside this
library; their column contract (only the columns the marts read) is fixed
here so that loads never infer types. Ids are strings in the raw files; callers that key on integers (the
test tables do) may pass their own schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


STG_CUSTOMERS = _schema(
    ("customer_id", S), ("customer_unique_id", S), ("customer_city", S),
    ("customer_state", S), ("customer_zip_code_prefix", S))

STG_ORDERS = _schema(
    ("order_id", S), ("customer_id", S), ("order_status", S),
    ("order_purchase_timestamp", TS), ("order_approved_at", TS),
    ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
    ("order_estimated_delivery_date", TS))

STG_ORDER_ITEMS = _schema(
    ("order_id", S), ("product_id", S), ("seller_id", S), ("price", D),
    ("freight_value", D))

STG_ORDER_PAYMENTS = _schema(
    ("order_id", S), ("payment_sequential", I), ("payment_type", S),
    ("payment_value", D))

STG_ORDER_REVIEWS = _schema(("order_id", S), ("review_score", I))

STG_PRODUCTS = _schema(
    ("product_id", S), ("product_category_name", S), ("product_weight_g", D),
    ("product_length_cm", D), ("product_height_cm", D), ("product_width_cm", D),
    ("product_volume_cm3", D), ("weight_category", S))

STG_SELLERS = _schema(
    ("seller_id", S), ("seller_city", S), ("seller_state", S),
    ("seller_zip_code_prefix", S))

CATEGORY_TRANSLATION = _schema(
    ("product_category_name", S), ("product_category_name_english", S))

# Landing table of streamed orders. ``batch_id`` is the partition column the
# stream sink writes (one folder per micro-batch, replaced on replay).
RAW_ORDERS_STREAM = _schema(
    ("order_id", S), ("customer_id", S), ("product_id", S), ("seller_id", S),
    ("quantity", L), ("price", D), ("order_timestamp", TS), ("insert_timestamp", TS))

# Where a message stood in its topic; null for messages of other sources.
POSITION = _schema(("message_key", S), ("topic_partition", I), ("topic_offset", L))

# The landing table as stored: the stream sink's one folder per micro-batch,
# in it one per hour of arrival ('yyyy-MM-dd-HH').
LANDING_TABLE = T.StructType(RAW_ORDERS_STREAM.fields + POSITION.fields
                             + [T.StructField("batch_id", L, True), T.StructField("ingest_hour", S, True)])

# A topic recorded in files, as the topic reader gives it.
TOPIC_RECORD = _schema(("key", T.BinaryType()), ("value", T.BinaryType()), ("partition", I), ("offset", L))

# One JSON order message as the producer writes it; ``timestamp`` is
# ISO-8601 text without zone, parsed after decoding.
ORDER_MESSAGE = _schema(
    ("order_id", S), ("customer_id", S), ("product_id", S), ("seller_id", S),
    ("quantity", L), ("price", D), ("timestamp", S))

# Raw CSV layouts of the public order dataset the loads expect (positional:
# the header line is skipped, not matched). File columns in
# file order.
RAW_CUSTOMERS = _schema(
    ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
    ("customer_city", S), ("customer_state", S))
RAW_ORDERS = _schema(
    ("order_id", S), ("customer_id", S), ("order_status", S),
    ("order_purchase_timestamp", TS), ("order_approved_at", TS),
    ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
    ("order_estimated_delivery_date", TS))
RAW_ORDER_ITEMS = _schema(
    ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
    ("shipping_limit_date", TS), ("price", D), ("freight_value", D))
RAW_PRODUCTS = _schema(
    ("product_id", S), ("product_category_name", S), ("product_name_lenght", I),
    ("product_description_lenght", I), ("product_photos_qty", I), ("product_weight_g", D),
    ("product_length_cm", D), ("product_height_cm", D), ("product_width_cm", D))
RAW_SELLERS = _schema(
    ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S))
RAW_ORDER_REVIEWS = _schema(
    ("review_id", S), ("order_id", S), ("review_score", I), ("review_comment_title", S),
    ("review_comment_message", S), ("review_creation_date", TS),
    ("review_answer_timestamp", TS))
RAW_ORDER_PAYMENTS = _schema(
    ("order_id", S), ("payment_sequential", I), ("payment_type", S),
    ("payment_installments", I), ("payment_value", D))

# File -> (raw table, layout). The eight files of a daily load.
RAW_FILES = {
    "olist_customers_dataset.csv": ("raw_customers", RAW_CUSTOMERS),
    "olist_orders_dataset.csv": ("raw_orders", RAW_ORDERS),
    "olist_order_items_dataset.csv": ("raw_order_items", RAW_ORDER_ITEMS),
    "olist_products_dataset.csv": ("raw_products", RAW_PRODUCTS),
    "olist_sellers_dataset.csv": ("raw_sellers", RAW_SELLERS),
    "olist_order_reviews_dataset.csv": ("raw_order_reviews", RAW_ORDER_REVIEWS),
    "olist_order_payments_dataset.csv": ("raw_order_payments", RAW_ORDER_PAYMENTS),
    "product_category_name_translation.csv": ("raw_product_category_name_translation",
                                              CATEGORY_TRANSLATION),
}

# Files whose quoted texts span lines. Their records are found first, so the
# others, of one record per line, are read without that and split.
MULTI_LINE_FILES = ("olist_order_reviews_dataset.csv",)

# Files a daily load cannot start without. Fixed values.
REQUIRED_FILES = ("olist_customers_dataset.csv", "olist_orders_dataset.csv",
                  "olist_products_dataset.csv", "olist_sellers_dataset.csv")
