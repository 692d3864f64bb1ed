"""Historical and live orders in one row shape.

The reference claims both flows feed the same final model but never builds
it; this is our small, separately marked version. Historical rows are order
items (one row per item, quantity 1) with the order's customer and purchase
time; live rows come from the landing table as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = ("source", "order_id", "customer_id", "product_id", "seller_id", "quantity",
           "price", "order_timestamp")


def unified_orders(orders: DataFrame, items: DataFrame, stream: DataFrame) -> DataFrame:
    hist = (items.join(orders.select("order_id", "customer_id", "order_purchase_timestamp"),
                       "order_id", "left")
            .select(F.lit("historical").alias("source"), "order_id", "customer_id",
                    "product_id", "seller_id", F.lit(1).cast("long").alias("quantity"),
                    F.col("price").cast("double").alias("price"),
                    F.col("order_purchase_timestamp").alias("order_timestamp")))
    live = stream.select(F.lit("stream").alias("source"), "order_id", "customer_id",
                         "product_id", "seller_id", F.col("quantity").cast("long"),
                         F.col("price").cast("double").alias("price"), "order_timestamp")
    return hist.unionByName(live)
