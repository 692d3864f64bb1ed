"""The star schema: three dimensions and the order fact.

Each mart aggregates its detail table per key first and joins the result
1:1 to the entity table, so the joins never fan out. All marts over order
items aggregate before they shuffle (partial + final hash aggregation);
COUNT(DISTINCT) shuffles on (key, value) first, which spreads a hot key.
Money columns are summed as DECIMAL(24,6) and returned as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.money import exact_mean, exact_sum, money_of, to_double
from ordermill.functions.time import days_between
from ordermill.operators.latest import keep_latest

CUSTOMER_ATTRIBUTES = ("customer_unique_id", "customer_city", "customer_state",
                       "customer_zip_code_prefix")


# --- order fact -----------------------------------------------------------

def order_item_metrics(items: DataFrame) -> DataFrame:
    """Per order: distinct products, item count, price and freight sums,
    and the product / seller ids of its items (sorted, duplicates kept).

    The product list is collected anyway, so the distinct count is taken
    from it (both skip NULLs): one aggregation level and one shuffle, where
    COUNT(DISTINCT) would add a second shuffle on (order, product).
    """
    agg = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("total_items"),
        exact_sum(money_of(items, "price")).alias("total_items_price"),
        exact_sum(money_of(items, "freight_value")).alias("total_freight_value"),
        F.sort_array(F.collect_list("product_id")).alias("product_ids"),
        F.sort_array(F.collect_list("seller_id")).alias("seller_ids"))
    return agg.select(
        "order_id", F.size(F.array_distinct("product_ids")).cast("long").alias("unique_products"),
        "total_items", "total_items_price", "total_freight_value", "product_ids", "seller_ids")


def order_payment_metrics(payments: DataFrame) -> DataFrame:
    """Per order: paid total, greatest payment type, number of payment rows."""
    return payments.groupBy("order_id").agg(
        exact_sum(money_of(payments, "payment_value")).alias("total_payment"),
        F.max("payment_type").alias("payment_type"),
        F.count("payment_sequential").alias("payment_installments"))


def order_review_metrics(reviews: DataFrame) -> DataFrame:
    """Per order: mean review score and number of reviews."""
    return reviews.groupBy("order_id").agg(
        exact_mean("review_score").alias("avg_review_score"),
        F.count(F.lit(1)).alias("review_count"))


def order_left_join_chain(orders: DataFrame, items: DataFrame, payments: DataFrame,
                          reviews: DataFrame) -> DataFrame:
    """Orders with their three per-order aggregates, all left-joined on order_id.

    Every right side has one row per order_id, so the chain keeps the order
    rows as they are. The three aggregates and the orders are all hash
    partitioned on order_id, so the joins add no shuffle of their own.
    """
    return (orders
            .join(order_item_metrics(items), "order_id", "left")
            .join(order_payment_metrics(payments), "order_id", "left")
            .join(order_review_metrics(reviews), "order_id", "left"))


ORDER_COLUMNS = ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                 "order_approved_at", "order_delivered_carrier_date",
                 "order_delivered_customer_date", "order_estimated_delivery_date")


def fact_orders(orders: DataFrame, items: DataFrame, payments: DataFrame,
                reviews: DataFrame, co_located: bool = False) -> DataFrame:
    """One row per distinct order row: attributes, item / payment / review measures.

    Counters and sums of orders without items, payments or reviews are 0;
    the id arrays, payment type and mean score stay NULL. The total is items
    plus freight (payments are not involved).

    The warehouse applies DISTINCT to the joined rows. Each right side has
    one row per order_id, so an output row is a function of its order row
    and DISTINCT over the output equals DISTINCT over the order rows. We
    de-duplicate the eight narrow order columns before the joins, hash
    partitioned on order_id so the joins reuse that partitioning: each input
    is shuffled once, and no shuffle ever carries the wide joined rows.
    Items are shuffled as they are too: collecting ids before the shuffle
    would sort them twice and make them no fewer.

    ``co_located``: the four inputs lie in the same buckets of order_id (see
    ``sources.bucketed``), so nothing is shuffled at all.
    """
    own_orders = orders.select(*ORDER_COLUMNS)
    distinct_orders = (own_orders if co_located else own_orders.repartition("order_id")).distinct()
    own_items = items if co_located else items.repartition("order_id")
    j = order_left_join_chain(distinct_orders, own_items, payments, reviews)
    zero = F.lit(0)
    items_price = F.coalesce("total_items_price", zero)
    freight = F.coalesce("total_freight_value", zero)
    return j.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
        F.coalesce("unique_products", zero).alias("unique_products"),
        F.coalesce("total_items", zero).alias("total_items"),
        to_double(items_price).alias("total_items_price"),
        to_double(freight).alias("total_freight_value"),
        "product_ids", "seller_ids",
        to_double(F.coalesce("total_payment", zero)).alias("total_payment"),
        "payment_type",
        F.coalesce("payment_installments", zero).alias("payment_installments"),
        "avg_review_score",
        F.coalesce("review_count", zero).alias("review_count"),
        to_double(items_price + freight).alias("total_order_value"))


# --- dimensions -----------------------------------------------------------

def customer_order_metrics(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.min("order_purchase_timestamp").alias("first_order_date"),
        F.max("order_purchase_timestamp").alias("last_order_date"))


def dim_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer_id with its latest attributes and order metrics.

    The warehouse picks attributes by the customer's last order date, which
    is the same for every row of a customer (it comes from a join on the
    customer id), so that ordering can never decide. The attribute values
    themselves break the tie (greatest tuple wins). Because the ordering key
    is constant per customer, the pick is made before the join, where map
    tasks can reduce duplicates before the shuffle.
    """
    latest = keep_latest(customers.select("customer_id", *CUSTOMER_ATTRIBUTES),
                         ["customer_id"], list(CUSTOMER_ATTRIBUTES), nulls_first=False)
    m = customer_order_metrics(orders)
    return latest.join(m, "customer_id", "left").select(
        "customer_id", *CUSTOMER_ATTRIBUTES,
        "total_orders", "first_order_date", "last_order_date",
        days_between("first_order_date", "last_order_date").alias("customer_lifetime_days"))


def latest_customer_per(customers: DataFrame, orders: DataFrame, group: str) -> DataFrame:
    """The customer with the latest last order in each ``group`` value.

    Ordering: last order date descending, NULL (no order) first, then
    customer id descending.
    """
    m = customer_order_metrics(orders).select("customer_id", "last_order_date")
    rows = customers.join(m, "customer_id", "left")
    return keep_latest(rows.select(group, "last_order_date", "customer_id",
                                   *CUSTOMER_ATTRIBUTES),
                       [group], ["last_order_date", "customer_id"], nulls_first=True)


def _per_key_distinct_counts(items: DataFrame, key: str, by_first: dict,
                             first: str, second: str) -> DataFrame:
    """Per ``key``: COUNT(DISTINCT first), COUNT(DISTINCT second), and the
    ``by_first`` aggregates, without Catalyst's Expand.

    Two COUNT(DISTINCT) in one aggregate make Catalyst triple every input
    row (Expand) before the first hash aggregate. Instead each input row
    feeds two level-1 aggregates: one per (key, first), which also computes
    the other measures, and one per distinct (key, second). Their rows are
    stacked and one final GROUP BY key counts the non-NULL values of each
    side and merges the measures. Three shuffles, no join; both level-1
    shuffles use a composite key, so a hot key is spread over many tasks,
    and the final one is pre-aggregated per map task. NULL keys form their
    own group, as in a single GROUP BY.
    """
    level1 = (items.groupBy(key, first)
              .agg(*[e.alias(n) for n, (e, _) in by_first.items()])
              .withColumnRenamed(first, "_v1"))
    pairs = items.select(key, F.col(second).alias("_v2")).distinct()
    stacked = level1.unionByName(pairs, allowMissingColumns=True)
    return stacked.groupBy(key).agg(
        F.count("_v1").alias("_n_first"), F.count("_v2").alias("_n_second"),
        *[merge(F.col(n)).alias(n) for n, (_, merge) in by_first.items()])


def product_item_metrics(items: DataFrame) -> DataFrame:
    """Per product: distinct orders and sellers, mean / min / max price."""
    price = money_of(items, "price")
    m = _per_key_distinct_counts(items, "product_id", {
        "_sum": (F.sum(price), F.sum), "_cnt": (F.count(price), F.sum),
        "_min": (F.min(price), F.min), "_max": (F.max(price), F.max)},
        "order_id", "seller_id")
    return m.select(
        "product_id", F.col("_n_first").alias("total_orders"),
        F.col("_n_second").alias("total_sellers"),
        F.when(F.col("_cnt") > 0, F.col("_sum").cast("double") / F.col("_cnt")).alias("avg_price"),
        to_double(F.col("_min")).alias("min_price"), to_double(F.col("_max")).alias("max_price"))


def price_band(avg_price: str, low_cut: float = 50, high_cut: float = 150) -> Column:
    """'Low' below ``low_cut``, 'Medium' below ``high_cut``, else 'High'.

    NULL (never sold) falls to 'High', as in the warehouse CASE.
    """
    p = F.col(avg_price)
    return F.when(p < low_cut, "Low").when(p < high_cut, "Medium").otherwise("High")


def dim_products(products: DataFrame, items: DataFrame, low_cut: float = 50,
                 high_cut: float = 150) -> DataFrame:
    """One row per distinct product row with sales metrics and price band.

    As in the order fact, the metrics are one row per product_id, so
    DISTINCT over the joined rows equals DISTINCT over the product rows;
    de-duplicating first, hash partitioned on product_id, lets the join
    reuse that partitioning.
    """
    m = product_item_metrics(items)
    distinct_products = products.repartition("product_id").distinct()
    return (distinct_products.join(m, "product_id", "left")
            .select(*products.columns, "total_orders", "total_sellers", "avg_price",
                    "min_price", "max_price",
                    price_band("avg_price", low_cut, high_cut).alias("price_range")))


def seller_item_metrics(items: DataFrame) -> DataFrame:
    """Per seller: distinct orders and products, revenue, mean item price."""
    price = money_of(items, "price")
    m = _per_key_distinct_counts(items, "seller_id", {
        "_sum": (F.sum(price), F.sum), "_cnt": (F.count(price), F.sum)},
        "order_id", "product_id")
    return m.select(
        "seller_id", F.col("_n_first").alias("total_orders"),
        F.col("_n_second").alias("total_products"),
        to_double(F.col("_sum")).alias("total_revenue"),
        F.when(F.col("_cnt") > 0, F.col("_sum").cast("double") / F.col("_cnt"))
         .alias("avg_order_value"))


def dim_sellers(sellers: DataFrame, items: DataFrame) -> DataFrame:
    """One row per seller row with sales metrics; unsold sellers keep NULLs."""
    m = seller_item_metrics(items)
    return sellers.join(m, "seller_id", "left").select(
        "seller_id", "seller_city", "seller_state", "seller_zip_code_prefix",
        "total_orders", "total_products", "total_revenue", "avg_order_value")
