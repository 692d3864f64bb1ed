"""The marts equal the oracle's SQL on random staging tables with
duplicates, NULL ids and orders without items, payments or reviews."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal

import duckdb

from oracle_check import compare
from ordermill.operators import marts
from ordermill.plans import oracle

ORDERS = ("order_id bigint, customer_id bigint, order_status string, "
          "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
          "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
          "order_estimated_delivery_date timestamp_ntz")
ITEMS = ("order_id bigint, product_id bigint, seller_id bigint, price decimal(12,2), "
         "freight_value decimal(17,4)")
PAYMENTS = "order_id bigint, payment_sequential int, payment_type string, payment_value decimal(12,2)"
REVIEWS = "order_id bigint, review_score bigint"


def _data(seed: int):
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    orders = []
    for o in range(40):
        t = t0 + dt.timedelta(hours=rng.randint(0, 500))
        row = (o, rng.choice([None, 1, 2, 3]), rng.choice(["F", "O", "P"]), t, None, None, None,
               t + dt.timedelta(days=14))
        orders.append(row)
        if rng.random() < 0.15:
            orders.append(row)                       # exact duplicate order row
    items = [(rng.randint(0, 45), rng.choice([None, 10, 11, 12, 13]), rng.choice([None, 7, 8]),
              Decimal(rng.randint(1, 99999)) / 100, Decimal(rng.randint(0, 9999)) / 10000)
             for _ in range(90)]
    payments = [(rng.randint(0, 45), rng.randint(1, 3), rng.choice(["boleto", "card", None]),
                 Decimal(rng.randint(1, 9999)) / 100) for _ in range(50)]
    reviews = [(rng.randint(0, 45), rng.randint(1, 5)) for _ in range(30)]
    return orders, items, payments, reviews


def test_fact_orders_matches_oracle_sql_on_random_staging(spark):
    for seed in (1, 2, 3):
        orders, items, payments, reviews = _data(seed)
        frames = {
            "stg_orders": spark.createDataFrame(orders, ORDERS),
            "stg_order_items": spark.createDataFrame(items, ITEMS),
            "stg_order_payments": spark.createDataFrame(payments, PAYMENTS),
            "stg_order_reviews": spark.createDataFrame(reviews, REVIEWS),
        }
        con = duckdb.connect()
        for name, (rows, ddl) in {"stg_orders": (orders, ORDERS), "stg_order_items": (items, ITEMS),
                                  "stg_order_payments": (payments, PAYMENTS),
                                  "stg_order_reviews": (reviews, REVIEWS)}.items():
            cols = [c.strip().split(" ") for c in re.split(r",(?![^()]*\))", ddl)]
            types = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR",
                     "timestamp_ntz": "TIMESTAMP"}
            con.execute(f"CREATE TABLE {name} (" + ", ".join(
                f"{c} {types.get(t, t.upper())}" for c, t in cols) + ")")
            if rows:
                con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(cols))})", rows)
        sql = "WITH " + oracle._PER_ORDER.strip() + oracle._FACT
        got = marts.fact_orders(frames["stg_orders"], frames["stg_order_items"],
                                frames["stg_order_payments"], frames["stg_order_reviews"])
        ok, msg = compare(got, con, sql)
        assert ok, f"seed {seed}: {msg}"


PRODUCTS = ("product_id bigint, product_category_name string, product_weight_g double, "
            "product_length_cm double, product_height_cm double, product_width_cm double, "
            "product_volume_cm3 double, weight_category string")
SELLERS = ("seller_id bigint, seller_city string, seller_state string, "
           "seller_zip_code_prefix string")
CUSTOMERS = ("customer_id bigint, customer_unique_id string, customer_city string, "
             "customer_state string, customer_zip_code_prefix string")


def _duck(tables: dict) -> duckdb.DuckDBPyConnection:
    types = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR",
             "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE"}
    con = duckdb.connect()
    for name, (rows, ddl) in tables.items():
        cols = [c.strip().split(" ") for c in re.split(r",(?![^()]*\))", ddl)]
        con.execute(f"CREATE TABLE {name} (" + ", ".join(
            f"{c} {types.get(t, t.upper())}" for c, t in cols) + ")")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(cols))})", rows)
    return con


def test_dimensions_match_oracle_sql_on_random_staging(spark):
    for seed in (4, 5, 6):
        rng = random.Random(seed)
        orders, items, _, _ = _data(seed)
        products = []
        for p in [None, 10, 11, 12, 13, 14]:
            products.append((p, rng.choice(["toys", "books"]), 1.0, 2.0, 3.0, 4.0, 24.0, "light"))
            if rng.random() < 0.3:   # same id again, other category
                products.append((p, "garden", 1.0, 2.0, 3.0, 4.0, 24.0, "heavy"))
        sellers = [(s, rng.choice(["Lyon", "Nice"]), "X", "01") for s in (None, 7, 8, 9)]
        customers = [(c, rng.choice(["u1", "u2", None]), rng.choice(["Paris", "Nice", None]),
                      rng.choice(["IDF", "PACA"]), rng.choice(["75", "06"]))
                     for c in [None, 1, 1, 2, 2, 2, 3, 4]]
        con = _duck({"stg_orders": (orders, ORDERS), "stg_order_items": (items, ITEMS),
                     "stg_products": (products, PRODUCTS), "stg_sellers": (sellers, SELLERS),
                     "stg_customers": (customers, CUSTOMERS)})
        o = spark.createDataFrame(orders, ORDERS)
        i = spark.createDataFrame(items, ITEMS)
        cases = {
            "dim_products": (marts.dim_products(spark.createDataFrame(products, PRODUCTS), i),
                             "WITH " + oracle._SALES.strip() + oracle._products("50", "150")),
            "dim_sellers": (marts.dim_sellers(spark.createDataFrame(sellers, SELLERS), i),
                            "WITH " + oracle._SALES.strip() + oracle._SELLERS),
            "dim_customers": (marts.dim_customers(spark.createDataFrame(customers, CUSTOMERS), o),
                              "WITH " + oracle._SPANS.strip() + oracle._CUSTOMERS),
        }
        for name, (df, sql) in cases.items():
            ok, msg = compare(df, con, sql)
            assert ok, f"seed {seed} {name}: {msg}"


def test_quality_checks_match_oracle_sql_on_random_marts(spark):
    from ordermill.operators import quality
    from ordermill.plans import daily
    for seed in (9, 10):
        rng = random.Random(seed)
        orders, items, payments, reviews = _data(seed)
        products = [(p, "toys", 1.0, 2.0, 3.0, 4.0, 24.0, "light") for p in (10, 11, 12, 13)]
        sellers = [(s, "Lyon", "X", "01") for s in (7, 8)]
        customers = [(c, "u", rng.choice(["Paris", None]), "IDF", "75") for c in (1, 2, 2)]
        tables = {"stg_orders": (orders, ORDERS), "stg_order_items": (items, ITEMS),
                  "stg_order_payments": (payments, PAYMENTS), "stg_order_reviews": (reviews, REVIEWS),
                  "stg_products": (products, PRODUCTS), "stg_sellers": (sellers, SELLERS),
                  "stg_customers": (customers, CUSTOMERS)}
        con = _duck(tables)
        m = daily.build_marts({n: spark.createDataFrame(rows, ddl) for n, (rows, ddl) in tables.items()})
        fact, cust = m["fact_orders"], m["dim_customers"]
        cases = {
            "dq_report": quality.quality_report(fact, cust),
            "dq_orphans": quality.orphan_count(fact, cust, "customer_id"),
            "dq_null_counts": quality.null_counts(fact, {"null_customers": "customer_id",
                                                         "null_dates": "order_purchase_timestamp"}),
            "dq_duplicate_keys": quality.duplicate_key_count(cust, "customer_id"),
            "dq_row_counts": quality.row_counts(m),
            "dq_positive": quality.positive_value_violations(fact, "total_order_value")
                                  .select("order_id", "total_order_value"),
        }
        for name, df in cases.items():
            body = oracle.SQL[name][len(oracle.STAGING_SQL):].strip()
            sql = "WITH " + body[1:] if body.startswith(",") else body
            ok, msg = compare(df, con, sql)
            assert ok, f"seed {seed} {name}: {msg}"
