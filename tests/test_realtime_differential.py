"""Dashboard metrics equal the oracle SQL on random landing tables with NULL
sellers, NULL times and revenue ties (the SQL bodies run on a table)."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import duckdb

from oracle_check import compare
from ordermill.operators import realtime
from ordermill.plans import oracle

LANDING = ("order_id bigint, customer_id bigint, product_id bigint, seller_id bigint, "
           "quantity bigint, price decimal(12,2), order_timestamp timestamp_ntz, "
           "insert_timestamp timestamp_ntz")


def _body(sql: str) -> str:
    body = sql[len(oracle.STAGING_SQL):].strip()
    return "WITH " + body[1:] if body.startswith(",") else body


def _landing(seed: int):
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 3, 1)
    rows = []
    for i in range(400):
        t = None if rng.random() < 0.02 else t0 + dt.timedelta(minutes=rng.randint(0, 60 * 72))
        rows.append((i, rng.randint(1, 50), rng.randint(1, 9), rng.choice([None, 1, 2, 3, 4, 5]),
                     rng.randint(1, 5), Decimal(rng.choice([100, 250, 999, 1000])) / 100, t, t))
    return rows


def test_dashboard_matches_oracle_sql_on_random_landing(spark):
    for seed in (7, 8):
        rows = _landing(seed)
        con = duckdb.connect()
        con.execute("CREATE TABLE raw_orders_stream (order_id BIGINT, customer_id BIGINT, "
                    "product_id BIGINT, seller_id BIGINT, quantity BIGINT, price DECIMAL(12,2), "
                    "order_timestamp TIMESTAMP, insert_timestamp TIMESTAMP)")
        con.executemany("INSERT INTO raw_orders_stream VALUES (?, ?, ?, ?, ?, ?, ?, ?)", rows)
        o = spark.createDataFrame(rows, LANDING)
        as_of = realtime.latest_order_time(o)
        cases = {
            "kpi_last_hour": realtime.kpi_last_hour(o, as_of),
            "hourly_metrics": realtime.hourly_metrics(o),
            "top_sellers_hour": realtime.top_sellers(o, "hour", as_of),
            "top_sellers_today": realtime.top_sellers(o, "today", as_of),
            "top_sellers_week": realtime.top_sellers(o, "week", as_of),
            "weekday_hour_heatmap": realtime.weekday_hour_heatmap(o),
            "sales_spike_hours": realtime.sales_spike_hours(o),
            "sales_spike_status": realtime.sales_spike_status(o, as_of),
            "dq_freshness": realtime.recent_inserts(o, as_of),
        }
        for name, df in cases.items():
            ok, msg = compare(df, con, _body(oracle.SQL[name]))
            assert ok, f"seed {seed} {name}: {msg}"
