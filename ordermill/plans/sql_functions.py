"""The live statuses and the column tests as SQL table functions.

``register_functions`` adds temporary functions to a session that has the
views of ``files.register_views``:

    SELECT * FROM sales_spike_status(TIMESTAMP_NTZ'2024-01-01 10:30:00')
    SELECT * FROM kpi_last_hour(TIMESTAMP_NTZ'2024-01-01 10:30:00')
    SELECT * FROM recent_inserts(TIMESTAMP_NTZ'2024-01-01 10:30:00', 5)
    SELECT * FROM fact_orders_not_positive('total_order_value')
    SELECT * FROM dim_customers_not_unique('customer_id')
    SELECT * FROM dim_customers_null_count('customer_city')

A function's body is one SQL query that Catalyst inlines, so a literal time
reaches the scan as a filter and a literal column name leaves one column to
read. Each gives the rows of the operator of its name in ``operators``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ordermill.sources.schemas import RAW_ORDERS_STREAM

STREAM = "raw_orders_stream"


def _hour(ts: str) -> str:
    return f"make_timestamp_ntz(year({ts}), month({ts}), dayofmonth({ts}), hour({ts}), 0, 0)"


_NOW = _hour("as_of")
_WIDE = "DECIMAL(38,0)"

# n and s, ss: the hours with orders before this one, the sum of their counts and of their squares
_SPIKE = f"""
CREATE OR REPLACE TEMPORARY FUNCTION sales_spike_status(
  as_of TIMESTAMP_NTZ, lookback_hours INT DEFAULT 24, sigmas DOUBLE DEFAULT 2.0)
RETURNS TABLE (hour TIMESTAMP_NTZ, orders_count BIGINT, status STRING)
RETURN
WITH hourly AS (
  SELECT {_hour('order_timestamp')} AS h, count(*) AS orders
  FROM {STREAM}
  WHERE order_timestamp >= {_NOW} - make_dt_interval(0, lookback_hours) AND order_timestamp < {_NOW} + INTERVAL 1 HOUR
  GROUP BY 1
), dealt AS (
  SELECT if(h < {_NOW}, orders, NULL) AS past, if(h = {_NOW}, orders, NULL) AS own FROM hourly
), sums AS (
  SELECT count(past) AS n, sum(past) AS s, sum(past * past) AS ss, coalesce(max(own), 0) AS orders FROM dealt
), judged AS (
  SELECT orders, orders > 0 AND coalesce(orders > CAST(s AS DOUBLE) / n + sigmas * sqrt(
           CAST(CAST(n AS {_WIDE}) * CAST(ss AS {_WIDE}) - CAST(s AS {_WIDE}) * CAST(s AS {_WIDE}) AS DOUBLE)
           / CAST(CAST(n AS {_WIDE}) * CAST(n - 1 AS {_WIDE}) AS DOUBLE)), false) AS spike
  FROM (SELECT orders, s, ss, if(n >= 2, n, NULL) AS n FROM sums)
)
SELECT {_NOW}, orders, concat(if(spike, 'ALERT: sales spike, ', 'OK: '), CAST(orders AS STRING), ' orders in hour ',
                              CAST({_NOW} AS STRING))
FROM judged"""

_RECENT = f"""
CREATE OR REPLACE TEMPORARY FUNCTION recent_inserts(as_of TIMESTAMP_NTZ, minutes INT DEFAULT 5)
RETURNS TABLE (recent_orders BIGINT)
RETURN SELECT count(*) FROM {STREAM} WHERE insert_timestamp >= as_of - make_dt_interval(0, 0, minutes)"""

# the mean price as realtime.kpi_last_hour rounds it: in whole numbers, half away from zero
_KPI = f"""
CREATE OR REPLACE TEMPORARY FUNCTION kpi_last_hour(as_of TIMESTAMP_NTZ)
RETURNS TABLE (orders_count BIGINT, items_count BIGINT, avg_value DOUBLE, sellers_count BIGINT)
RETURN
WITH sums AS (
  SELECT count(*) AS orders, sum(quantity) AS items, count(DISTINCT seller_id) AS sellers, count(money) AS n,
         CAST(sum(money) AS DECIMAL(38,6)) AS total
  FROM (SELECT quantity, seller_id, TRY_CAST(price AS DECIMAL(24,6)) AS money
        FROM {STREAM} WHERE order_timestamp >= as_of - INTERVAL 1 HOUR)
)
SELECT orders, items, if(n > 0, sign(total) * ((abs(total) * 200 + n) DIV CAST(n * 2 AS DECIMAL(20,0))) / 100, NULL), sellers
FROM sums"""


def _column_tests(view: str, schema: T.StructType) -> list[str]:
    """The column tests of one view; an unknown column name raises."""
    def chosen(fields: list[T.StructField], as_type: str) -> str:
        whens = " ".join(f"WHEN '{f.name}' THEN CAST(`{f.name}` AS {as_type})" for f in fields)
        return f"CASE column_name {whens} ELSE raise_error(concat('no such column: ', column_name)) END"

    numeric = [f for f in schema.fields if isinstance(f.dataType, T.NumericType)]
    scalar = [f for f in schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    key = schema.fields[0]
    head = f"CREATE OR REPLACE TEMPORARY FUNCTION {view}"
    tests = [f"""{head}_not_unique(column_name STRING) RETURNS TABLE (unique_field STRING, n_records BIGINT)
                 RETURN SELECT v, n FROM (SELECT v, count(*) AS n FROM (SELECT {chosen(scalar, 'STRING')} AS v FROM {view})
                                          WHERE v IS NOT NULL GROUP BY v) WHERE n > 1""",
             f"""{head}_null_count(column_name STRING) RETURNS TABLE (n_null BIGINT)
                 RETURN SELECT count_if(v IS NULL) FROM (SELECT {chosen(scalar, 'STRING')} AS v FROM {view})"""]
    if numeric:
        tests.append(f"""{head}_not_positive(column_name STRING)
                         RETURNS TABLE (`{key.name}` {key.dataType.simpleString()}, value DOUBLE)
                         RETURN SELECT k, v FROM (SELECT `{key.name}` AS k, {chosen(numeric, 'DOUBLE')} AS v FROM {view})
                                WHERE v <= 0 OR v IS NULL""")
    return tests


def register_functions(spark: SparkSession, views: list[str]) -> None:
    """Add the functions that the views named give (``files.register_views``
    returns the names): the statuses for the landing table's view, the column
    tests for each other one. The first column of a view is its key."""
    for view in views:
        if view == STREAM:
            missing = set(RAW_ORDERS_STREAM.names) - set(spark.table(view).columns)
            if missing:
                raise ValueError(f"{view} lacks {sorted(missing)}")
            statements = [_SPIKE, _RECENT, _KPI]
        else:
            statements = _column_tests(view, spark.table(view).schema)
        for statement in statements:
            spark.sql(statement)
