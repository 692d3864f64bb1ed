"""SQL table functions give what the operators give."""

from __future__ import annotations

import pytest

from ordermill.operators import quality, realtime
from ordermill.plans import dashboard
from ordermill.plans.audit import plan_text
from ordermill.plans.sql_functions import register_functions
from ordermill.sources import fixtures as fx


@pytest.fixture()
def orders(spark, sf_dir):
    df = fx.raw_orders_stream(spark, sf_dir)
    df.createOrReplaceTempView("raw_orders_stream")
    register_functions(spark, ["raw_orders_stream"])
    return df


def test_statuses_equal_the_operators_at_many_times(spark, orders):
    spikes = [r.hour for r in realtime.sales_spike_hours(orders).where("is_spike").limit(3).collect()]
    first, last = orders.selectExpr("min(order_timestamp)", "max(order_timestamp)").first()
    assert spikes
    for at in [str(t) for t in (*spikes, first, last)] + ["1999-01-01 00:00:00"]:
        for name, operator in (("sales_spike_status", realtime.sales_spike_status), ("kpi_last_hour", realtime.kpi_last_hour),
                               ("recent_inserts", realtime.recent_inserts)):
            want = operator(orders, at)
            got = spark.sql(f"SELECT * FROM {name}(TIMESTAMP_NTZ'{at}')")
            assert got.columns == want.columns
            assert got.collect() == want.collect(), (name, at)
    assert spark.sql(f"SELECT status FROM sales_spike_status(TIMESTAMP_NTZ'{spikes[0]}')").first()[0].startswith("ALERT")


def test_no_time_and_one_prior_hour(spark):
    rows = [("o", "c", "p", "s", 1, 2.0, t, t) for t in ("2024-01-01 09:10:00", "2024-01-01 10:10:00", "2024-01-01 10:20:00")]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, product_id string, seller_id string, quantity long, "
                                     "price double, order_timestamp string, insert_timestamp string").selectExpr(
        "* EXCEPT (order_timestamp, insert_timestamp)", "CAST(order_timestamp AS TIMESTAMP_NTZ) AS order_timestamp",
        "CAST(insert_timestamp AS TIMESTAMP_NTZ) AS insert_timestamp")
    df.createOrReplaceTempView("raw_orders_stream")
    register_functions(spark, ["raw_orders_stream"])
    got = spark.sql("SELECT * FROM sales_spike_status(TIMESTAMP_NTZ'2024-01-01 10:30:00')").first()
    assert got.status == "OK: 2 orders in hour 2024-01-01 10:00:00"
    nothing = spark.sql("SELECT * FROM sales_spike_status(CAST(NULL AS TIMESTAMP_NTZ))").first()
    assert (nothing.hour, nothing.orders_count, nothing.status) == (None, 0, None)


def test_a_literal_time_reaches_the_scan(spark, orders):
    plan = plan_text(spark.sql("SELECT * FROM sales_spike_status(TIMESTAMP_NTZ'2024-01-05 10:30:00')"))
    assert "GreaterThanOrEqual(ts,2024-01-04T10:00" in plan


def test_column_tests(spark):
    df = spark.createDataFrame([(1, 5.0, "a", [1]), (2, 0.0, "a", [1]), (3, None, "b", None), (3, -1.0, None, None)],
                               "order_id long, total double, city string, ids array<int>")
    df.createOrReplaceTempView("orders_seen")
    register_functions(spark, ["orders_seen"])
    run = lambda text: sorted(map(tuple, spark.sql(text).collect()), key=repr)
    want = quality.positive_value_violations(df, "total").select("order_id", "total").collect()
    assert run("SELECT * FROM orders_seen_not_positive('total')") == sorted(map(tuple, want), key=repr)
    assert run("SELECT * FROM orders_seen_not_unique('order_id')") == [("3", 2)]
    assert run("SELECT * FROM orders_seen_not_unique('city')") == [("a", 2)]
    assert run("SELECT * FROM orders_seen_null_count('city')") == [(1,)]
    with pytest.raises(Exception, match="no such column"):
        run("SELECT * FROM orders_seen_null_count('ids')")


def test_stream_view_without_its_columns_is_refused(spark):
    spark.range(1).createOrReplaceTempView("raw_orders_stream")
    with pytest.raises(ValueError, match="order_timestamp"):
        register_functions(spark, ["raw_orders_stream"])


def test_panels_of_no_orders(spark, sf_dir):
    rows = dashboard.as_rows(dashboard.panels(fx.raw_orders_stream(spark, sf_dir).limit(0))).collect()
    assert {(r.panel, r.measure, r.value) for r in rows} == {
        ("kpi", "orders_count", 0.0), ("kpi", "items_count", None), ("kpi", "avg_value", None), ("kpi", "sellers_count", 0.0)}
