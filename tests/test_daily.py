"""The daily batch end to end on the smallest test tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ordermill.plans import daily
from ordermill.sources import fixtures as fx


def test_daily_build_write_and_checks(spark, sf_dir, tmp):
    result = daily.run_daily(spark, fx.staging(spark, sf_dir), os.path.join(tmp, "dwh"),
                             fail_on=("error",))
    assert set(result.marts) == set(daily.MART_NAMES)
    counts = {r["table_name"]: r["row_count"] for r in result.row_counts.collect()}
    assert all(n > 0 for n in counts.values())
    orders = fx.table(spark, sf_dir, "orders").count()
    assert counts["fact_orders"] == orders
    tests = result.column_tests.collect()
    assert len(tests) == len(daily.UNIQUE_TESTS) + len(daily.NOT_NULL_TESTS) + 1
    assert all(r["failures"] == 0 for r in tests)
    report = {r["check"]: r for r in result.report.collect()}
    assert report["orphan_orders"]["passed"]
    # The marts were read back from the written Parquet tables.
    assert os.path.isdir(os.path.join(tmp, "dwh", "fact_orders"))


def test_daily_refuses_empty_marts(spark, sf_dir, tmp):
    stg = fx.staging(spark, sf_dir)
    stg["stg_sellers"] = stg["stg_sellers"].limit(0)
    with pytest.raises(ValueError, match="dim_sellers"):
        daily.run_daily(spark, stg, os.path.join(tmp, "dwh"))


def test_daily_into_a_catalog_database(spark, sf_dir, tmp):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS ordermill_dwh LOCATION '{os.path.join(tmp, 'db')}'")
    result = daily.run_daily(spark, fx.staging(spark, sf_dir), "ordermill_dwh")
    assert spark.table("ordermill_dwh.fact_orders").count() == fx.table(spark, sf_dir, "orders").count()
    assert {r["table_name"] for r in result.row_counts.collect()} == set(daily.MART_NAMES)


def test_marts_and_landing_queryable_as_views(spark, sf_dir, tmp):
    from ordermill.sources import files
    from ordermill.sources.fixtures import raw_orders_stream
    root = os.path.join(tmp, "dwh")
    daily.write_marts(spark, daily.build_marts(fx.staging(spark, sf_dir)), root)
    land = os.path.join(tmp, "landing")
    raw_orders_stream(spark, sf_dir).withColumn("batch_id", F.lit(0).cast("long")) \
        .select("order_id", "customer_id", "product_id", "seller_id", "quantity",
                F.col("price").cast("double"), "order_timestamp", "insert_timestamp",
                "batch_id") \
        .withColumn("order_id", F.col("order_id").cast("string")) \
        .withColumn("customer_id", F.col("customer_id").cast("string")) \
        .withColumn("product_id", F.col("product_id").cast("string")) \
        .withColumn("seller_id", F.col("seller_id").cast("string")) \
        .write.partitionBy("batch_id").parquet(land)
    assert files.register_views(spark, root, land) == [
        "dim_customers", "dim_products", "dim_sellers", "fact_orders", "raw_orders_stream"]
    n = spark.sql("SELECT COUNT(*) FROM fact_orders f JOIN dim_customers c "
                  "ON f.customer_id = c.customer_id").first()[0]
    assert n == fx.table(spark, sf_dir, "orders").count()
    hours = spark.sql("SELECT date_trunc('hour', order_timestamp) h, COUNT(*) FROM "
                      "raw_orders_stream GROUP BY 1").count()
    assert hours > 0


def test_failing_declared_test_stops_the_run(spark, sf_dir, tmp):
    stg = fx.staging(spark, sf_dir)
    # The same product id under two categories breaks dim_products.product_id unique.
    twin = stg["stg_products"].limit(1).withColumn("product_category_name", F.lit("other"))
    stg["stg_products"] = stg["stg_products"].unionByName(twin)
    with pytest.raises(ValueError, match="dim_products.product_id unique=1"):
        daily.run_daily(spark, stg, os.path.join(tmp, "a"))
    result = daily.run_daily(spark, stg, os.path.join(tmp, "b"), strict_tests=False)
    failed = [r for r in result.column_tests.collect() if r["failures"]]
    assert [(r["model"], r["test"]) for r in failed] == [("dim_products", "unique")]


def test_counts_taken_while_writing_equal_the_checks_of_written_marts(spark, sf_dir, tmp):
    built = daily.build_marts(fx.staging(spark, sf_dir))
    k = F.col("order_id") % 10
    built["fact_orders"] = (built["fact_orders"]
                            .withColumn("total_order_value", F.when(k == 3, F.col("total_order_value") + 1).when(k != 4, F.col("total_order_value")))
                            .withColumn("order_id", F.when(k == 5, 5).when(k != 6, F.col("order_id"))))
    built["dim_products"] = built["dim_products"].withColumn("product_category_name", F.lit(None).cast("string"))
    written, counts, tests = daily.write_checked(spark, built, os.path.join(tmp, "dwh"))
    from ordermill.operators import quality
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, quality.row_counts(written).collect()))
    got = {(r["model"], r["column_name"], r["test"]): r["failures"] for r in tests.collect()}
    assert got == {(r["model"], r["column_name"], r["test"]): r["failures"] for r in daily.column_tests(written).collect()}
    assert got["fact_orders", "total_order_value", "price_consistency"] > 0 and got["fact_orders", "order_id", "not_null"] > 0
