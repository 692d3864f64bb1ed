"""Incremental marts: a refresh gives what a full build gives."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ordermill.plans import refresh
from ordermill.sources import fixtures as fx


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


@pytest.fixture()
def stg(spark, sf_dir):
    return {n: df.cache() for n, df in fx.staging(spark, sf_dir).items()}


def files(root, name):
    return {os.path.join(d, f) for d, _, fs in os.walk(os.path.join(root, name)) for f in fs if f.endswith(".parquet")}


def test_added_altered_moved_and_removed_rows(spark, stg, tmp):
    moved = F.col("order_id") % 50 == 3                      # items that go to another product and seller
    before = dict(stg)
    before["stg_orders"] = stg["stg_orders"].where("order_id % 9 <> 1")
    before["stg_order_items"] = (stg["stg_order_items"].where("order_id % 9 <> 1")
                                 .withColumn("product_id", F.when(moved, F.col("product_id") % 20 + 1).otherwise(F.col("product_id")))
                                 .withColumn("seller_id", F.when(moved, 1).otherwise(F.col("seller_id"))))
    before["stg_customers"] = stg["stg_customers"].unionByName(
        stg["stg_customers"].where("customer_id % 10 = 0").withColumn("customer_id", F.lit(None).cast("long")))
    for name in refresh.MARTS:
        refresh.build(before, name, tmp, buckets=16)
    changes = {n: refresh.differences(before[n], stg[n]) for n in ("stg_orders", "stg_order_items", "stg_customers")}
    for name, mart in refresh.refresh_marts(spark, stg, changes, tmp, buckets=16).items():
        key, sources, make = refresh.MARTS[name]
        want = make(*[stg[s] for s in sources])
        assert mart.dtypes == want.dtypes
        first = rows(mart)
        assert first == rows(want), name
        again = refresh.refresh(spark, stg, changes, name, tmp, buckets=16)      # as after a failed run
        assert rows(again) == first


def test_only_buckets_of_touched_keys_are_rewritten(spark, stg, tmp):
    refresh.build(stg, "fact_orders", tmp, buckets=16)
    before = files(tmp, "fact_orders")
    one = stg["stg_order_items"].orderBy("order_id").limit(1)
    refresh.refresh(spark, stg, {"stg_order_items": one}, "fact_orders", tmp, buckets=16)
    kept = before & files(tmp, "fact_orders")
    buckets = lambda paths: {os.path.basename(os.path.dirname(p)) for p in paths}
    assert len(buckets(before) - buckets(kept)) == 1
    assert rows(refresh.read(spark, tmp, "fact_orders")) == rows(refresh.MARTS["fact_orders"][2](
        *[stg[s] for s in refresh.MARTS["fact_orders"][1]]))


def test_bucket_that_loses_all_rows(spark, stg, tmp):
    refresh.build(stg, "dim_sellers", tmp, buckets=4)
    gone = dict(stg) | {"stg_sellers": stg["stg_sellers"].limit(0)}
    mart = refresh.refresh(spark, gone, {"stg_sellers": stg["stg_sellers"]}, "dim_sellers", tmp, buckets=4)
    assert mart.count() == 0
    mart = refresh.refresh(spark, stg, {"stg_sellers": stg["stg_sellers"]}, "dim_sellers", tmp, buckets=4)
    assert mart.count() == stg["stg_sellers"].count()


def test_no_changes(spark, stg, tmp):
    refresh.build(stg, "dim_customers", tmp, buckets=4)
    before = files(tmp, "dim_customers")
    assert refresh.refresh(spark, stg, {}, "dim_customers", tmp, buckets=4).count() == stg["stg_customers"].count()
    refresh.refresh(spark, stg, {"stg_orders": stg["stg_orders"].limit(0)}, "dim_customers", tmp, buckets=4)
    assert files(tmp, "dim_customers") == before


def test_changes_are_evaluated_once(spark, stg, tmp):
    seen = spark.sparkContext.accumulator(0)

    def count(key):
        seen.add(1)
        return key
    refresh.build(stg, "fact_orders", tmp, buckets=4)
    some = stg["stg_order_items"].where("order_id % 20 = 3")
    counted = some.select(F.udf(count, "long")("order_id").alias("order_id"))
    refresh.refresh(spark, stg, {"stg_order_items": counted}, "fact_orders", tmp, buckets=4)
    assert seen.value == some.count() > 0


@pytest.mark.parametrize("touched", [True, False])
def test_rows_of_the_null_key(spark, stg, tmp, touched):
    null = F.lit(None).cast("long")
    orders = stg["stg_orders"]
    without = dict(stg) | {"stg_orders": orders.where("order_id % 30 <> 1").unionByName(
        orders.where("order_id % 40 = 2").withColumn("order_id", null))}
    refresh.build(without, "fact_orders", tmp, buckets=4)
    now = dict(stg) | {"stg_orders": orders.unionByName(
        orders.where("order_id % 40 = 2" if not touched else "order_id % 50 = 2").withColumn("order_id", null))}
    changes = {"stg_orders": refresh.differences(without["stg_orders"], now["stg_orders"])}
    assert (changes["stg_orders"].where("order_id is null").count() > 0) == touched
    got = rows(refresh.refresh(spark, now, changes, "fact_orders", tmp, buckets=4))
    assert got == rows(refresh.MARTS["fact_orders"][2](*[now[s] for s in refresh.MARTS["fact_orders"][1]]))
    assert any(r[0] == "None" for r in got)


def test_semi_joined_items_are_not_shuffled_again(spark, stg, tmp, monkeypatch):
    """The touched rows stay partitioned by the key, as the mart groups them."""
    plans, write = [], refresh._write
    refresh.build(stg, "fact_orders", tmp, buckets=4)
    monkeypatch.setattr(refresh, "_write", lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        refresh.refresh(spark, stg, {"stg_orders": stg["stg_orders"].where("order_id % 7 = 1")}, "fact_orders", tmp, buckets=4)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the keys for each of five joins, four tables and the old mart
    assert plans[0].count("Exchange hashpartitioning") == 10


def test_differences_counts_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (3, "z")], "k int, v string")
    assert rows(refresh.differences(a, b)) == rows(spark.createDataFrame([(1, None), (3, "y"), (3, "z")], "k int, v string"))
