"""Bucketed staging: no exchange, same rows, hot orders read the plain way."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ordermill.operators import marts
from ordermill.plans.audit import plan_text
from ordermill.sources import bucketed
from ordermill.sources import fixtures as fx


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture()
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


def _staging(spark, sf_dir):
    stg = fx.staging(spark, sf_dir)
    return {n: stg[n] for n in bucketed.ORDER_TABLES}


def test_no_exchange_and_same_rows(spark, sf_dir, tmp, no_broadcast):
    stg = _staging(spark, sf_dir)
    stg["stg_orders"] = stg["stg_orders"].unionByName(stg["stg_orders"].where("order_id % 5 = 0"))
    tables = bucketed.write_bucketed(spark, stg, "order_id", 4, tmp, suffix="_plain")
    fact = bucketed.fact_orders_of(spark, tables, tmp, 4)
    assert "Exchange" not in plan_text(fact)
    assert _rows(fact) == _rows(marts.fact_orders(*[stg[n] for n in bucketed.ORDER_TABLES]))


def test_hot_order_is_read_without_buckets(spark, sf_dir, tmp, no_broadcast):
    stg = _staging(spark, sf_dir)
    hot = F.when(F.col("order_id") % 3 == 0, F.lit(7)).otherwise(F.col("order_id"))
    stg["stg_order_items"] = stg["stg_order_items"].withColumn("order_id", hot)
    tables = bucketed.write_bucketed(spark, stg, "order_id", 32, tmp, suffix="_hot")
    share = bucketed.largest_share(spark, tmp, 32)
    assert share > 1.5
    fact = bucketed.fact_orders_of(spark, tables, tmp, 32, most=1.5)
    assert "Exchange hashpartitioning" in plan_text(fact)
    as_buckets = bucketed.fact_orders_of(spark, tables, tmp, 32, most=share)
    assert "Exchange" not in plan_text(as_buckets)
    assert _rows(fact) == _rows(as_buckets)


def test_empty_tables_and_null_keys(spark, sf_dir, tmp):
    stg = {n: df.limit(0) for n, df in _staging(spark, sf_dir).items()}
    tables = bucketed.write_bucketed(spark, stg, "order_id", 4, os.path.join(tmp, "a"), suffix="_empty")
    assert bucketed.fact_orders_of(spark, tables, os.path.join(tmp, "a"), 4).count() == 0
    stg = _staging(spark, sf_dir)
    stg = {n: df.withColumn("order_id", F.when(F.col("order_id") % 4 != 1, F.col("order_id"))) for n, df in stg.items()}
    tables = bucketed.write_bucketed(spark, stg, "order_id", 4, os.path.join(tmp, "b"), suffix="_nulls")
    got = bucketed.fact_orders_of(spark, tables, os.path.join(tmp, "b"), 4)
    assert _rows(got) == _rows(marts.fact_orders(*[stg[n] for n in bucketed.ORDER_TABLES]))


def test_buckets_follow_the_size():
    assert bucketed.buckets_for(0) == 1
    assert bucketed.buckets_for(3 * bucketed.BUCKET_BYTES + 1) == 4
    assert bucketed.buckets_for(1, least=200) == 256
