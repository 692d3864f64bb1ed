"""Plan-shape guards for the scale rules, and hot-key correctness."""

from __future__ import annotations

import contextlib
import io
import re
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ordermill.plans import catalog
from ordermill.operators import marts

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "Window [")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.startswith("stream_hourly")))
def test_no_cross_join_expand_or_window(spark, sf_dir, name):
    plan = _plan(entry.queries()[name](spark, sf_dir))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def test_fact_shuffles_each_input_once(spark, sf_dir):
    plan = _plan(entry.queries()["fact_orders"](spark, sf_dir))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 4


def test_hot_seller_and_hot_order(spark):
    # One seller and one order hold a third of all item rows.
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        rows.append((("o-hot" if hot else f"o{i % 700}"), f"p{i % 97}",
                     ("s-hot" if hot else f"s{i % 40}"), Decimal(i % 500) + Decimal("0.25")))
    items = spark.createDataFrame(rows, "order_id string, product_id string, seller_id string, "
                                        "price decimal(12,2)").withColumn("freight_value", F.col("price"))
    plan = _plan(marts.seller_item_metrics(items))
    assert "partial_sum" in plan and "partial_count" in plan
    got = {r["seller_id"]: r for r in marts.seller_item_metrics(items).collect()}
    orders, products, revenue = defaultdict(set), defaultdict(set), defaultdict(Decimal)
    count = defaultdict(int)
    for o, p, s, price in rows:
        orders[s].add(o)
        products[s].add(p)
        revenue[s] += price
        count[s] += 1
    for s in orders:
        assert got[s]["total_orders"] == len(orders[s])
        assert got[s]["total_products"] == len(products[s])
        assert got[s]["total_revenue"] == float(revenue[s])
        assert got[s]["avg_order_value"] == float(revenue[s]) / count[s]
    hot = marts.order_item_metrics(items).where("order_id = 'o-hot'").first()
    assert hot["total_items"] == 1000 and hot["unique_products"] == len({r[1] for r in rows if r[0] == "o-hot"})


def test_scans_read_only_needed_columns_and_push_filters(spark, sf_dir):
    plan = _plan(entry.queries()["fact_orders"](spark, sf_dir))
    lineitem_scans = [l for l in plan.splitlines() if "lineitem.parquet" in l]
    assert lineitem_scans
    for scan in lineitem_scans:
        columns = re.search(r"FileScan parquet \[([^\]]*)\]", scan).group(1)
        assert "l_shipdate" not in columns and "l_quantity" not in columns, columns
    # Every line has a payment: no scan reads part of the table.
    assert not any("l_linestatus" in l for l in lineitem_scans)
