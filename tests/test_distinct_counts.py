"""Stacked two-level distinct counts equal a plain GROUP BY, NULLs included."""

from __future__ import annotations

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.operators import marts

ids = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
prices = st.one_of(st.none(), st.integers(min_value=0, max_value=99999).map(lambda c: Decimal(c) / 100))
rows = st.lists(st.tuples(ids, ids, ids, prices), min_size=1, max_size=40)


def _brute(items, key, first, second):
    out = {}
    for r in items:
        k = r[key]
        g = out.setdefault(k, {"f": set(), "s": set(), "sum": Decimal(0), "n": 0,
                               "min": None, "max": None})
        if r[first] is not None:
            g["f"].add(r[first])
        if r[second] is not None:
            g["s"].add(r[second])
        p = r["price"]
        if p is not None:
            g["sum"] += p
            g["n"] += 1
            g["min"] = p if g["min"] is None else min(g["min"], p)
            g["max"] = p if g["max"] is None else max(g["max"], p)
    return out


@settings(max_examples=15, deadline=None)
@given(rows)
def test_product_and_seller_metrics_match_brute_force(spark, data):
    items = spark.createDataFrame(
        data, "order_id string, product_id string, seller_id string, price decimal(12,2)")
    dicts = [dict(zip(("order_id", "product_id", "seller_id", "price"), r)) for r in data]
    want = _brute(dicts, "product_id", "order_id", "seller_id")
    got = {r["product_id"]: r for r in marts.product_item_metrics(items).collect()}
    assert set(got) == set(want)
    for k, g in want.items():
        r = got[k]
        assert (r["total_orders"], r["total_sellers"]) == (len(g["f"]), len(g["s"]))
        assert r["avg_price"] == (float(g["sum"]) / g["n"] if g["n"] else None)
        assert r["min_price"] == (float(g["min"]) if g["min"] is not None else None)
        assert r["max_price"] == (float(g["max"]) if g["max"] is not None else None)
    want = _brute(dicts, "seller_id", "order_id", "product_id")
    got = {r["seller_id"]: r for r in marts.seller_item_metrics(items).collect()}
    assert set(got) == set(want)
    for k, g in want.items():
        r = got[k]
        assert (r["total_orders"], r["total_products"]) == (len(g["f"]), len(g["s"]))
        assert r["total_revenue"] == (float(g["sum"]) if g["n"] else None)
