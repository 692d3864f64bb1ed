"""Each check with a passing and a failing fixture."""

from __future__ import annotations

import pytest

from ordermill.operators import quality


def test_unique(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "k int")
    assert [tuple(r) for r in quality.unique_violations(df, "k").collect()] == [(2, 2)]
    assert quality.unique_violations(df.where("k = 1"), "k").count() == 0


def test_not_null_and_positive(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 0.0), (3, -1.0), (4, None)], "k int, v double")
    assert quality.not_null_violations(df, "k").count() == 1
    assert sorted(r["k"] for r in df.transform(quality.positive_value_violations, "v")
                  .collect() if r["k"] is not None) == [3, 4]
    assert df.where("v > 0").transform(quality.positive_value_violations, "v").count() == 0


def test_price_consistency(spark):
    fact = spark.createDataFrame([("a", 10.0, 1.0, 11.0), ("b", 10.0, 1.0, 11.02),
                                  ("c", 10.0, 1.0, 11.01)],
                                 "order_id string, total_items_price double, "
                                 "total_freight_value double, total_order_value double")
    bad = quality.price_consistency_violations(fact).collect()
    assert [r["order_id"] for r in bad] == ["b"]   # 0.02 fails, 0.01 is within tolerance


def test_row_counts_and_empty(spark):
    a = spark.range(3)
    e = spark.range(0)
    counts = quality.row_counts({"a": a, "e": e})
    assert {r["table_name"]: r["row_count"] for r in counts.collect()} == {"a": 3, "e": 0}
    with pytest.raises(ValueError, match="empty"):
        quality.require_non_empty(counts)
    quality.require_non_empty(quality.row_counts({"a": a}))


def test_duplicates_orphans_nulls_and_report(spark):
    dim = spark.createDataFrame([("c1",), ("c1",), ("c2",)], "customer_id string")
    fact = spark.createDataFrame([("o1", "c1", "2024-01-01"), ("o2", "c9", None),
                                  ("o3", None, "2024-01-02")],
                                 "order_id string, customer_id string, "
                                 "order_purchase_timestamp string")
    assert quality.duplicate_key_count(dim, "customer_id").first()[0] == 1
    assert quality.orphan_count(fact, dim, "customer_id").first()[0] == 2  # unknown + NULL key
    n = quality.null_counts(fact, {"null_customers": "customer_id",
                                   "null_dates": "order_purchase_timestamp"}).first()
    assert (n["null_customers"], n["null_dates"]) == (1, 1)
    report = {r["check"]: r for r in quality.quality_report(fact, dim).collect()}
    assert report["orphan_orders"]["severity"] == "error"
    assert not report["orphan_orders"]["passed"]
    assert report["duplicate_customers"]["severity"] == "warn"
    with pytest.raises(ValueError, match="orphan_orders=2"):
        quality.raise_on_failures(quality.quality_report(fact, dim))
    clean = quality.quality_report(fact.where("order_id = 'o1'"), dim.distinct())
    quality.raise_on_failures(clean, ("error", "warn"))


def test_freshness(spark):
    import datetime as dt
    from ordermill.operators.realtime import recent_inserts
    t = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(t - dt.timedelta(minutes=10),)], "insert_timestamp timestamp_ntz")
    with pytest.raises(ValueError):
        quality.require_fresh(recent_inserts(df, t))
    assert quality.require_fresh(recent_inserts(df, t, minutes=15)) == 1
