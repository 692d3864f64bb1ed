"""Scalar helpers: exact money, time semantics, text decoding."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.functions import money, text, time


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=30))
def test_rounded_mean_and_exact_mean_match_decimal_arithmetic(spark, cents):
    values = [Decimal(c) / 100 for c in cents]
    df = spark.createDataFrame([(v,) for v in values], "x decimal(12,2)")
    got = df.agg(money.rounded_mean("x", 2).alias("r"), money.exact_mean("x").alias("m"),
                 money.exact_sum("x").alias("s")).first()
    mean = sum(values) / len(values)
    want = mean.copy_abs().quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert got["r"] == float(want if mean >= 0 else -want)
    assert got["s"] == sum(values)
    assert got["m"] == float(sum(values)) / len(values)


def test_means_of_nothing_are_null(spark):
    df = spark.createDataFrame([(None,)], "x decimal(12,2)")
    r = df.agg(money.rounded_mean("x"), money.exact_mean("x")).first()
    assert r[0] is None and r[1] is None


def test_time_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 2, 1, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(time.days_between("a", "b").alias("d"), time.hour_bucket("b").alias("h"),
                  time.day_name("a").alias("n"), time.hour_of_day("a").alias("hr"),
                  time.within_last("a", F.col("b"), 2, "hour").alias("w2"),
                  time.within_last("a", F.col("b"), 1, "hour").alias("w1")).first()
    assert (r["d"], r["h"], r["n"], r["hr"]) == (1, dt.datetime(2024, 1, 2, 1), "Mon", 23)
    assert r["w2"] and not r["w1"]
    with pytest.raises(ValueError):
        time.interval(1, "fortnight")
    with pytest.raises(ValueError):
        time.period_filter("month", "a", F.col("b"))


def test_text_helpers(spark):
    df = spark.createDataFrame([('"p1"', "2024-01-01T10:00:00.5", '{"k": 7}'),
                                ("p2", "not a time", '{"k": "x"}')], "id string, t string, j string")
    r = df.select(text.strip_quotes("id").alias("id"), text.parse_timestamp("t").alias("t"),
                  text.json_int("j", "$.k").alias("k")).collect()
    assert r[0]["id"] == "p1" and r[0]["t"] == dt.datetime(2024, 1, 1, 10, 0, 0, 500000)
    assert r[0]["k"] == 7
    assert r[1]["id"] == "p2" and r[1]["t"] is None and r[1]["k"] is None


def test_large_and_sub_cent_prices_are_exact(spark):
    from pyspark.sql import functions as F
    df = spark.range(777_777).select(F.lit(987654321.99).alias("p"))
    assert df.agg(money.rounded_mean(money.money("p"))).first()[0] == 987654321.99
    df = spark.createDataFrame([(0.004,), (0.004,), (0.125,)], "p double")
    assert df.agg(money.to_double(money.exact_sum(money.money("p")))).first()[0] == 0.133
    df = spark.createDataFrame([(1e11,), (1e30,), (float("nan"),), (2.0,)], "p double")
    r = df.agg(money.exact_mean(money.money("p")), money.rounded_mean(money.money("p"))).first()
    assert r[0] == r[1] == (1e11 + 2) / 2           # what does not fit counts as NULL


def test_shared_dir_needs_a_setting_on_a_cluster():
    import pytest
    from ordermill.session import shared_dir

    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "spark://host:7077"}.get(key, default)
    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_dir(Session)
