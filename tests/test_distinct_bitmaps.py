"""Bitmaps of ids count as COUNT(DISTINCT) does, however the rows came in."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ordermill.operators import distinct_bitmaps as db

SCHEMA = "order_timestamp timestamp_ntz, seller_id string"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def orders(spark):
    rng = random.Random(3)
    rows = [(T0 + dt.timedelta(minutes=rng.randrange(40 * 24 * 60)), f"s{rng.randrange(400)}") for _ in range(3000)]
    rows += [(T0 + dt.timedelta(days=3, minutes=k), "hot") for k in range(2000)]
    rows += [(None, "timeless"), (T0, None), (dt.datetime(2025, 6, 1), None)]
    return rows, spark.createDataFrame(rows, SCHEMA).cache()


def test_numbers_are_dense_and_stay(spark, orders):
    rows, df = orders
    first = db.number_ids(df.where("seller_id < 's2'"), "seller_id").localCheckpoint if False else db.number_ids(
        df.where("seller_id < 's2'"), "seller_id").cache()
    known = {r.seller_id: r.number for r in first.collect()}
    both = {r.seller_id: r.number for r in db.number_ids(df, "seller_id", first).collect()}
    ids = {s for _, s in rows if s is not None}
    assert sorted(known.values()) == list(range(1, len(known) + 1))
    assert set(both) == ids and sorted(both.values()) == list(range(1, len(ids) + 1))
    assert all(both[s] == n for s, n in known.items())


def test_windows_equal_distinct_sets(spark, orders):
    rows, df = orders
    numbers = db.number_ids(df, "seller_id").cache()
    a, b = df.where("hash(seller_id) % 2 = 0"), df.where("hash(seller_id) % 2 <> 0")
    # a batch that is merged twice, and hours that both batches have
    hourly = db.merge(*[db.hourly_bitmaps(x, "seller_id", numbers) for x in (a, b, b)]).cache()
    days = {}
    for ts, s in rows:
        if ts is not None and s is not None:
            days.setdefault(ts.date(), set()).add(s)
    want = {d: (len(ids), len(set().union(*[days.get(d - dt.timedelta(k), set()) for k in range(7)]))) for d, ids in days.items()}
    assert {r.day: (r.ids, r.trailing_ids) for r in db.trailing_days(hourly, 7).collect()} == want
    for start in (T0 + dt.timedelta(days=20, minutes=17), T0 + dt.timedelta(days=39), T0 - dt.timedelta(days=1),
                  T0 + dt.timedelta(days=400)):
        got = db.ids_since(df, hourly, "seller_id", numbers, F.lit(start).cast("timestamp_ntz")).collect()
        assert [r.ids for r in got] == [len({s for ts, s in rows if ts is not None and ts >= start and s is not None})]


def test_more_ids_than_a_bitmap_holds(spark):
    df = spark.range(100_000).select(F.lit(T0).cast("timestamp_ntz").alias("order_timestamp"), (F.col("id") % 70_000 * 1_000_003).alias("seller_id"))
    numbers = db.number_ids(df, "seller_id").cache()
    hourly = db.hourly_bitmaps(df, "seller_id", numbers)
    assert hourly.count() == 3
    assert db.distinct_ids(hourly, "hour").first().ids == 70_000


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    numbers = db.number_ids(empty, "seller_id")
    hourly = db.hourly_bitmaps(empty, "seller_id", numbers)
    assert hourly.count() == db.trailing_days(hourly).count() == 0
    assert db.ids_since(empty, hourly, "seller_id", numbers, F.lit(T0).cast("timestamp_ntz")).first().ids == 0
