"""The spike rule against a brute force over random hourly series with gaps."""

from __future__ import annotations

import datetime as dt
import math
import random

from ordermill.operators import realtime

SCHEMA = ("order_id string, customer_id string, product_id string, seller_id string, "
          "quantity bigint, price double, order_timestamp timestamp_ntz, "
          "insert_timestamp timestamp_ntz")


def _brute(counts: dict, lookback=24, sigmas=2.0):
    out = {}
    for h, c in counts.items():
        prior = [counts[h - dt.timedelta(hours=k)] for k in range(1, lookback + 1)
                 if h - dt.timedelta(hours=k) in counts]
        n = len(prior)
        if n < 2:
            out[h] = (n, False)
            continue
        s, ss = sum(prior), sum(x * x for x in prior)
        mean = s / n
        sd = math.sqrt((n * ss - s * s) / (n * (n - 1)))
        out[h] = (n, c > mean + sigmas * sd)
    return out


def test_spike_hours_match_brute_force_with_gaps(spark):
    rng = random.Random(11)
    base = dt.datetime(2024, 2, 1)
    counts = {}
    for h in range(120):
        if rng.random() < 0.3:        # about a third of the hours have no orders
            continue
        counts[base + dt.timedelta(hours=h)] = rng.choice([1, 2, 3, 4, 5, 6, 20])
    rows = [(f"o{h}-{i}", "c", "p", "s", 1, 1.0, t + dt.timedelta(minutes=i), t)
            for h, (t, c) in enumerate(counts.items()) for i in range(c)]
    got = {r["hour"]: (r["prior_hours"], r["is_spike"]) for r in
           realtime.sales_spike_hours(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = _brute(counts)
    assert got == want
    assert any(flag for _, flag in want.values())   # the data does contain spikes
