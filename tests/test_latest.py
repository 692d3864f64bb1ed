"""keep_latest equals the window definition (row_number over a total order)."""

from __future__ import annotations

import contextlib
import io
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermill.operators.latest import keep_latest


def _window_pick(df, keys, order_by, nulls_first):
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    first = F.col(order_by[0]).desc_nulls_first() if nulls_first else F.col(order_by[0]).desc_nulls_last()
    spec = Window.partitionBy(*keys).orderBy(
        first, *[F.col(c).desc_nulls_last() for c in order_by[1:] + rest])
    return (df.withColumn("rn", F.row_number().over(spec)).where("rn = 1").drop("rn")
            .select(*df.columns))


def test_matches_window_on_random_rows_with_nulls_and_ties(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, 1, 2, 3]),
             rng.choice([None, "x", "y"]), rng.randint(0, 3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, d int, t string, v int")
    for nulls_first in (True, False):
        got = sorted(map(tuple, keep_latest(df, ["k"], ["d", "t"], nulls_first).collect()),
                     key=repr)
        want = sorted(map(tuple, _window_pick(df, ["k"], ["d", "t"], nulls_first).collect()),
                      key=repr)
        assert got == want


def test_hot_key_is_reduced_before_the_shuffle(spark):
    # One key holds most rows; the plan must aggregate partially per task.
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 97).alias("d"), F.col("id").alias("v"))
    out = keep_latest(df, ["k"], ["d"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "partial_max" in buf.getvalue()
    assert out.where("k = 1").collect()[0]["d"] == 96
