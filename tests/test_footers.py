"""Counts and extents from footers equal those of the rows."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ordermill.operators import footers
from ordermill.plans.audit import plan_text


def _write(spark, path, df):
    df.write.parquet(path)
    return path


def test_reads_no_column(spark, tmp):
    path = _write(spark, os.path.join(tmp, "t"), spark.range(1000).repartition(5).withColumn("s", F.col("id").cast("string")))
    plan = plan_text(footers.extent(footers.footer_session(spark), path, "id"))
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan
    assert "PushedAggregation: [COUNT(*)]" in plan_text(footers.extent(footers.footer_session(spark), path, "s"))
    assert "BatchScan" not in plan_text(spark.read.parquet(path))          # the caller's session is as before
    got = {r.table_name: tuple(r)[1:] for r in footers.extents(spark, {
        "ids": (path, "id"), "texts": (path, "s"), "rows": (path, None)}).collect()}
    assert got == {"ids": (1000, "0", "999"), "texts": (1000, None, None), "rows": (1000, None, None)}


def test_nulls_empty_tables_and_dates(spark, tmp):
    rows = spark.createDataFrame([(None, "2024-01-05"), (3, "2024-01-02"), (None, None)], "k int, d string")
    df = rows.withColumn("d", F.to_date("d"))
    some = _write(spark, os.path.join(tmp, "some"), df.coalesce(1))
    apart = _write(spark, os.path.join(tmp, "apart"), df.repartition(3))    # files without any value of k
    nothing = _write(spark, os.path.join(tmp, "nothing"), df.limit(0))
    got = {r.table_name: tuple(r)[1:] for r in footers.extents(spark, {
        "some": (some, "k"), "dates": (some, "d"), "apart": (apart, "k"), "nothing": (nothing, "k")}).collect()}
    assert got == {"some": (3, "3", "3"), "dates": (3, "2024-01-02", "2024-01-05"), "apart": (3, "3", "3"),
                   "nothing": (0, None, None)}
