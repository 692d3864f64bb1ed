"""Incremental marts: only the keys touched by a change set are recomputed.

A refreshable mart is laid out in hash buckets of its key,
``<root>/<mart>/bucket=N``. A refresh finds the keys that the changed staging
rows touch, recomputes the mart over the staging rows of these keys alone, and
rewrites the buckets that hold them by dynamic partition overwrite: a bucket's
untouched rows are taken over, those of touched keys replaced (or left out,
where nothing of the key is left). A refresh that failed or that is run again
gives the same buckets, as touched keys always come from staging.

The whole staging tables are scanned for the touched keys, but only rows of
these keys are shuffled and aggregated; the rest of a mart is not read.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import marts
from ordermill.session import shared_dir

BUCKETS = 256

# mart -> (key, staging tables that it reads, builder over these). Each builder
# computes a key's rows from the staging rows of that key only.
MARTS: dict[str, tuple[str, tuple[str, ...], Callable[..., DataFrame]]] = {
    "dim_customers": ("customer_id", ("stg_customers", "stg_orders"), marts.dim_customers),
    "dim_products": ("product_id", ("stg_products", "stg_order_items"), marts.dim_products),
    "dim_sellers": ("seller_id", ("stg_sellers", "stg_order_items"), marts.dim_sellers),
    "fact_orders": ("order_id", ("stg_orders", "stg_order_items", "stg_order_payments",
                                 "stg_order_reviews"), marts.fact_orders),
}


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def _write(rows: DataFrame, key: str, path: str, buckets: int, emptied: DataFrame | None = None) -> None:
    """Overwrites the buckets of ``rows``, and those of ``emptied``.

    Spark replaces only partitions that get a row, so every bucket that must
    be replaced also gets a marker row (``_live`` false), which readers skip.
    A REBALANCE hint lets AQE split a large bucket over tasks.
    """
    out = rows.select("*", F.lit(True).alias("_live"), _bucket(key, buckets))
    if emptied is not None:
        out = out.unionByName(emptied.select("bucket", F.lit(False).alias("_live")), allowMissingColumns=True)
    (out.hint("rebalance", F.col("bucket")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if emptied is not None else "static")
     .partitionBy("bucket").parquet(path))


def build(stg: Mapping[str, DataFrame], name: str, root: str, buckets: int = BUCKETS) -> None:
    """Write the mart ``name`` in full, in buckets, under ``root``."""
    key, sources, make = MARTS[name]
    _write(make(*[stg[s] for s in sources]), key, os.path.join(root, name), buckets)


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The mart ``name`` as it stands (a row's bucket is not a column of it)."""
    return spark.read.parquet(os.path.join(root, name)).where("_live").drop("_live", "bucket")


def touched_keys(changes: Mapping[str, DataFrame], name: str) -> DataFrame | None:
    """The distinct keys of mart ``name`` in the changed staging rows, null
    included; None if no table of the mart has changes."""
    key, sources, _ = MARTS[name]
    found = [changes[s].select(key) for s in sources if s in changes]
    return reduce(DataFrame.union, found).distinct() if found else None


def refresh(spark: SparkSession, stg: Mapping[str, DataFrame], changes: Mapping[str, DataFrame],
            name: str, root: str, buckets: int = BUCKETS) -> DataFrame:
    """Bring the mart ``name`` under ``root`` up to date with staging ``stg``.

    ``changes`` holds, by staging table, the rows that were added, altered or
    removed since the mart was last written; an altered row in its old and its
    new state, as it may have moved from one key to another. Only the key
    columns are used. ``buckets`` must be the number the mart was built with.
    A table without changes may be left out; no change leaves the mart as it
    is. Returns the mart. At most one number a bucket reaches the driver.
    """
    key, sources, make = MARTS[name]
    path = os.path.join(root, name)
    keys = touched_keys(changes, name)
    if keys is None:
        return read(spark, root, name)
    # The change set is evaluated once; every later step reads these keys.
    touched = shared_dir(spark, "touched", name)
    keys.write.parquet(touched)
    keys = spark.read.schema(keys.schema).parquet(touched)
    found = keys.select(_bucket(key, buckets), F.col(key).isNull().alias("unknown")).distinct().collect()
    hit = sorted({r["bucket"] for r in found})
    if not hit:
        return read(spark, root, name)
    wanted = keys.where(F.col(key).isNotNull()).withColumnRenamed(key, "_key")
    of_null = F.col(key).isNull() if any(r["unknown"] for r in found) else None

    # Plain equality leaves the rows partitioned by the key, as the marts group
    # them next; the null key, which it never matches, is taken by a filter.
    def touched_rows(df: DataFrame) -> DataFrame:
        rows = df.join(wanted, df[key] == wanted["_key"], "left_semi")
        return rows if of_null is None else rows.unionByName(df.where(of_null))

    def untouched_rows(df: DataFrame) -> DataFrame:
        df = df if of_null is None else df.where(~of_null)
        return df.join(wanted, df[key] == wanted["_key"], "left_anti")

    fresh = make(*[touched_rows(stg[s]) for s in sources])
    old = spark.read.parquet(path).where(F.col("_live") & F.col("bucket").isin(hit)).drop("_live", "bucket")
    rows = untouched_rows(old).select(*fresh.columns).unionByName(fresh)
    _write(rows, key, path, buckets, spark.createDataFrame([(b,) for b in hit], "bucket int"))
    spark.catalog.refreshByPath(path)
    return read(spark, root, name)


def refresh_marts(spark: SparkSession, stg: Mapping[str, DataFrame], changes: Mapping[str, DataFrame],
                  root: str, buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """:func:`refresh` of all four marts."""
    return {name: refresh(spark, stg, changes, name, root, buckets) for name in MARTS}


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows that two states of a table do not share (counted, so that a
    repeated row that lost a copy is a change), for sources without a change
    feed. Both states are shuffled once."""
    sides = before.select("*", F.lit(1).alias("_n")).unionByName(after.select("*", F.lit(-1).alias("_n")))
    return sides.groupBy(*after.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0").drop("_n")
