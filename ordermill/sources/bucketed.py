"""Staging tables in buckets of their join key, for joins without a shuffle.

``write_bucketed`` writes tables in the same number of hash buckets of one
key. A scan of such a table is hash partitioned on the key already, so
aggregates and joins on the key, or on more columns than it, need no exchange
(``fact_orders`` over ``ORDER_TABLES``: none, where plain tables need four).
The shuffle is paid once, by the write, and serves every job that reads.

A bucket is read by one task. So the number of buckets must follow the size of
the largest table (:func:`buckets_for`), and a key that holds a large share of
the rows makes one long task: :func:`largest_share` tells that share from the
written files, and ``fact_orders_of`` shuffles as usual where it is too large,
so that AQE can split what is splittable.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import marts

ORDER_TABLES = ("stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews")
MOST_OF_MEAN = 8        # a bucket of more than this many mean buckets counts as hot
BUCKET_BYTES = 256 << 20


def buckets_for(table_bytes: int, least: int = 1) -> int:
    """Buckets of about 256 MB for a table of this many bytes, a power of two
    (so that tables of other powers of two can still be joined by coalescing)."""
    wanted = max(least, -(-table_bytes // BUCKET_BYTES))
    return 1 << (wanted - 1).bit_length()


def write_bucketed(spark: SparkSession, tables: Mapping[str, DataFrame], key: str, buckets: int,
                   root: str, database: str = "default", suffix: str = "") -> dict[str, DataFrame]:
    """Write each table as the catalog table ``<database>.<name><suffix>``, its
    files under ``<root>/<name>``, in ``buckets`` buckets of ``key``, sorted by it.

    Rows are dealt by the key before the write, as a REBALANCE hint, so that a
    bucket comes in few files and AQE still splits one that is too large for
    a task. Rows whose key is null share a bucket. Returns the tables as read.
    """
    out = {}
    for name, df in tables.items():
        full = f"{database}.{name}{suffix}"
        (df.hint("rebalance", buckets, F.col(key)).write.mode("overwrite")
         .bucketBy(buckets, key).sortBy(key).option("path", os.path.join(root, name))
         .format("parquet").saveAsTable(full))
        out[name] = spark.table(full)
    return out


def largest_share(spark: SparkSession, root: str, buckets: int) -> float:
    """Bytes of the largest bucket over those of a mean bucket, of the tables
    under ``root`` together: a listing, no file is opened; one row reaches the
    driver. 0 if there are no files."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(root))
    bucket = F.regexp_extract("path", r"_(\d{5,})\.c\d+", 1)
    sizes = files.select(bucket.alias("bucket"), "length").groupBy("bucket").agg(F.sum("length").alias("size"))
    found = sizes.agg(F.max("size").alias("largest"), F.sum("size").alias("whole")).first()
    return found["largest"] * buckets / found["whole"] if found["whole"] else 0.0


def fact_orders_of(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, buckets: int,
                   most: float = MOST_OF_MEAN) -> DataFrame:
    """The order fact over bucketed ``ORDER_TABLES`` under ``root``: without an
    exchange, or, where a bucket is hot, from a plain scan of the same files.
    Both give the same rows."""
    if largest_share(spark, root, buckets) <= most:
        return marts.fact_orders(*[tables[name] for name in ORDER_TABLES], co_located=True)
    return marts.fact_orders(*[spark.read.parquet(os.path.join(root, name)) for name in ORDER_TABLES])
