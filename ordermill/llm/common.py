"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ordermill.session import shared_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back.

    A lineage cut that every executor can read: what is computed from it
    stays the same when an executor is lost, and row ids given out by a task
    cannot change between two readers.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str) -> Column:
    """A text column with null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_key(*columns: str) -> Column:
    """Hash of a row's identity; equal rows share it, null is a value of its own."""
    return F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns])


def keep_rows(docs: DataFrame, kept: DataFrame, columns: tuple[str, ...],
              once: bool = False) -> DataFrame:
    """Rows of ``docs`` whose ``columns`` are in ``kept`` (columns ``doc_id``
    and ``row_key``), in the layout of ``docs``. With ``once`` a row that
    occurs several times stays once."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                       F.col("doc_id").alias("_id"), row_key(*columns).alias("_key"))
    keys = kept.select(F.col("doc_id").alias("_kid"), F.col("row_key").alias("_kkey")).distinct()
    rows = rows.join(keys, (F.col("_key") == F.col("_kkey")) & F.col("_id").eqNullSafe(F.col("_kid")),
                     "left_semi")
    if once:
        rows = rows.dropDuplicates(["_id", "_key"])
    return rows.select(*[F.col("row").getField(c).alias(c) for c in names])
