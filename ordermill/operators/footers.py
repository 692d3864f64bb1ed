"""Row counts and extents of written tables from their files' footers.

Parquet footers hold each row group's rows and the least and greatest value of
its columns. With aggregate push-down the reader answers COUNT, MIN and MAX
from them, so a check of a written table opens each file's footer and reads no
column of it: its cost grows with files, not with rows.

Push-down needs Spark's second reader interface, which only a session setting
selects; a session of its own, with the caller's settings, keeps it from the
caller's queries. What a footer cannot answer (a column without a value in
some file) is counted from the column itself.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types whose least and greatest value a footer holds exactly.
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)
_SOURCES, _PUSH = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"
EXTENTS = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("row_count", T.LongType()),
                        T.StructField("least", T.StringType()), T.StructField("greatest", T.StringType())])


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans answer COUNT, MIN
    and MAX from footers."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    kept = [s for s in own.conf.get(_SOURCES).split(",") if s.strip() != "parquet"]
    own.conf.set(_SOURCES, ",".join(kept))
    own.conf.set(_PUSH, "true")
    return own


def extent(own: SparkSession, path: str, key: str | None) -> DataFrame:
    """One row: the rows of the Parquet table at ``path`` (null if its files have
    none: no footer is met then) and the least and greatest ``key`` (as text; null where the key's type has no exact footer
    value, or no key is given). ``own``: a :func:`footer_session`."""
    df = own.read.parquet(path)
    ends = [F.lit(None).cast("string")] * 2
    if key is not None and isinstance(df.schema[key].dataType, _EXACT):
        ends = [f(key).cast("string") for f in (F.min, F.max)]
    return df.agg(F.count(F.lit(1)).alias("row_count"), ends[0].alias("least"), ends[1].alias("greatest"))


def extents(spark: SparkSession, tables: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """(table_name, row_count, least, greatest) of each written table, given as
    (path, key column). One row a table reaches the driver."""
    own, rows = footer_session(spark), []
    for name, (path, key) in tables.items():
        try:
            found = extent(own, path, key).first()
        except PySparkException:        # a file without a value of the key
            found = extent(spark, path, key).first()
        rows.append((name, found["row_count"] or 0, found["least"], found["greatest"]))
    return spark.createDataFrame(rows, EXTENTS)
