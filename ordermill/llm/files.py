"""Files of own binary formats, written and read by Spark.

Spark's text sink writes a column's bytes as they are, under its commit
protocol: a lost or repeated task leaves no partial file, on any file system
that Spark can write to. One row is one file; each ends with a terminator that
its format defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_files(df: DataFrame, path: str, terminator: str) -> None:
    """Write each row's one binary column as a file. Partition order is kept
    by (part, chunk) as :func:`read_files` gives them."""
    (df.select(F.col(df.columns[0]).cast("string").alias("value"))
     .write.option("lineSep", terminator).option("maxRecordsPerFile", 1).text(path))


def read_files(spark: SparkSession, path: str, names: str = "part-*") -> DataFrame:
    """(part, chunk, content) of the files under ``path`` whose names match;
    part and chunk are null for others than :func:`write_files` made."""
    name = F.regexp_extract
    return (spark.read.format("binaryFile").option("pathGlobFilter", names).load(path)
            .select(name("path", r"/part-(\d+)-[^/]*$", 1).cast("long").alias("part"),
                    name("path", r"-c(\d+)[^/-]*$", 1).cast("long").alias("chunk"), "content"))
