"""Tolerant CSV loads: keep the good rows, quarantine the bad ones.

Format: comma separated, one header line (skipped, columns are positional),
optional ``"`` quoting with ``""`` as an escaped quote, quoted fields may
span lines; a UTF-8 byte-order mark and CRLF line ends are accepted. A row
with too few or too many fields, or a value that does not fit its column
type, is not loaded: it goes to the quarantine with its raw text and the
load goes on (the warehouse's ON_ERROR = CONTINUE).

Spark parses only the columns a query needs, and a value is checked only
when it is parsed: a query reading two columns would pass a row whose bad
value sits in a third. So the file is parsed once with every column and
staged as Parquet in the shared folder; the good and rejected rows are read
from that copy, with ordinary column pruning. The CSV is read once however
many outputs are taken.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.session import shared_dir
from ordermill.sources.csv_records import csv_records

CORRUPT = "_corrupt_record"
# A quoted empty field ("") is an empty string, an unquoted empty field is
# NULL. Spark reads both as NULL unless quoted empties get a sentinel.
_EMPTY = "\u0001"


_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT, "emptyValue": _EMPTY}


@dataclass(frozen=True)
class CsvLoad:
    good: DataFrame      # the schema's columns, typed
    rejected: DataFrame  # the schema's columns (as parsed) plus ``_corrupt_record``


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             multi_line: bool = True) -> DataFrame:
    """Parse ``path`` with ``schema`` plus ``_corrupt_record``; nothing raises.

    ``multi_line`` allows quoted fields to span lines (review texts do), but
    then Spark reads each file in one task; for files known to be one record
    per line, ``multi_line=False`` lets a large file split across tasks.
    """
    return (spark.read.schema(_with_corrupt(schema)).options(**_OPTIONS)
            .option("header", True).option("multiLine", multi_line).csv(path))


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def parse_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """:func:`read_csv` of records found by ``csv_records`` (column ``record``)."""
    fields = _with_corrupt(schema)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    options = {k: str(v) for k, v in _OPTIONS.items()} | {"multiLine": "true"}
    # behind a generator, so that each record is parsed once
    parsed = records.select(F.explode(F.array(F.from_csv("record", ddl, options))).alias("row"))
    return parsed.select("row.*")


def _restore_empty(schema: T.StructType) -> list:
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.when(c == _EMPTY, F.lit("")).otherwise(c)
        cols.append(c.alias(f.name))
    return cols


def load_csv(spark: SparkSession, path: str, schema: T.StructType,
             staging: str | None = None, multi_line: bool = True) -> CsvLoad:
    """Parse a CSV file (or folder) once and split good from rejected rows.

    Runs one job that writes the parsed rows (all columns) to ``staging``,
    by default a fresh folder under the shared ``spark.checkpoint.dir``. With
    ``multi_line`` quoted fields may span lines: a first job finds the records,
    in as many tasks as the file has splits (see ``csv_records``).
    """
    staging = staging or shared_dir(spark, "csv_load")
    if multi_line:
        parsed = parse_records(csv_records(spark, path, f"{staging.rstrip('/')}_lines"), schema)
    else:
        parsed = read_csv(spark, path, schema, multi_line)
    parsed.write.mode("overwrite").parquet(staging)
    parsed = spark.read.parquet(staging)
    ok = F.col(CORRUPT).isNull()
    good = parsed.where(ok).select(*_restore_empty(schema))
    rejected = parsed.where(~ok).select(*_restore_empty(schema), F.col(CORRUPT))
    return CsvLoad(good, rejected)


def write_counted(df: DataFrame, name: str, write) -> Observation:
    """Run ``write(observed_df)`` and count its rows in the same pass."""
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return obs
