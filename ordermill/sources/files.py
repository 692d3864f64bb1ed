"""Loading a set of files into tables, and materialising results.

``load_files`` is the daily raw load: every file of a file -> table map
that exists is parsed tolerantly and written to its table, rejects to a
quarantine folder; missing optional files are skipped with a warning. The
returned report has one row per file with the rows loaded and rejected,
counted while writing. ``missing_inputs`` lists required files that are
absent (file contents are not read).
"""

from __future__ import annotations

import logging
import os
from collections.abc import Container, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.sources.csv_load import load_csv, write_counted
from ordermill.sources.schemas import LANDING_TABLE, MULTI_LINE_FILES, RAW_FILES, REQUIRED_FILES

log = logging.getLogger(__name__)

AT_ONCE = 4      # files loaded side by side

REPORT_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("rows_loaded", T.LongType()), T.StructField("rows_rejected", T.LongType())])


def input_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, or a folder of part files, is at ``path`` (nothing is read)."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":   # anything else must not look absent
            raise
        return False
    return True


def missing_inputs(spark: SparkSession, directory: str,
                   required: Iterable[str] = REQUIRED_FILES) -> DataFrame:
    """Required file names that are not in ``directory``."""
    missing = [(n,) for n in required if not input_exists(spark, os.path.join(directory, n))]
    return spark.createDataFrame(missing, "file_name string")


def require_inputs(spark: SparkSession, directory: str,
                   required: Iterable[str] = REQUIRED_FILES) -> None:
    """Raise FileNotFoundError naming every missing required file."""
    missing = sorted(r["file_name"] for r in missing_inputs(spark, directory, required).collect())
    if missing:
        raise FileNotFoundError(f"missing input files: {missing}")


def save(df: DataFrame, target: str, mode: str = "overwrite", kind: str = "table") -> None:
    """Materialise ``df`` as a table (a path containing '/' or a catalog
    table name) or, with ``kind="view"``, as a session view (nothing is
    computed until the view is read)."""
    if kind == "view":
        df.createOrReplaceTempView(target)
    elif kind != "table":
        raise ValueError(f"unknown kind {kind!r}; expected 'table' or 'view'")
    elif "/" in target:
        df.write.mode(mode).parquet(target)
    else:
        df.write.mode(mode).saveAsTable(target)


def load_files(spark: SparkSession, directory: str, target_root: str, quarantine_root: str,
               files: Mapping[str, tuple[str, T.StructType]] = RAW_FILES,
               multi_line: Container[str] = MULTI_LINE_FILES, at_once: int = AT_ONCE) -> DataFrame:
    """Load every present file of ``files``; return the per-file report.

    A name may be a file or a folder of part files. Only the files named in
    ``multi_line`` may have quoted fields that span lines; large files of the
    others are split over many tasks.

    Tables land at ``<target_root>/<table>`` (or as catalog tables named
    ``<target_root>.<table>`` when ``target_root`` has no '/'), rejects at
    ``<quarantine_root>/<table>``. Each file's parsed copy is staged at
    ``<quarantine_root>/_parsed/<table>`` and replaced by the next load, so
    staging space stays at one copy per table.

    ``at_once`` files are loaded side by side, so that the last tasks of one
    file's jobs and the first of the next share the cluster (with
    ``spark.scheduler.mode=FAIR`` they also share it evenly). A file that
    fails does not stop the others; then RuntimeError names every file that
    failed, and nothing is listed as loaded that was not.
    """
    def load(file_name: str, table: str, schema: T.StructType) -> tuple | None:
        if not input_exists(spark, os.path.join(directory, file_name)):
            log.warning("input file not found, skipped: %s", file_name)
            return None
        parts = load_csv(spark, os.path.join(directory, file_name), schema,
                         staging=os.path.join(quarantine_root, "_parsed", table),
                         multi_line=file_name in multi_line)
        target = (os.path.join(target_root, table) if "/" in target_root
                  else f"{target_root}.{table}")
        good = write_counted(parts.good, f"{table}_good", lambda d: save(d, target))
        bad = write_counted(parts.rejected, f"{table}_bad",
                            lambda d: d.write.mode("overwrite").parquet(
                                os.path.join(quarantine_root, table)))
        row = (file_name, table, good.get["rows"], bad.get["rows"])
        log.info("loaded %s into %s: %d rows, %d rejected", *row)
        return row

    rows, failed = [], {}
    with ThreadPoolExecutor(at_once) as pool:
        loads = {name: pool.submit(inheritable_thread_target(spark)(load), name, table, schema)
                 for name, (table, schema) in files.items()}
        for name, job in loads.items():
            try:
                row = job.result()
            except Exception as e:      # reported below, with every other file that failed
                failed[name] = e
            else:
                rows += [row] if row else []
    if failed:
        raise RuntimeError("files not loaded: " + "; ".join(f"{name}: {e}" for name, e in failed.items())) \
            from next(iter(failed.values()))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def partition_values(spark: SparkSession, table: str, column: str) -> list[str]:
    """The values of a partition column, ascending, from the names of the
    files under ``table``: a listing, no file is opened. One value a folder
    reaches the driver."""
    try:
        names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    value = F.regexp_extract("path", f"/{column}=([^/]+)/", 1)
    found = names.select(value.alias("value")).where("value <> ''").distinct()
    return sorted(r["value"] for r in found.collect())


def ensure_landing_table(spark: SparkSession, path: str) -> None:
    """Create the empty landing table of streamed orders if it is absent.

    It is laid out as the stream sink writes it (one ``batch_id=N`` folder
    per micro-batch, in it one per hour of arrival), so an empty table holds no data file and is read with
    its fixed schema (``streaming.ingest.read_landing``).
    """
    (spark.createDataFrame([], LANDING_TABLE).write.mode("ignore")
     .partitionBy("batch_id", "ingest_hour").parquet(path))


def register_views(spark: SparkSession, dwh_root: str | None = None,
                   landing: str | None = None) -> list[str]:
    """Expose the written marts (a folder, or a catalog database when
    ``dwh_root`` has no '/') and the landing table as session views under
    their warehouse names, so existing SQL runs through ``spark.sql``.

    Nothing is read until a query uses a view. Returns the view names.
    """
    names = []
    if dwh_root:
        for mart in ("dim_customers", "dim_products", "dim_sellers", "fact_orders"):
            df = (spark.read.parquet(os.path.join(dwh_root, mart)) if "/" in dwh_root
                  else spark.table(f"{dwh_root}.{mart}"))
            df.createOrReplaceTempView(mart)
            names.append(mart)
    if landing:
        spark.read.schema(LANDING_TABLE).parquet(landing).createOrReplaceTempView(
            "raw_orders_stream")
        names.append("raw_orders_stream")
    return names
