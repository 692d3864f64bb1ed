"""The daily batch: raw files -> marts -> checks.

Order of steps (the reference runs them as one scheduled chain): required
inputs present -> tolerant raw load -> marts from staging -> declared tests
(a failure stops the run) -> row counts (an empty mart stops the run) ->
post-load checks (severity decides). Staging tables come from an upstream
cleaning layer this library does not define; ``build_marts`` takes them as
DataFrames. Row counts, not-null and consistency tests are counted while the
marts are written; the others read the written tables instead of recomputing
the marts (the write also cuts the lineage).
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import marts, quality
from ordermill.sources.files import save

MART_NAMES = ("dim_customers", "dim_products", "dim_sellers", "fact_orders")

# Column tests declared on the marts. Fixed values.
UNIQUE_TESTS = (("fact_orders", "order_id"), ("dim_customers", "customer_id"),
                ("dim_products", "product_id"))
NOT_NULL_TESTS = (("fact_orders", "order_id"), ("fact_orders", "total_order_value"),
                  ("dim_customers", "customer_id"), ("dim_customers", "customer_city"),
                  ("dim_products", "product_id"), ("dim_products", "product_category_name"))


def build_marts(stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The four marts from the seven staging tables (lazy)."""
    return {
        "dim_customers": marts.dim_customers(stg["stg_customers"], stg["stg_orders"]),
        "dim_products": marts.dim_products(stg["stg_products"], stg["stg_order_items"]),
        "dim_sellers": marts.dim_sellers(stg["stg_sellers"], stg["stg_order_items"]),
        "fact_orders": marts.fact_orders(stg["stg_orders"], stg["stg_order_items"],
                                         stg["stg_order_payments"], stg["stg_order_reviews"]),
    }


def write_marts(spark: SparkSession, built: Mapping[str, DataFrame],
                root: str) -> dict[str, DataFrame]:
    """Write each mart and read it back: to ``<root>/<name>`` (Parquet) when
    ``root`` is a folder, else as the catalog table ``<root>.<name>``."""
    out = {}
    for name, df in built.items():
        if "/" in root:
            path = os.path.join(root, name)
            save(df, path)
            out[name] = spark.read.parquet(path)
        else:
            save(df, f"{root}.{name}")
            out[name] = spark.table(f"{root}.{name}")
    return out


def column_tests(m: Mapping[str, DataFrame]) -> DataFrame:
    """(model, column_name, test, failures) for every declared test: the
    unique and not-null column tests, and the order-total consistency test."""
    checks = {(model, col, "unique"): quality.unique_violations(m[model], col) for model, col in UNIQUE_TESTS}
    checks[("fact_orders", "total_order_value", "price_consistency")] = \
        quality.price_consistency_violations(m["fact_orders"])
    nulls = quality.not_null_counts(m, NOT_NULL_TESTS).withColumn("test", F.lit("not_null"))
    return quality.failing_counts(checks, ("model", "column_name", "test")).unionByName(nulls)


def _observed(name: str, df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with the counts that its checks need, taken while it is written:
    its rows, the nulls of each not-null test and, of the order fact, the rows
    whose total is off. The counts are made in the tasks that write, so a task
    that runs again is counted once."""
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"null {c}") for model, c in NOT_NULL_TESTS if model == name]
    if name == "fact_orders":
        counts.append(F.count_if(quality.price_is_off()).alias("off"))
    seen = Observation(name)
    return df.observe(seen, *counts), seen


def write_checked(spark: SparkSession, built: Mapping[str, DataFrame],
                  root: str) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """:func:`write_marts`, with the row counts and the declared tests of the
    written marts. Only the unique tests read a mart again, its key alone."""
    watched = {name: _observed(name, df) for name, df in built.items()}
    written = write_marts(spark, {name: df for name, (df, _) in watched.items()}, root)
    seen = {name: obs.get for name, (_, obs) in watched.items()}
    counts = spark.createDataFrame([(name, m["rows"]) for name, m in seen.items()], "table_name string, row_count long")
    found = [(model, c, "not_null", seen[model][f"null {c}"]) for model, c in NOT_NULL_TESTS]
    found.append(("fact_orders", "total_order_value", "price_consistency", seen["fact_orders"]["off"]))
    unique = quality.failing_counts({(model, col, "unique"): quality.unique_violations(written[model], col)
                                     for model, col in UNIQUE_TESTS}, ("model", "column_name", "test"))
    observed = spark.createDataFrame(found, "model string, column_name string, test string, failures long")
    return written, counts, unique.unionByName(observed)


@dataclass
class DailyResult:
    marts: dict[str, DataFrame]
    row_counts: DataFrame
    column_tests: DataFrame
    report: DataFrame


def run_daily(spark: SparkSession, stg: Mapping[str, DataFrame], root: str,
              fail_on: tuple[str, ...] = (), strict_tests: bool = True) -> DailyResult:
    """Build, write and check the marts under ``root``, in the reference's
    order: marts, then the declared tests, then row counts, then the report.

    A failing declared test raises (as a failing warehouse test stops the
    run) unless ``strict_tests`` is off; empty marts always raise; report
    checks of the severities in ``fail_on`` (e.g. ``("error",)``) raise too,
    by default they only report.
    """
    written, counts, tests = write_checked(spark, build_marts(stg), root)
    if strict_tests:
        failing = tests.where(F.col("failures") > 0).collect()   # at most one row per test
        if failing:
            raise ValueError("declared tests failed: " + ", ".join(
                f"{r['model']}.{r['column_name']} {r['test']}={r['failures']}" for r in failing))
    quality.require_non_empty(counts)
    report = quality.quality_report(written["fact_orders"], written["dim_customers"])
    if fail_on:
        quality.raise_on_failures(report, fail_on)
    return DailyResult(written, counts, tests, report)
