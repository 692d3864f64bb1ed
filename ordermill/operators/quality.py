"""Data-quality checks: each returns its failing rows or a one-row count.

The generic column tests (``unique``, ``not_null``, ``positive_value``) are
plain ``(df, column) -> df`` functions, usable with ``DataFrame.transform``.
The checks never raise: the report carries a severity per check and the
caller decides, by calling ``raise_on_failures`` or one of the ``require_*``
helpers, which fetch a few summary rows and raise on failure.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Severities of the post-load checks. Duplicates and NULLs
# warn, orphans are an error; none of them stops the run by itself.
SEVERITY = {"duplicate_customers": "warn", "orphan_orders": "error",
            "null_customers": "warn", "null_dates": "warn"}


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` seen more than once (NULLs ignored)."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def positive_value_violations(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is zero, negative or NULL."""
    c = F.col(column)
    return df.where((c <= 0) | c.isNull())


def _price_diff() -> Column:
    return F.abs(F.col("total_items_price") + F.col("total_freight_value") - F.col("total_order_value"))


def price_is_off(tolerance: float = 0.01) -> Column:
    """Whether an order's total differs from items + freight by more than ``tolerance``."""
    return _price_diff() > tolerance


def price_consistency_violations(fact: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Orders whose total differs from items + freight by more than ``tolerance``."""
    return (fact.select("order_id", "total_items_price", "total_freight_value",
                        "total_order_value", _price_diff().alias("price_diff"))
            .where(F.col("price_diff") > tolerance))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count), all counted in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    """One row: number of key values that occur more than once."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
            .where(F.col("cnt") > 1)
            .agg(F.count(F.lit(1)).alias("duplicate_count")))


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows with no dimension row for ``key`` (NULL keys included)."""
    return fact.join(dim.select(key), key, "left_anti")


def orphan_count(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return orphans(fact, dim, key).agg(F.count(F.lit(1)).alias("orphan_orders"))


def null_counts(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row: NULL count per column in a single pass; keys name the outputs."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(alias)
                    for alias, c in columns.items()])


def quality_report(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """The post-load checks as rows (check, failures, severity, passed)."""
    dup = duplicate_key_count(customers, "customer_id").select(
        F.lit("duplicate_customers").alias("check"), F.col("duplicate_count").alias("failures"))
    orph = orphan_count(fact, customers, "customer_id").select(
        F.lit("orphan_orders").alias("check"), F.col("orphan_orders").alias("failures"))
    nulls = null_counts(fact, {"null_customers": "customer_id",
                               "null_dates": "order_purchase_timestamp"})
    nulls = nulls.select(F.explode(F.array(
        F.struct(F.lit("null_customers").alias("check"), F.col("null_customers").alias("failures")),
        F.struct(F.lit("null_dates").alias("check"), F.col("null_dates").alias("failures")),
    )).alias("r")).select("r.*")
    sev = F.create_map(*[x for k, v in SEVERITY.items() for x in (F.lit(k), F.lit(v))])
    return dup.unionByName(orph).unionByName(nulls).select(
        "check", "failures", sev[F.col("check")].alias("severity"),
        (F.col("failures") == 0).alias("passed"))


def raise_on_failures(report: DataFrame, severities: tuple[str, ...] = ("error",)) -> None:
    """Raise if any check of the given severities failed (a small action)."""
    bad = (report.where(~F.col("passed") & F.col("severity").isin(*severities))
           .select("check", "failures").collect())  # a row per check
    if bad:
        raise ValueError("data-quality checks failed: "
                         + ", ".join(f"{r['check']}={r['failures']}" for r in bad))


def require_non_empty(counts: DataFrame) -> None:
    """Raise if any table of a ``row_counts`` report is empty."""
    empty = [r["table_name"] for r in counts.where(F.col("row_count") == 0).collect()]
    if empty:
        raise ValueError(f"empty tables: {empty}")


def require_fresh(recent: DataFrame) -> int:
    """Raise if a ``recent_inserts`` row reports no new rows; else the count."""
    n = recent.first()["recent_orders"]
    if not n:
        raise ValueError("no new rows in the freshness window")
    return n


def failing_counts(checks: Mapping[tuple[str, ...], DataFrame],
                   key_names: tuple[str, ...] = ("model", "column_name")) -> DataFrame:
    """One row per check: its key parts (named ``key_names``) and the
    number of failing rows, for several checks in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("failures"))
               .select(*[F.lit(v).alias(n) for n, v in zip(key_names, key)], "failures")
             for key, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_null_counts(tables: Mapping[str, DataFrame], tests: Iterable[tuple[str, str]]) -> DataFrame:
    """(model, column_name, failures) of every not-null test (model, column),
    all tests of a table counted in one pass over it."""
    columns: dict[str, list[str]] = {}
    for model, column in tests:
        columns.setdefault(model, []).append(column)
    parts = [null_counts(tables[model], {c: c for c in names}).select(F.explode(F.array(*[
                 F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.col(c).alias("failures"))
                 for c in names])).alias("r")).select("r.*")
             for model, names in columns.items()]
    return reduce(DataFrame.unionByName, parts)


def as_text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")
