"""Live business metrics over the landing table of streamed orders.

Each function reads the whole landing table (or a trailing slice of it) in
batch, so every row counts however late it arrived; the incremental twin
is ``ordermill.streaming.hourly``. Every "now" is the ``as_of`` argument
(``None`` = wall clock). Trailing-window filters compare the event time to
``as_of`` and reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.money import exact_sum, money_of, rounded_mean, to_double
from ordermill.functions.time import (day_name, hour_bucket, hour_of_day, ingest_hour, interval,
                                      period_filter, period_start, resolve_as_of,
                                      within_last)

TS = "order_timestamp"
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"       # Spark's folder of a null partition value


def latest_order_time(orders: DataFrame) -> Column:
    """Scalar subquery: the newest order time of the table (a reproducible as_of)."""
    return orders.select(F.max(TS)).scalar()


def newest_order_time(orders: DataFrame) -> Column | str:
    """The newest order time as a literal, by a job of its own: the plans that
    use it are small and their filters reach the scan."""
    newest = orders.agg(F.max(TS).cast("string")).first()[0]
    return F.lit(None).cast("timestamp_ntz") if newest is None else newest


def _since(orders: DataFrame, start: Column) -> DataFrame:
    """Rows with ``order_timestamp >= start``; on a table partitioned by
    ``order_date`` (see ``streaming.ingest.compact_landing``) the matching
    date predicate is added too, so whole date partitions are skipped."""
    rows = orders.where(F.col(TS) >= start)
    if "order_date" in orders.columns:
        rows = rows.where(F.col("order_date") >= F.to_date(start))
    return rows


def _revenue(orders: DataFrame) -> Column:
    return exact_sum(money_of(orders, "price") * F.col("quantity"))


def kpi_last_hour(orders: DataFrame, as_of=None) -> DataFrame:
    """One row: orders, items, mean unit price (2 decimals), active sellers
    in the hour before ``as_of``. SUM over no rows is NULL, COUNT is 0."""
    as_of = resolve_as_of(as_of)
    recent = _since(orders, as_of - interval(1, "hour"))
    return recent.agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.sum("quantity").alias("items_count"),
        rounded_mean(money_of(orders, "price"), 2).alias("avg_value"),
        F.countDistinct("seller_id").alias("sellers_count"))


def hourly_series(orders: DataFrame) -> DataFrame:
    """Per clock hour with orders: order count, revenue, items."""
    return (orders.groupBy(hour_bucket(TS).alias("hour"))
            .agg(F.count(F.lit(1)).alias("orders_count"),
                 to_double(_revenue(orders)).alias("total_revenue"),
                 F.sum("quantity").alias("items_count")))


def hourly_metrics(orders: DataFrame, hours: int = 24) -> DataFrame:
    """The newest ``hours`` hours that have orders (gaps are not filled)."""
    return hourly_series(orders).orderBy(F.col("hour").desc_nulls_first()).limit(hours)


def newest_hours(orders: DataFrame, dates: list[str], hours: int = 24) -> DataFrame:
    """:func:`hourly_metrics` of a table partitioned by ``order_date``, whose
    partition values are ``dates`` (ascending, see ``files.partition_values``).

    Walks back from the newest date, one more, then two, four and so on, until
    the dates read hold ``hours`` hours with orders, so a long history is not
    read for its last day.
    """
    known = [d for d in dates if d != _NO_DATE]
    taken = 1
    while True:
        recent = orders
        if taken < len(known):
            first = F.lit(known[-taken]).cast("date")
            after = F.col("order_date") >= first
            recent = orders.where(after | F.col("order_date").isNull() if _NO_DATE in dates else after)
            if hourly_series(recent).count() < hours:
                taken *= 2
                continue
        return hourly_metrics(recent, hours)


def top_sellers(orders: DataFrame, period: str = "hour", as_of=None, k: int = 10) -> DataFrame:
    """The ``k`` sellers with the most revenue in a dashboard period.

    Periods: 'hour' (rolling hour), 'today' (calendar day of ``as_of``),
    'week' (rolling seven days); anything else raises ValueError. Ties on
    revenue go to the smaller seller id.
    """
    as_of = resolve_as_of(as_of)
    rows = _since(orders, period_start(period, as_of)).where(period_filter(period, TS, as_of))
    return (rows.groupBy("seller_id")
            .agg(to_double(_revenue(orders)).alias("revenue"))
            .orderBy(F.col("revenue").desc_nulls_first(), F.col("seller_id").asc_nulls_last())
            .limit(k))


def weekday_hour_heatmap(orders: DataFrame) -> DataFrame:
    """Order counts by weekday name and hour of day, long form."""
    return (orders.groupBy(day_name(TS).alias("day_of_week"),
                           hour_of_day(TS).alias("hour_of_day"))
            .agg(F.count(F.lit(1)).alias("order_count")))


# --- sales spikes (our rule; the warehouse procedure has no published body) --

def _exact_variance(n: Column, s: Column, ss: Column) -> Column:
    """Sample variance from count, sum and sum of squares of integers.

    The numerator n*ss - s*s is formed exactly in DECIMAL(38,0) and divided
    once, so the result does not depend on the order of the rows.
    """
    wide = "decimal(38,0)"
    num = n.cast(wide) * ss.cast(wide) - s.cast(wide) * s.cast(wide)
    den = n.cast(wide) * (n - 1).cast(wide)
    return F.when(n >= 2, num.cast("double") / den.cast("double"))


def sales_spike_hours(orders: DataFrame, lookback_hours: int = 24,
                      sigmas: float = 2.0) -> DataFrame:
    """Per clock hour with orders: is its order count a spike?

    A spike is an hour whose count exceeds mean + ``sigmas`` x sample
    standard deviation of the counts of the hours with orders among the
    ``lookback_hours`` clock hours before it. With fewer than two such
    hours the hour is never a spike.

    Distributed as an equi-join: each hourly row is sent to the
    ``lookback_hours`` later hours it is history for (a fixed fan-out, not
    all pairs), then the history is aggregated per target hour. No global
    window, so no single task holds the whole series.
    """
    hourly = orders.groupBy(hour_bucket(TS).alias("hour")).agg(
        F.count(F.lit(1)).alias("orders_count"))
    offsets = F.sequence(F.lit(1), F.lit(lookback_hours))
    history = (hourly
               .select(F.explode(offsets).alias("offset"), "hour", "orders_count")
               .select((F.col("hour") + F.make_dt_interval(hours=F.col("offset"))).alias("hour"),
                       F.col("orders_count").alias("past"))
               .groupBy("hour")
               .agg(F.count(F.lit(1)).alias("prior_hours"),
                    F.sum("past").alias("s"),
                    F.sum(F.col("past") * F.col("past")).alias("ss")))
    j = hourly.join(history, "hour", "left")
    n = F.coalesce(F.col("prior_hours"), F.lit(0))
    mean = F.when(n > 0, F.col("s").cast("double") / n)
    stddev = F.sqrt(_exact_variance(n, F.col("s"), F.col("ss")))
    threshold = mean + F.lit(sigmas) * stddev
    return j.select(
        "hour", "orders_count", n.alias("prior_hours"),
        mean.alias("prior_mean"), stddev.alias("prior_stddev"),
        F.coalesce(F.col("orders_count") > threshold, F.lit(False)).alias("is_spike"))


def sales_spike_status(orders: DataFrame, as_of=None, lookback_hours: int = 24,
                       sigmas: float = 2.0) -> DataFrame:
    """One row: the spike status of the clock hour containing ``as_of``.

    ``status`` starts with 'ALERT' for a spike and 'OK' otherwise. Only the
    last ``lookback_hours`` + 1 hours are read (a pushed-down time range).
    """
    current = hour_bucket(resolve_as_of(as_of))
    if isinstance(as_of, Column):          # one value, however often the plan uses it
        current = orders.sparkSession.range(1).select(current.alias("hour")).scalar()
    recent = (_since(orders, current - interval(lookback_hours, "hour"))
              .where(F.col(TS) < current + interval(1, "hour")))
    spikes = sales_spike_hours(recent, lookback_hours, sigmas)
    now = spikes.where(F.col("hour") == current).agg(
        F.max("orders_count").alias("orders_count"),
        F.max("is_spike").alias("is_spike"))
    count = F.coalesce(F.col("orders_count"), F.lit(0))
    text = F.concat(count.cast("string"), F.lit(" orders in hour "), current.cast("string"))
    return now.select(
        current.alias("hour"), count.alias("orders_count"),
        F.when(F.coalesce(F.col("is_spike"), F.lit(False)),
               F.concat(F.lit("ALERT: sales spike, "), text))
         .otherwise(F.concat(F.lit("OK: "), text)).alias("status"))


def recent_inserts(orders: DataFrame, as_of=None, minutes: int = 5) -> DataFrame:
    """One row: rows inserted in the ``minutes`` before ``as_of``. Of a table
    partitioned by ``ingest_hour`` (the landing table) only the hours since
    then are read."""
    as_of = resolve_as_of(as_of)
    rows = orders.where(within_last("insert_timestamp", as_of, minutes, "minute"))
    if "ingest_hour" in orders.columns:
        rows = rows.where(F.col("ingest_hour") >= ingest_hour(as_of - interval(minutes, "minute")))
    return (rows
            .agg(F.count(F.lit(1)).alias("recent_orders")))


def monitor_status(orders: DataFrame, as_of=None) -> DataFrame:
    """The five-minute monitor record: recent inserts and spike status."""
    as_of = resolve_as_of(as_of)
    recent = recent_inserts(orders, as_of).select("recent_orders").scalar()
    return sales_spike_status(orders, as_of).select(
        recent.alias("recent_orders"), F.col("status").alias("spike_status"))
