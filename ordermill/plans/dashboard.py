"""The dashboard's panels in one pass over the orders: what a page shows, as data.

``panels`` gives the four panels (last-hour indicators, hourly series, top
sellers of a period, weekday by hour), ``as_rows`` all of them as one table of
(panel, item, measure, value), the form that charts and JSON feeds take.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.operators import realtime

# The columns that name a panel's items; its other columns are measures.
ITEMS: dict[str, tuple[str, ...]] = {
    "kpi": (), "hourly": ("hour",), "top_sellers": ("seller_id",), "heatmap": ("day_of_week", "hour_of_day")}


def panels(orders: DataFrame, as_of: Column | str | None = None, period: str = "hour",
           dates: list[str] | None = None) -> dict[str, DataFrame]:
    """The panels by name. ``dates``: the date partitions of ``orders``, if it is
    the table of ``ingest.compact_landing``; the hourly series then reads the
    newest dates alone."""
    hourly = realtime.newest_hours(orders, dates) if dates else realtime.hourly_metrics(orders)
    return {"kpi": realtime.kpi_last_hour(orders, as_of), "hourly": hourly,
            "top_sellers": realtime.top_sellers(orders, period, as_of),
            "heatmap": realtime.weekday_hour_heatmap(orders)}


def as_rows(shown: Mapping[str, DataFrame]) -> DataFrame:
    """(panel, item, measure, value): a row per measure of each row of the
    panels; ``item`` is empty where a panel is one row. At most 24 hours, ten
    sellers and 168 weekday hours, whatever the size of the orders."""
    parts = []
    for name, df in shown.items():
        named = ITEMS[name]
        measures = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
                    for c in df.columns if c not in named]
        item = F.concat_ws(" ", *[F.col(c).cast("string") for c in named]) if named else F.lit("")
        parts.append(df.select(F.lit(name).alias("panel"), item.alias("item"), F.inline(F.array(*measures))))
    return reduce(DataFrame.unionByName, parts)
