"""The five-minute live monitor (M10, T6): freshness first, then the spike status.

One small action: the one-row monitor record is fetched to the driver, the
run fails when no order arrived in the freshness window, and otherwise the
record is returned for the scheduler to log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ordermill.operators.realtime import monitor_status


def health_check(orders: DataFrame, as_of=None) -> dict:
    """``{"recent_orders": n, "spike_status": text}``; raises if n == 0."""
    row = monitor_status(orders, as_of).first()
    if not row["recent_orders"]:
        raise ValueError("no new orders in the last 5 minutes")
    return {"recent_orders": row["recent_orders"], "spike_status": row["spike_status"]}
