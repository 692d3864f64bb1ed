"""Keep one row per key: the latest by an ordering, ties broken totally.

The warehouse form is ``FIRST_VALUE(col) OVER (PARTITION BY key ORDER BY ts
DESC)`` for every attribute, then DISTINCT. A window sorts each key's rows
inside one task, so a key holding a third of the table becomes one huge
task. Here the pick is an aggregate, ``max(struct(order..., rest...))``:
every map task reduces its rows to one candidate per key before the
shuffle, and the final merge sees one row per key per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NULL_FLAG = "__first_is_null"


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                nulls_first: bool = True) -> DataFrame:
    """One row per ``keys``: the greatest ``order_by`` tuple wins.

    All ordering columns are descending. A NULL in the first one ranks
    highest when ``nulls_first`` (the warehouse's ``DESC`` default) and
    lowest otherwise; NULLs in later columns rank lowest. The remaining
    columns break any tie that is left, in column order, so the pick is
    deterministic. Output columns keep the input order.
    """
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    head = [F.col(order_by[0]).isNull().alias(_NULL_FLAG)] if nulls_first else []
    packed = F.struct(*head, *[F.col(c) for c in order_by + rest])
    picked = df.groupBy(*keys).agg(F.max(packed).alias("__pick"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__pick.{c}").alias(c)
                           for c in df.columns])
