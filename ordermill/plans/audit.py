"""Plan shapes of the registered queries: ``python -m ordermill.plans.audit``.

For each query, prints the number of hash exchanges (shuffles), the join
strategies and aggregate operators of its physical plan, from
``DataFrame.explain()``; nothing is executed. ``--no-broadcast`` plans as if
every join side were large, which is the shape at cluster scale. This is
how the plan table in README.md is produced.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import re

from ordermill.session import build_session

_JOINS = r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
_AGGS = r"(HashAggregate|SortAggregate|ObjectHashAggregate)"


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def shape(plan: str) -> dict:
    return {
        "hash_exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning)", plan)),
        "joins": re.findall(_JOINS, plan),
        "aggregates": sorted(set(re.findall(_AGGS, plan))),
        "expand": "Expand" in plan,
        "window": "Window [" in plan,
    }


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="ordermill.plans.audit")
    p.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.1")
    p.add_argument("--no-broadcast", action="store_true")
    args = p.parse_args(argv)
    conf = {"spark.sql.shuffle.partitions": "8"}
    if args.no_broadcast:
        conf.update({"spark.sql.autoBroadcastJoinThreshold": "-1",
                     "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark = build_session("local[*]", "ordermill-audit", conf)
    from ordermill.plans.catalog import QUERIES
    for name, query in QUERIES.items():
        if name == "stream_hourly":  # runs a stream to produce its result
            continue
        s = shape(plan_text(query(spark, args.sf_dir)))
        print(f"{name:24s} exchanges={s['hash_exchanges']:2d} joins={s['joins']} "
              f"aggregates={s['aggregates']} expand={s['expand']} window={s['window']}")


if __name__ == "__main__":
    main()
