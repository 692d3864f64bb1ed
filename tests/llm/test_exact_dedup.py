from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from ordermill.llm.exact_dedup import exact_dedup


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        kept = 1
        for i in ids:
            mine = i == keep and kept > 0
            kept -= mine
            out.append((i, keep, len(ids), mine, hashlib.sha256(text.encode()).hexdigest()))
    return out


def run(df, **kw):
    return [tuple(r) for r in exact_dedup(df, **kw).collect()]


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_equals_brute_force_with_collisions_and_small_windows(make_docs, digest_bytes):
    rows = [(i, f"t{i % 7}") for i in range(200)] + [(500 + i, f"u{i}") for i in range(300)]
    rows += [(None, "t1"), (None, "only null id"), (3, "t3"), (900, None), (901, ""), (902, "x" * 200_000),
             (903, "x" * 200_000), (904, "x" * 199_999 + "y")]
    got = run(make_docs(rows).repartition(5), digest_bytes=digest_bytes, window_bytes=1000)
    assert order(got) == order(brute(rows))


def test_hot_group_keeps_one_row(spark):
    docs = spark.range(0, 6000, 1, 16).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"),
        F.lit("clash").alias("digest"), F.lit(1).alias("salt"), F.lit(2).alias("uid"))
    out = exact_dedup(docs)
    hot = out.where("group_size > 1")
    assert hot.count() == 2000 and hot.where("kept").collect()[0]["doc_id"] == 5997
    assert out.where("kept").count() == 4001


def test_empty(make_docs):
    out = exact_dedup(make_docs([]))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert out.count() == 0
