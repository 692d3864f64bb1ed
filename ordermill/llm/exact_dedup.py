"""Exact deduplication by skew-safe combining.

Three stages, each comparing full contents (a digest only routes rows):

1. local: a task keeps one winner per distinct text of a bounded window of
   its rows and sends the text on once, as a lossless zstd frame (equal texts
   give equal frames with one library version on the cluster);
2. salted: local winners meet by (digest, salt, content), so a group holding
   a third of all rows is spread over ``SALTS`` reducers;
3. global: at most ``SALTS`` salt winners of a text meet by digest.

Rows find their group back over the id of their local winner, a key that at
most one window of rows shares. Two texts with one digest stay two groups:
their rows are routed by content as well.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialise, text_of

SALTS = 16
WINDOW_BYTES = 32 << 20
WINDOW_ROWS = 200_000
_LOCAL = ("uid long, doc_id long, local_uid long, text_sha256 binary, digest binary, "
          "n long, content binary")
_SCHEMA = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("local_uid", pa.int64()),
                     ("text_sha256", pa.binary()), ("digest", pa.binary()), ("n", pa.int64()),
                     ("content", pa.binary())])


def _local_stage(digest_bytes: int, window_bytes: int):
    def flush(groups: dict, rows: list):
        packer = zstandard.ZstdCompressor(level=3, write_checksum=False)
        columns = [[] for _ in _SCHEMA]
        for uid, doc_id, text in rows:
            group = groups[text]
            won = group[1] == uid
            values = (uid, doc_id, group[1], group[3], group[3][:digest_bytes],
                      group[2] if won else None, packer.compress(text) if won else None)
            for column, value in zip(columns, values):
                column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        groups, rows, held = {}, [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text.encode()
                rank = (doc_id is not None, doc_id or 0)
                uid, base = base, base + 1
                group = groups.get(text)
                if group is None:
                    group = groups[text] = [rank, uid, 0, hashlib.sha256(text).digest(), text]
                    held += len(text)
                elif rank >= group[0]:
                    group[0], group[1] = rank, uid
                group[2] += 1
                rows.append((uid, doc_id, group[4]))  # one bytes object per distinct text
                if held >= window_bytes or len(rows) >= WINDOW_ROWS:
                    yield flush(groups, rows)
                    groups, rows, held = {}, [], 0
        if rows:
            yield flush(groups, rows)

    return run


def exact_dedup(docs: DataFrame, digest_bytes: int = 32,
                window_bytes: int = WINDOW_BYTES) -> DataFrame:
    """One row per row of ``docs`` (columns ``doc_id``, ``text``; others ignored):
    doc_id, keep_id, group_size, kept, text_sha256 (lowercase hex).

    Null text counts as empty; null doc_id loses to any id; of rows repeating
    id and text exactly one is kept. An empty table gives no rows.
    ``digest_bytes`` shortens the routing digest (tests force collisions).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    local = materialise(
        rows.mapInArrow(_local_stage(digest_bytes, window_bytes), _LOCAL), "exact_dedup_local")
    winners = local.where("uid = local_uid")
    best = F.max(F.struct("doc_id", "uid")).alias("best")
    salted = (winners.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)))
              .groupBy("digest", "salt", "content").agg(best, F.sum("n").alias("n")))
    whole = (salted.select("digest", "content", "best.doc_id", "best.uid", "n")
             .repartition("digest").groupBy("digest", "content").agg(best, F.sum("n").alias("n")))
    variants = F.count(F.lit(1)).over(Window.partitionBy("digest"))
    groups = materialise(
        whole.withColumn("variants", variants).select(
            "digest", "variants", F.col("best.doc_id").alias("keep_id"),
            F.col("best.uid").alias("keep_uid"), F.col("n").alias("group_size"),
            F.when(F.col("variants") > 1, F.col("content")).alias("content")), "exact_dedup_groups")
    out = ["uid", "keep_id", "keep_uid", "group_size"]
    plain = (winners.select("uid", "digest")
             .join(groups.where("variants = 1").drop("content"), "digest").select(*out))
    clashing = groups.where("variants > 1")
    if not clashing.isEmpty():      # contents travel again only where a digest cannot tell them apart
        plain = plain.unionByName(winners.select("uid", "digest", "content")
                                  .join(clashing, ["digest", "content"]).select(*out))
    routes = plain.withColumnRenamed("uid", "local_uid")
    return (local.select("uid", "doc_id", "local_uid", "text_sha256").join(routes, "local_uid")
            .select("doc_id", "keep_id", "group_size",
                    (F.col("uid") == F.col("keep_uid")).alias("kept"),
                    F.lower(F.hex("text_sha256")).alias("text_sha256")))
