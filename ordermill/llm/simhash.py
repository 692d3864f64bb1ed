"""SimHash near-duplicate detection by tiled exact comparison.

Distinct fingerprints are dealt into buckets that share two of four 16-bit
blocks: two fingerprints at distance ``RADIUS`` = 2 or less always share two
blocks, so no link is lost. Inside a bucket, fingerprints sorted by population
count form tiles that numpy compares with exclusive-or and bit counts; parts
whose population counts differ by more than the radius are skipped, as they
cannot link. A bucket beyond ``TILE`` rows is cut into tiles of one
population count and a salt, and its pairs of tiles become separate rows of
work. A comparison emits a spanning forest of the links it finds, never all
pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise, text_of
from .graph import components

SHINGLE = 3
RADIUS = 2
SEED = 42
BLOCKS = 4
TILE = 4096
_STEP = 1 << 16           # shingles hashed at a time
# bit pattern of each byte value, most significant bit first
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_COLUMN = (np.arange(8, dtype=np.int32) * 256)[None, :]


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text; 0 without words.

    Only A-Z are lower-cased; words are runs of anything but ASCII white
    space; a text of fewer words than a shingle is one shingle.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    ones = np.zeros((8, 8), np.int64)          # by byte and bit of the hash
    for k in range(0, len(starts), _STEP):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in
                           zip(starts[k:k + _STEP].tolist(), ends[k:k + _STEP].tolist())])
        cells = np.frombuffer(hashes, np.uint8).reshape(-1, 8) + _COLUMN
        ones += np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: Column | None = None) -> DataFrame:
    """(doc_id, row_key, fp) of each row; fp as a signed 64-bit integer."""
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()],
                           np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                names=["doc_id", "row_key", "fp"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        (F.lit(0) if key is None else key).cast("long").alias("row_key"), text_of("text").alias("text"))
            .mapInArrow(run, "doc_id long, row_key long, fp long"))


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges (positions) of a spanning forest of the links among ``fps``.

    Breadth first over the positions not reached yet, kept sorted by
    population count: a fingerprint is compared with the slice within the
    radius only, and whatever it reaches leaves the array, so all-near groups
    cost a pass and not a square.
    """
    pops = np.bitwise_count(fps)
    order = np.argsort(pops, kind="stable")
    fps, pops = fps[order], pops[order].astype(np.int64)
    left = np.arange(len(fps))
    edges = []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            lo, hi = np.searchsorted(pops[left], (pops[at] - radius, pops[at] + radius + 1))
            near = np.bitwise_count(fps[left[lo:hi]] ^ fps[at]) <= radius
            if near.any():
                hits = left[lo:hi][near].tolist()
                left = np.concatenate((left[:lo], left[lo:hi][~near], left[hi:]))
                edges += [(int(order[at]), int(order[h])) for h in hits]
                queue += hits
    return edges


def _compare(radius: int):
    """Forests of the buckets in a partition sorted by (bucket keys, fp)."""
    def edges_of(fps: np.ndarray, cuts: np.ndarray, out: list):
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a > 1:
                part = fps[a:b]
                out += [(int(part[i]), int(part[j])) for i, j in forest(part.view(np.uint64), radius)]

    def run(batches):
        held = None                                     # the last, open bucket
        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns])
            rows = rows if held is None else np.concatenate((held, rows), axis=1)
            if not rows.shape[1]:
                continue
            keys = rows[:-1]
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            out: list = []
            edges_of(rows[-1], np.concatenate(([0], cuts)), out)
            held = rows[:, last:]
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in out], _EDGE)
        if held is not None and held.shape[1]:
            out = []
            edges_of(held[-1], np.array([0, held.shape[1]]), out)
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in out], _EDGE)

    return run


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) between fingerprints that connect exactly what links at
    ``radius`` or fewer differing bits. ``distinct``: one column ``fp``."""
    blocks = max(BLOCKS, radius + 1)
    width, share = 64 // blocks, blocks - radius
    masks = []
    for chosen in combinations(range(blocks), share):
        bits = sum(((1 << (64 - (blocks - 1) * width if b == blocks - 1 else width)) - 1) << (b * width)
                   for b in chosen)
        masks.append(bits - (1 << 64) if bits >> 63 else bits)
    keyed = distinct.select("fp", F.bit_count("fp").cast("long").alias("pop"), F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("mask", "key")
    ).withColumn("mask", F.col("mask").cast("long"))
    sizes = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"))
    hot = materialise(sizes.where(F.col("n") > tile).select("mask", "key"), "simhash_hot")
    cold = keyed.join(hot, ["mask", "key"], "left_anti").select("mask", "key", "fp")
    edges = (cold.repartition("mask", "key").sortWithinPartitions("mask", "key")
             .mapInArrow(_compare(radius), "a long, b long"))
    if hot.isEmpty():
        return edges
    # tiles of one population count and a salt; pairs of tiles within the radius
    rows = keyed.join(hot, ["mask", "key"])
    cells = rows.groupBy("mask", "key", "pop").agg(
        F.ceil(F.count(F.lit(1)) / (tile / 2)).cast("long").alias("salts"))
    rows = rows.join(cells, ["mask", "key", "pop"]).withColumn(
        "salt", F.pmod(F.xxhash64("fp"), F.col("salts")))
    tiles = cells.select("mask", "key", "pop", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    left, right = tiles.alias("l"), tiles.alias("r")
    pairs = left.join(right, (F.col("l.mask") == F.col("r.mask")) & (F.col("l.key") == F.col("r.key"))
                      & (F.col("r.pop") - F.col("l.pop")).between(0, radius)
                      & (F.struct("l.pop", "l.salt") <= F.struct("r.pop", "r.salt")))
    ends = [pairs.select("l.mask", "l.key", F.xxhash64("l.pop", "l.salt", "r.pop", "r.salt").alias("pair"),
                         F.col(f"{s}.pop").alias("pop"), F.col(f"{s}.salt").alias("salt")) for s in "lr"]
    work = (rows.join(ends[0].unionByName(ends[1]).distinct(), ["mask", "key", "pop", "salt"])
            .select("mask", "key", "pair", "fp").repartition("mask", "key", "pair")
            .sortWithinPartitions("mask", "key", "pair"))
    return edges.unionByName(work.mapInArrow(_compare(radius), "a long, b long"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, key: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_key (``key``, or 0), fp, and
    component_id, the smallest doc_id reachable over fingerprints that differ
    in at most ``radius`` bits.

    Null and blank texts have fingerprint 0 and link like any other; a null
    doc_id takes part but never names a component that has an id; repeated
    rows stay; an empty table gives no rows.
    """
    prints = materialise(fingerprints(docs, shingle, key), "simhash_prints")
    firsts = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash_firsts")
    roots = components(links(firsts.select("fp"), radius))
    rooted = (firsts.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", "first", F.coalesce("component", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    salts = 16                                          # a fingerprint may hold a third of the rows
    return (prints.withColumn("salt", F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(salts)))
            .join(classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))),
                  ["fp", "salt"])
            .select("doc_id", "row_key", "fp", "component_id"))


def hex_fingerprint(name: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(name)), 16, "0"))
