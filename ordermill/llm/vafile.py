"""Centroid clustering over a vector-approximation file.

Vectors are integers and lie in two tables: ``full`` holds them whole, the
approximation file holds a cell of ``BITS`` bits per dimension. The marks
between cells are equal-population cuts of counts over all vectors. For each
round, lookup tables give the least and the greatest squared difference
between a cell and a centroid's component; their sums are intervals that the
true distances lie in. Where one centroid's interval lies below all others the
cell row alone decides; only where intervals overlap, or a vector moves to
another cluster, is the whole vector fetched by a join, and compared with the
overlapping centroids alone. Sums per cluster are kept exactly: a moved vector
is taken from its old cluster and added to the new one, so vectors that stay
are not read again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialise

DIMENSIONS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
BITS = 6
LIMIT = 1 << 27          # of an integer component: squared distances stay within 64 bits
_TOP = 5                 # significant bits, besides the first, that histograms keep
_ROWS = 2048             # rows compared at a time


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the usable vectors with components floor(scale * x)."""
    x = F.col("embedding").cast("array<double>")
    usable = (F.size(x) == dimensions) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < LIMIT))
    return (vectors.where(x.isNotNull() & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c * scale).cast("int")).alias("v")))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """A list column of ``dimensions`` integers a row."""
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, dimensions)


# --- marks ---------------------------------------------------------------------

def _rounded(v: np.ndarray) -> np.ndarray:
    """Towards minus infinity to a value with few significant bits."""
    drop = np.maximum(np.frexp(np.abs(v).astype(np.float64))[1] - 1 - _TOP, 0)
    return (v >> drop) << drop


def _histogram(dimensions: int):
    def run(batches):
        for batch in batches:
            v = _rounded(matrix(batch.column(0), dimensions))
            for d in range(dimensions):
                value, n = np.unique(v[:, d], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(value), d)), pa.array(value), pa.array(n)], names=["d", "value", "n"])
    return run


def cell_marks(full: DataFrame, dimensions: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least value, greatest value and (2^bits - 1) marks of each dimension.
    Cell c holds the values from mark c - 1 up to, and without, mark c."""
    counts = full.select("v").mapInArrow(_histogram(dimensions), "d long, value long, n long")
    # values of six significant bits: below 1,600 a dimension, however many vectors there are
    counts = counts.groupBy("d", "value").agg(F.sum("n").alias("n")).toArrow()
    ends = full.select([f(F.col("v")[d]) for f in (F.min, F.max) for d in range(dimensions)]).first()
    d, value, n = (counts[c].to_numpy() for c in ("d", "value", "n"))
    marks = np.zeros((dimensions, (1 << bits) - 1), np.int64)
    for k in range(dimensions):
        own = d == k
        order = np.argsort(value[own])
        values, upto = value[own][order], np.cumsum(n[own][order])
        wanted = np.arange(1, 1 << bits) * upto[-1] / (1 << bits)
        marks[k] = values[np.minimum(np.searchsorted(upto, wanted), len(values) - 1)]
    return np.array(ends[:dimensions], np.int64), np.array(ends[dimensions:], np.int64), marks


def cells_of(v: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(m, v[:, d], "right") for d, m in enumerate(marks)], axis=1).astype(np.uint8)


def pack_cells(cells: np.ndarray, bits: int) -> list[bytes]:
    flags = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - bits:]
    return [r.tobytes() for r in np.packbits(flags.reshape(len(cells), -1), axis=1)]


def unpack_cells(packed: list[bytes], dimensions: int, bits: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
    flags = np.unpackbits(rows, axis=1, count=dimensions * bits).reshape(len(packed), dimensions, bits)
    return np.packbits(flags, axis=2)[:, :, 0] >> np.uint8(8 - bits)


# --- intervals -------------------------------------------------------------------

class Intervals:
    """Distance intervals between cell rows and centroids, by lookup tables."""

    def __init__(self, centroids: np.ndarray, least, greatest, marks):
        low = np.concatenate((least[:, None], marks), axis=1)[None]             # (1, dimension, cell)
        high = np.concatenate((marks - 1, greatest[:, None]), axis=1)[None]
        c = centroids[:, :, None]
        near = np.maximum(0, np.maximum(low - c, c - high))
        far = np.maximum(np.abs(low - c), np.abs(high - c))
        self.low, self.high = [(t * t).transpose(1, 2, 0).copy() for t in (near, far)]   # (dimension, cell, centroid)

    def overlapping(self, cells: np.ndarray) -> np.ndarray:
        """(row, centroid) flags of the centroids that may be the nearest."""
        out = np.zeros((len(cells), self.low.shape[2]), bool)
        for a in range(0, len(cells), _ROWS):
            part = cells[a:a + _ROWS]
            low = np.zeros((len(part), self.low.shape[2]), np.int64)
            high = np.zeros_like(low)
            for d in range(part.shape[1]):
                low += self.low[d][part[:, d]]
                high += self.high[d][part[:, d]]
            out[a:a + _ROWS] = low <= high.min(axis=1, keepdims=True)
        return out


def nearest(v: np.ndarray, centroids: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance by the flagged centroids alone; of equally
    near ones the smaller number."""
    cluster, distance = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
    for a in range(0, len(v), _ROWS // 2):
        some = slice(a, a + _ROWS // 2)
        row, c = np.nonzero(flags[some])
        apart = v[some][row] - centroids[c]
        d = np.full(flags[some].shape, np.iinfo(np.int64).max)
        d[row, c] = np.einsum("ij,ij->i", apart, apart)
        cluster[some] = d.argmin(axis=1)
        distance[some] = d.min(axis=1)
    return cluster, distance


# --- rounds ------------------------------------------------------------------------

_STATE = "row long, cells binary, cluster long"


def _approximate(dimensions: int, bits: int, marks):
    def run(batches):
        for batch in batches:
            cells = cells_of(matrix(batch.column(1), dimensions), marks)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pack_cells(cells, bits), pa.binary()),
                 pa.array(np.full(len(cells), -1))], names=["row", "cells", "cluster"])
    return run


def _decide(dimensions: int, bits: int, tables: tuple):
    """Cell rows with their old cluster, the one that intervals give (null
    where they overlap) and the flags of the overlapping centroids."""
    def run(batches):
        intervals = Intervals(*tables)
        for batch in batches:
            if not batch.num_rows:
                continue
            flags = intervals.overlapping(unpack_cells(batch.column(1).to_pylist(), dimensions, bits))
            cluster = flags.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array(cluster, mask=flags.sum(axis=1) > 1),
                 pa.array([r.tobytes() for r in np.packbits(flags, axis=1)], pa.binary())],
                names=["row", "cells", "old", "cluster", "flags"])
    return run


def _flags(batch: pa.RecordBatch, name: str, k: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    return np.unpackbits(rows, axis=1, count=k).astype(bool)


def _settle(dimensions: int, centroids: np.ndarray):
    """Fetched rows with their cluster, and last, as rows without a number, the
    count and sums by which a task's rows change each cluster."""
    k = len(centroids)
    names = ["row", "cells", "cluster", "n", "sums"]

    def run(batches):
        sums, counts, touched = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64), np.zeros(k, bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("v"), dimensions)
            cluster, _ = nearest(v, centroids, _flags(batch, "flags", k))
            old = batch.column("old").to_numpy()
            moved = old != cluster
            for sign, at in ((1, cluster[moved]), (-1, old[moved])):
                known = at >= 0
                np.add.at(sums, at[known], sign * v[moved][known])
                np.add.at(counts, at[known], sign)
                touched[at[known]] = True
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("cells"), pa.array(cluster), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.list_(pa.int64()))], names=names)
        at = np.flatnonzero(touched)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary()), pa.array(at), pa.array(counts[at]),
             pa.array(sums[at].tolist(), pa.list_(pa.int64()))], names=names)
    return run


def _measure(dimensions: int, centroids: np.ndarray):
    def run(batches):
        for batch in batches:
            v = matrix(batch.column("v"), dimensions)
            cluster, distance = nearest(v, centroids, _flags(batch, "flags", len(centroids))) if len(v) else (v[:, 0], v[:, 0])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])
    return run


def first_centroids(full: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors whose ids hash smallest, in the order of their hashes; of
    equal ids the smallest vector first."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = full.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
                    scale: int = SCALE, seed: int = SEED, bits: int = BITS) -> DataFrame:
    """A row per usable vector (``vec_id``, ``embedding``): vec_id, cluster,
    distance (squared, of the integer vectors), cluster_inertia, inertia and
    the digest of its final centroid.

    Vectors of another length, or with a null or non-finite component, are left
    out; so are those with a component of which the integer is ``LIMIT`` or
    more, as their squared distances may not fit a long. Fewer vectors than
    ``clusters`` give fewer centroids; equal vectors, repeated rows and null
    ids take part like any other; of equally near centroids the smaller number
    wins; a cluster that loses its vectors keeps its centroid; an empty table
    gives no rows; an inertia beyond a long is null. Other columns are not read.
    """
    spark = vectors.sparkSession
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    full = materialise(integer_vectors(vectors, dimensions, scale)
                       .withColumn("row", F.monotonically_increasing_id()), "vectors")
    centroids = first_centroids(full, clusters, seed)
    k = len(centroids)
    if not k:
        return spark.createDataFrame([], out)
    least, greatest, marks = cell_marks(full, dimensions, bits)
    state = materialise(full.select("row", "v").mapInArrow(_approximate(dimensions, bits, marks), _STATE), "cells")
    sums, counts = np.zeros((k, dimensions), object), np.zeros(k, object)
    decided = "row long, cells binary, old long, cluster long, flags binary"
    for _ in range(rounds):
        tables = (centroids, least, greatest, marks)
        seen = materialise(state.mapInArrow(_decide(dimensions, bits, tables), decided), "decided")
        stays = F.coalesce(F.col("cluster") == F.col("old"), F.lit(False))
        fetched = seen.where(~stays).join(full.select("row", "v"), "row")
        settled = materialise(fetched.select("row", "cells", "old", "flags", "v").mapInArrow(
            _settle(dimensions, centroids), f"{_STATE}, n long, sums array<long>"), "settled")
        changes = settled.where("row IS NULL")
        exact = [F.sum(c.cast("decimal(38,0)")) for c in (F.col("n"), *[F.col("sums")[d] for d in range(dimensions)])]
        for c, n, *by in changes.groupBy("cluster").agg(*exact).collect():          # a row per cluster
            counts[c] += int(n)
            sums[c] += [int(x) for x in by]
        centroids = np.array([[int(s) // int(counts[c]) for s in sums[c]] if counts[c] else centroids[c].tolist()
                              for c in range(k)], np.int64)
        state = seen.where(stays).select("row", "cells", "cluster").unionByName(
            settled.where("row IS NOT NULL").select("row", "cells", "cluster"))
    seen = state.mapInArrow(_decide(dimensions, bits, (centroids, least, greatest, marks)), decided).select("row", "flags")
    found = materialise(seen.join(full, "row").select("vec_id", "flags", "v").mapInArrow(
        _measure(dimensions, centroids), "vec_id long, cluster long, distance long"), "clustered")
    inertia = {c: int(d) for c, d in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}

    def fits(n: int):
        return n if n < 1 << 63 else None
    rows = [(c, fits(d), fits(sum(inertia.values())),
             hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, d in inertia.items()]
    named = spark.createDataFrame(rows, "cluster long, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select(       # a row per cluster
        "vec_id", F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256")
