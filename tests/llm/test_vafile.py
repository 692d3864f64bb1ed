from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from ordermill.llm import vafile

SCHEMA = "vec_id long, embedding array<double>, row long, cells string, cluster string"


def brute(rows, clusters=40, rounds=5, dimensions=64, seed=2):
    kept = []
    for vec_id, x in rows:
        if x is None or len(x) != dimensions or any(c is None or not math.isfinite(c) for c in x):
            continue
        v = [math.floor(256 * c) for c in x]
        if all(abs(256 * c) < vafile.LIMIT for c in x):
            kept.append((vec_id, v))
    def key(r):
        return hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]
    centroids = [r[1] for r in sorted(kept, key=key)[:clusters]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        got = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (k, _) in zip(kept, got) if k == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    got = assign()
    total = sum(d for _, d in got)
    return sorted((repr(i), c, d, sum(e for k, e in got if k == c), total,
                   hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                  for (i, _), (c, d) in zip(kept, got))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, x, 1, "x", "y") for i, x in rows], SCHEMA)
    return sorted((repr(r[0]), *r[1:]) for r in vafile.cluster_vectors(df, **kw).collect())


def blobs(n, dimensions, groups, seed):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, dimensions))
    return [(k, (middles[k % groups] + rng.normal(scale=0.1, size=dimensions)).tolist()) for k in range(n)]


@pytest.mark.parametrize("groups,bits", [(5, 3), (60, 6)])
def test_equals_brute_force(spark, groups, bits):
    rows = blobs(120, 8, groups, groups)
    kw = dict(clusters=7, rounds=3, dimensions=8)
    assert run(spark, rows, bits=bits, **kw) == brute(rows, **kw)


def test_odd_rows(spark):
    x = [0.5] * 64
    rows = [(1, x), (1, x), (None, x), (2, [-0.25] * 64), (3, x[:63]), (4, x + [1.0]), (5, None), (6, []),
            (7, [None] + x[1:]), (8, [math.nan] + x[1:]), (9, [math.inf] + x[1:]), (10, [1e30] + x[1:]),
            (11, [-524287.0, 524287.0] * 32), (12, [0.0] * 64)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert len(got) == 6


def test_empty_table(spark):
    assert run(spark, []) == []


def test_clusters_that_lose_their_vectors_keep_their_place(spark):
    rows = [(k, [float(k % 2)] * 4) for k in range(10)]
    kw = dict(clusters=6, rounds=2, dimensions=4)
    assert run(spark, rows, **kw) == brute(rows, **kw)


def test_cells_pack_and_intervals_hold_the_distances():
    rng = random.Random(3)
    v = np.array([[rng.randint(-200, 200) for _ in range(5)] for _ in range(300)])
    marks = np.sort(np.quantile(v, np.arange(1, 8) / 8, axis=0).astype(np.int64), axis=0).T.copy()
    cells = vafile.cells_of(v, marks)
    assert (vafile.unpack_cells(vafile.pack_cells(cells, 3), 5, 3) == cells).all()
    centroids = v[:9]
    flags = vafile.Intervals(centroids, v.min(axis=0), v.max(axis=0), marks).overlapping(cells)
    d = ((v[:, None] - centroids) ** 2).sum(axis=2)
    assert flags[np.arange(len(v)), d.argmin(axis=1)].all()
    assert flags.sum() < flags.size                       # and they leave centroids out


def test_histogram_values_are_few():
    v = np.arange(-vafile.LIMIT, vafile.LIMIT, 7919)
    low = vafile._rounded(v)
    assert (low <= v).all() and len(np.unique(low)) < 1600
