from __future__ import annotations

import math

import numpy as np

from ordermill.llm import vamana

SCHEMA = "vec_id long, embedding array<double>, v string, shard string, rank string, block int"


def brute(rows, every=100, k=10):
    sound = {(i, tuple(x)) for i, x in rows if i is not None and x and all(c is not None and math.isfinite(c) for c in x) and any(x)}
    out = []
    for i, x in sound:
        if i % every == 0:
            found = sorted((float(np.sqrt(((np.array(y) - np.array(x)) ** 2).sum())), j) for j, y in sound
                           if (j, y) != (i, x) and len(x) == len(y))
            out += [(i, r + 1, j, d) for r, (d, j) in enumerate(found[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "a", "b", "c", 1) for i, x in rows], SCHEMA)


def run(spark, rows, **kw):
    return sorted(tuple(r) for r in vamana.nearest_neighbours(frame(spark, rows), **kw).collect())


def recall(got, want):
    return len({(g[0], g[2]) for g in got} & {(w[0], w[2]) for w in want}) / len(want)


def test_few_vectors_give_all_candidates_exactly(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=6).tolist()) for k in range(8)]
    assert run(spark, rows, every=2) == brute(rows, every=2)


def test_recall_over_shards_with_a_group_of_near_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=32).tolist()) for k in range(1200)]
    middle = rng.normal(size=32)
    rows += [(2000 + k, (middle + rng.normal(scale=1e-3, size=32)).tolist()) for k in range(600)]
    got, want = run(spark, rows, every=20, shard_rows=500), brute(rows, every=20)
    assert len(got) == len(want)
    assert recall(got, want) > 0.97
    exact = {(w[0], w[2]): w[3] for w in want}
    assert all(exact[g[0], g[2]] == g[3] for g in got if (g[0], g[2]) in exact)


def test_ties_and_a_hot_vector_go_to_the_smaller_ids(spark):
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(300)] + [(400 + k, [1.0, 2.0, float(k)]) for k in range(30)]
    assert run(spark, rows) == brute(rows)
    grid = [(k, [float(k % 7 + 1), float(k // 7)]) for k in range(49)]          # many equal distances
    assert run(spark, grid, every=5) == brute(grid, every=5)


def test_queries_in_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(150)]
    vectors = vamana.usable_vectors(frame(spark, rows))
    index = vamana.build_index(vectors, shard_rows=60)
    got = vamana.search_index(index, vectors.where("vec_id % 3 = 0"), query_rows=10)
    assert recall([tuple(r) for r in got.collect()], brute(rows, every=3)) > 0.99


def test_odd_rows(spark):
    x = [0.5, -1.0, 2.0]
    rows = [(0, x), (0, x), (0, [1.0, 1.0, 1.0]), (100, None), (200, []), (300, [0.0, 0.0, 0.0]), (400, [math.nan, 1.0, 1.0]),
            (500, [math.inf, 1.0, 1.0]), (600, [None, 1.0, 1.0]), (None, x), (-100, [1.0, 2.0]), (7, [1.0, -0.0]), (8, x),
            (9, [1e300, -1e300, 1.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(0, x)]) == []
