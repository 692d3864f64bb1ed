from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ordermill.llm.graph import components
from ordermill.llm.queries import op4_simhash
from ordermill.llm.simhash import fingerprint, forest, links, simhash_components


def brute_fp(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
             .translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_roots(fps, radius=2):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= radius:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def same_classes(got, want):
    assert set(got) == set(want)
    pairs = {(got[f], want[f]) for f in want}
    assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})


@pytest.mark.parametrize("text", ["", " \t\n", "One", "one TWO", "a b c", "a b c a b c a b c", "É é Ünï\x1c x\xa0y z w",
                                  "A\x0bB\x0cC\rD e f", "w " * 70_000])
def test_fingerprint(text):
    assert fingerprint(text) == brute_fp(text)


def test_forest_equals_brute_force():
    rng = random.Random(1)
    fps = list({rng.getrandbits(64) ^ sum(1 << rng.randrange(64) for _ in range(2)) for _ in range(30)})
    fps = list({f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in fps for _ in range(8)})
    edges = forest(np.array(fps, np.uint64), 2)
    root = brute_roots(fps)
    assert len(edges) == len(fps) - len(set(root.values()))
    assert all(bin(fps[a] ^ fps[b]).count("1") <= 2 for a, b in edges)


@pytest.mark.parametrize("tile", [4096, 8])
def test_links_equal_brute_force_also_in_split_buckets(spark, tile):
    rng = random.Random(2)
    fps = {0, 2 ** 64 - 1, 1, 3}
    for _ in range(60):
        f = rng.getrandbits(64)
        for _ in range(6):
            fps.add(f)
            f ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    fps = list(fps)
    df = spark.createDataFrame([(f - 2 ** 64 if f >> 63 else f,) for f in fps], "fp long")
    got = {r.node % 2 ** 64: r.component for r in components(links(df, tile=tile)).collect()}
    want = brute_roots(fps)
    same_classes({f: got.get(f, ("alone", f)) for f in fps}, want)


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(i, 0) for i in range(201)}


def test_operator_on_odd_rows(make_docs):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base), (3, base), (8, None), (9, " \n"), (None, base), (7, base + " tail"), (11, "alone here now")]
    out = simhash_components(make_docs(rows).withColumn("component", F.lit(1)))
    got = sorted(((r.doc_id, r.component_id) for r in out.collect()), key=repr)
    assert len(got) == 8 and (None, 3) in got and (5, 3) in got and (8, 8) in got and (9, 8) in got and (11, 11) in got
    assert simhash_components(make_docs([])).count() == 0


def test_query_equals_brute_force(spark, sf_dir, corpus):
    texts = {r.doc_id: r.text or "" for r in corpus.collect()}
    fps = {d: brute_fp(t) for d, t in texts.items()}
    root = brute_roots(sorted(set(fps.values())))
    least = {}
    for d, f in fps.items():
        least[root[f]] = min(d, least.get(root[f], d))
    want = sorted((d, f"{f:016x}", least[root[f]]) for d, f in fps.items())
    got = op4_simhash(spark, sf_dir)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == want


def test_a_column_of_the_table_named_as_an_internal_one(make_docs):
    from pyspark.sql import functions as F
    from ordermill.llm.simhash import simhash_components
    docs = make_docs([(1, "one two three four"), (2, "one two three four")]).withColumn("row_key", F.lit("x")).withColumn("fp", F.lit("y"))
    assert sorted((r.doc_id, r.component_id) for r in simhash_components(docs).collect()) == [(1, 1), (2, 1)]
