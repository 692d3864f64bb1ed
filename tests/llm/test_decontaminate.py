from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from ordermill.llm.decontaminate import ROW_CHARS, Block, _blocks, clean_rows, contaminated
from ordermill.llm.queries import op9_decontaminate


def brute(doc, item, n=5):
    """Greedy string tiling word by word; covered share of the item."""
    t, p = re.findall(r"\w+", doc.lower()), re.findall(r"\w+", item.lower())
    n = min(n, len(p))
    mt, mp, covered = [False] * len(t), [False] * len(p), 0
    while n:
        best = (0, 0, 0)
        for j in range(len(p)):
            for i in range(len(t)):
                k = 0
                while i + k < len(t) and j + k < len(p) and t[i + k] == p[j + k] and not mt[i + k] and not mp[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < n:
            break
        k, i, j = best
        mt[i:i + k], mp[j:j + k] = [True] * k, [True] * k
        covered += k
    return covered / len(p) if p else 0


def test_tiling_equals_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.choice("abcdef") + rng.choice("xyz") for _ in range(rng.randrange(1, 30))]
        parts = [item[k:k + rng.randrange(3, 12)] for k in range(0, len(item), 7)]
        rng.shuffle(parts)
        doc = [w for part in parts for w in [*part, *rng.choices(["ax", "new", "cz"], k=rng.randrange(3))]] * rng.choice([1, 1, 2])
        want = brute(" ".join(doc), " ".join(item))
        got = [m[1] for m in Block([(1, " ".join(item))], 5).matches(" ".join(doc), 1e-9)]
        assert got == ([want] if want else [])


ITEM = " ".join(f"word{i}" for i in range(40))


def test_reordered_partial_and_odd_rows(make_docs, spark):
    parts = ITEM.split()
    mixed = " ".join(parts[20:30] + ["and"] + parts[30:40] + ["or"] + parts[0:10] + parts[10:20])
    rows = [(1, "intro. " + ITEM.upper().replace(" ", ", ") + " end"), (2, mixed), (3, " ".join(parts[:19])), (4, " ".join(parts[:20])),
            (5, None), (6, ""), (7, "clean " * 200_000), (8, ITEM), (8, ITEM), (None, ITEM), (9, " ".join(parts[::-1])),
            (10, ("only two " + ITEM + " ") * 300)]
    bench = spark.createDataFrame([(100, ITEM), (101, None), (102, "?!"), (103, "only two"), (None, "null id item text here now")],
                                  "item_id long, text string").withColumn("coverage", F.lit("x"))
    docs = make_docs(rows).withColumn("item_id", F.lit(5))
    for chars in (10 ** 6, 40):
        got = sorted(((r.doc_id, r.item_id) for r in contaminated(docs, bench, block_chars=chars).collect()), key=repr)
        assert got == sorted([(1, 100), (2, 100), (4, 100), (8, 100), (8, 100), (None, 100), (10, 100), (10, 103)], key=repr)
    kept = clean_rows(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7, 9] and kept.columns == docs.columns
    assert contaminated(make_docs([]), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_dir, corpus):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    words = {i: set(zip(*[re.findall(r"\w+", t.lower())[k:] for k in range(5)])) for i, t in items.items()}
    want = set()
    for r in corpus.collect():
        seeds = set(zip(*[re.findall(r"\w+", (r.text or "").lower())[k:] for k in range(5)]))
        want |= {(r.doc_id, i) for i, w in words.items() if seeds & w and brute(r.text, items[i]) >= 0.5}
    got = {(r.doc_id, r.item_id) for r in op9_decontaminate(spark, sf_dir).collect()}
    assert got == want and got


def test_large_benchmarks_by_the_block(make_docs, spark):
    texts = {k: " ".join(f"t{k}w{i}" for i in range(12)) for k in range(60)}
    same = " ".join(f"same{i}" for i in range(12))
    bench = [(k, t) for k, t in texts.items()] + [(1000 + k, same) for k in range(30)] + [(None, same), (7, texts[7])]
    bench = spark.createDataFrame(bench, "item_id long, text string")
    chars = 1000
    got = list(_blocks(bench, chars))
    assert sorted(t for block in got for _, t in block) == sorted([*texts.values(), same])       # equal items once
    assert len(got) > 5 and max(sum(len(t) + ROW_CHARS for _, t in block) for block in got) <= chars + len(same) + ROW_CHARS
    docs = make_docs([(1, texts[7] + " " + texts[8]), (2, "x " + same), (3, "clean"), (None, texts[9]), (2, "x " + same)])
    found = contaminated(docs, bench, block_chars=chars)
    assert "MapInArrow" not in found._jdf.queryExecution().toString()       # each block's matches are written already
    whole = contaminated(docs, bench)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect())) and found.dtypes == whole.dtypes
    assert whole.count() == 3 + 2 * 31 + 1
    assert [r.doc_id for r in clean_rows(docs, bench, block_chars=chars).collect()] == [3]
    many = spark.range(5000).selectExpr("id AS item_id", "'' AS text")          # no characters, yet many rows
    assert len(list(_blocks(many, chars))) == 1 and contaminated(docs, many, block_chars=chars).count() == 0


def test_tiles_are_the_same_however_they_are_found():
    import numpy as np
    from ordermill.llm import decontaminate as d
    rng = random.Random(9)
    for _ in range(300):
        item = np.array([rng.randint(1, 3) for _ in range(rng.randrange(3, 30))])
        doc = np.array([rng.randint(0, 3) for _ in range(rng.randrange(3, 60))])
        hits = [(i, j) for i in range(len(doc) - 2) for j in range(len(item) - 2)
                if doc[i:i + 3].all() and (doc[i:i + 3] == item[j:j + 3]).all()]
        t, p = np.array([h[0] for h in hits], int), np.array([h[1] for h in hits], int)
        assert d.tiles_by_length(doc, item, 3) == d.tiles(t, p, 3)


def test_repeated_words_take_memory_of_the_texts_alone():
    import tracemalloc
    block = Block([(1, "word " * 3000)], 5)
    tracemalloc.start()
    found = list(block.matches("word " * 100_000 + "other " * 10, 0.5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f[:2] for f in found] == [(1, 1.0)]
    assert peak < 500e6


def test_a_column_of_the_tables_named_as_an_internal_one(make_docs, spark):
    bench = spark.createDataFrame([(100, ITEM, "k")], "item_id long, text string, row_key string")
    docs = make_docs([(1, ITEM), (2, "clean text of its own here")]).withColumn("row_key", F.lit("x"))
    assert [r.doc_id for r in contaminated(docs, bench).collect()] == [1]
    kept = clean_rows(docs, bench).collect()
    assert [(r.doc_id, r.row_key) for r in kept] == [(2, "x")]


def test_short_items_are_reported_and_drop_no_row(make_docs, spark):
    docs = make_docs([(1, "the cat"), (2, "the " + ITEM), (3, "other"), (4, None), (5, "one two three four"), (6, "one two three four five")])
    bench = spark.createDataFrame([(1, "The"), (2, ITEM), (3, "one two three four"), (4, "one two three four five")], "item_id long, text string")
    for chars in (10 ** 6, 40):
        assert sorted(r.doc_id for r in clean_rows(docs, bench, block_chars=chars).collect()) == [1, 3, 4, 5]
        found = {(r.doc_id, r.item_id, r.item_words) for r in contaminated(docs, bench, block_chars=chars).collect()}
        assert found == {(1, 1, 1), (2, 1, 1), (2, 2, 40), (5, 3, 4), (6, 3, 4), (6, 4, 5)}
