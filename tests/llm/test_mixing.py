from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from ordermill.llm.mixing import LEVELS, leaf_budgets, mix_rows, select_mix
from ordermill.llm.queries import op7_mixing


def fill(budget, children):
    """Whole-number water filling: {name: (weight, cap)} -> {name: share}."""
    out, left = {}, dict(children)
    while left:
        total = sum(w for w, _ in left.values())
        full = {n for n, (w, c) in left.items() if c * total <= w * budget}
        if not full:
            return out | {n: (w * budget // total if total else 0) for n, (w, c) in left.items()}
        name = min(full, key=lambda n: (Fraction(left[n][1], left[n][0]) if left[n][0] else Fraction(10 ** 30), n))
        out[name] = left.pop(name)[1]
        budget = max(0, budget - out[name])
    return out


def brute_budgets(leaves, budget, epochs, weights):
    def walk(prefix, budget):
        depth = len(prefix)
        if depth == 3:
            return {prefix: budget}
        caps = defaultdict(int)
        for leaf, supply in leaves.items():
            if leaf[:depth] == prefix:
                caps[leaf[:depth + 1]] += supply * epochs
        shares = fill(budget, {n: (weights.get(LEVELS[depth], {}).get(n[-1], 1), c) for n, c in caps.items()})
        return {k: v for n, s in shares.items() for k, v in walk(n, s).items()}
    return walk((), budget)


def test_budgets_equal_brute_force(spark):
    rng = random.Random(4)
    for _ in range(4):
        weights = {"domain": {"a": 3, "b": 1, "c": 0}, "lang": {"en": 5, "de": 2}, "source": {"s1": 7}}
        leaves = {(d, l, s): rng.choice([0, 5, rng.randrange(2000), 10 ** 12]) for d in "abc" for l in ("en", "de", "fr")
                  for s in ("s1", "s2", "s3") if rng.random() < 0.7}
        budget = rng.choice([0, 100, 5000, 10 ** 13])
        df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, supply long")
        got = {(r.domain, r.lang, r.source): r.share for r in leaf_budgets(df, F.lit(budget), 3, weights).collect()}
        assert got == brute_budgets(leaves, budget, 3, weights)


def brute_mix(rows, budget, epochs, weights, seed):
    leaves, members = defaultdict(int), defaultdict(list)
    for doc_id, text, lang, source in rows:
        number = re.search(r"(\d{1,9})$", source or "")
        leaf = (f"d{int(number[1]) % 4}" if number else "other", lang or "", source or "")
        n = len([w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w])
        leaves[leaf] += n
        members[leaf].append((doc_id, n))
    shares = brute_budgets(leaves, sum(leaves.values()) if budget is None else budget, epochs, weights)
    out = []
    for leaf, docs in members.items():
        whole, rest = divmod(shares[leaf], leaves[leaf]) if leaves[leaf] else (int(shares[leaf] > 0), 0)
        at = 0
        for doc_id, n in sorted(docs, key=lambda d: hashlib.md5(f"{seed}:{whole}:{d[0]}".encode()).hexdigest()):
            at += n
            out += [(doc_id, e) for e in range(whole + (at <= rest and rest > 0))]
    return sorted(out)


def test_selection_equals_brute_force(make_docs):
    rng = random.Random(9)
    rows = [(i, rng.choice(["", None, "a b  c", "w " * rng.randrange(60)]), rng.choice(["en", "de", None]),
             rng.choice(["src0", "src0", "src1", "src14", "x", None])) for i in range(400)]
    weights = {"domain": {"d0": 1, "d1": 4}, "lang": {"en": 3}}
    for budget in (None, 0, 900, 100_000):
        got = select_mix(make_docs(rows).withColumn("slice", F.lit(1)), weights, budget, 3, 17)
        assert sorted((r.doc_id, r.epoch) for r in got.collect()) == brute_mix(rows, budget, 3, weights, 17)


def test_rows_keep_the_layout_and_repeat_by_epoch(make_docs):
    rows = [(i, "one two three", "en", "src1") for i in range(5)] + [(None, "no id", "en", "src1"), (4, "one two three", "en", "src1")]
    out = mix_rows(make_docs(rows).withColumn("order", F.lit("x")), weights={}, budget=10 ** 6)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "order"]
    assert out.count() == 3 * 7
    assert mix_rows(make_docs([])).count() == 0


def test_plan_is_native(spark, sf_dir):
    plan = op7_mixing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_column_of_the_table_named_as_an_internal_one(make_docs):
    from pyspark.sql import functions as F
    from ordermill.llm.mixing import select_mix
    docs = make_docs([(k, "some words here", "en", f"src{k}") for k in range(6)])
    plain = sorted((r.doc_id, r.epoch) for r in select_mix(docs).collect())
    other = docs.withColumn("row_key", F.lit("x")).withColumn("slice", F.lit("y"))
    assert sorted((r.doc_id, r.epoch) for r in select_mix(other).collect()) == plain
