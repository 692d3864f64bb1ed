from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ordermill.llm import spelling


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    forms, out = {}, []
    for w, n in words.items():
        around = sorted((o for o in words if near(w, o)), key=lambda o: (-words[o], o))
        if around and words[around[0]] >= 2 * n:
            forms[w] = around[0]
        out.append([w, n, len(around)])
    def root(w):
        while w in forms:
            w = forms[w]
        return w
    return sorted((w, forms.get(w, ""), root(w), n, k, words.get(forms.get(w), -1)) for w, n, k in out)


def run(make_docs, rows, **kw):
    got = spelling.spelling_variants(make_docs(rows), **kw).collect()
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"])
                  for r in got)


def texts(seed, n=40):
    rng = random.Random(seed)
    stems = ["spelling", "Gruppen", "cœur", "straße", "élégance", "naïveté", "aaaaaa", "banana", "ÀÉÎÕÜ", "mississippi"]
    rows = []
    for k in range(n):
        words = []
        for _ in range(60):
            w = rng.choice(stems)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abÿé") + w[at:], w[:at] + rng.choice("xyÀ×") + w[at + 1:]]) or "x"
            words.append(w)
        rows.append((k, rng.choice([" ", ", ", "1"]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(make_docs, seed):
    rows = texts(seed)
    assert run(make_docs, rows) == brute(rows)


def test_filters_in_rounds_lose_nothing(make_docs):
    rows = texts(3, 20)
    assert run(make_docs, rows, filter_bytes=512) == brute(rows)


def test_odd_rows(make_docs):
    long = "ab" * 400
    rows = [(1, None), (2, ""), (None, "Words words WORDS wordz wordz wordz"), (None, "words"), (3, "12 ☺"),
            (4, f"{long} {long}c {long[1:]} {long[:300]}x{long[301:]} " * 3), (4, "twice again twice"), (4, "twice again twice"),
            (5, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaaaa aaaaaa aaaaaa")]
    assert run(make_docs, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark, make_docs):
    assert run(make_docs, []) == []
    assert run(make_docs, [(1, "one two three")]) == []
    rows = texts(4, 5)
    df = spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in rows],
                               "doc_id long, text string, word string, n int, wid string, h string")
    assert sorted(r["word"] for r in spelling.spelling_variants(df).collect()) == [r[0] for r in brute(rows)]


def test_edit_hashes_are_those_of_the_edited_words():
    words = ["banana", "aabbcc"]
    _, letters = next(spelling._by_length(words))
    alphabet = np.array(sorted(map(ord, "abcnzÿ")), np.uint64)
    made = Counter()
    for rows, at, letter, h in spelling.edits(letters, alphabet):
        for r, k, c, e in zip(rows.tolist(), at.tolist(), letter.tolist(), h.tolist()):
            w = words[r][:k] + (chr(c) if c else "") + words[r][k + 1:]
            assert spelling.word_hashes([w])[0] == e
            made[words[r], w] += 1
    assert max(made.values()) == 1
    for w in words:
        assert {e for s, e in made if s == w and len(e) < len(w)} == {w[:k] + w[k + 1:] for k in range(len(w))}
