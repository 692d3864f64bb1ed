"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items share seeds: runs of ``MIN_MATCH`` words with
one rolling (Karp-Rabin) hash, compared word by word. For each pair that shares
a seed, the longest match of unmarked words is marked again and again, so a
passage whose parts were put in another order is covered as well. A document is
contaminated by an item if the tiles cover ``COVERAGE`` of the item's words.

A benchmark of at most ``BLOCK_CHARS`` characters is sent to the tasks whole.
A larger one is taken in blocks of its distinct texts, each of at most that
size (or one text), met by all documents; a block's matches are written before
the next block is collected, so the driver holds one block at a time and a
benchmark of any size is covered. Matches then get the ids of equal items.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialise, row_key, text_of

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_CHARS = 20_000_000
ROW_CHARS = 64           # that an item counts for besides its text
SLOTS = 16               # pieces of a block
SALTS = 16
PAIRS = 50_000           # hits of a document and an item that are listed; beyond, none are
_WORDS = re.compile(r"\w+").findall
_BASE = np.uint64(0x9E3779B97F4A7C15)


def hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``n`` ids."""
    out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for k in range(n):
        out = out * _BASE + ids[k:len(ids) - n + 1 + k].astype(np.uint64)
    return out


def tiles(t: np.ndarray, p: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (document position, item position, length) from the hits:
    pairs (t, p) of positions where runs of ``n`` words are equal."""
    out = []
    while len(t):
        order = np.lexsort((t, t - p))
        t, p = t[order], p[order]
        starts = np.flatnonzero(np.concatenate(([True], (np.diff(t - p) != 0) | (np.diff(t) != 1))))
        lengths = np.diff(np.concatenate((starts, [len(t)])))
        best = lengths.max()
        # of the longest matches the first by item, then document position
        longest = starts[lengths == best]
        at = longest[np.lexsort((t[longest], p[longest]))[0]]
        tile = (int(t[at]), int(p[at]), int(best) + n - 1)
        out.append(tile)
        free = ((t + n <= tile[0]) | (t >= tile[0] + tile[2])) & ((p + n <= tile[1]) | (p >= tile[1] + tile[2]))
        t, p = t[free], p[free]
    return out


def _prefix(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first 0, 1, ... ids, and the powers of the base."""
    power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(ids), _BASE))), dtype=np.uint64)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    back = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(ids), inverse))), dtype=np.uint64)
    # sum of id * base^-position, so that one cumulative sum gives every run's hash
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(ids.astype(np.uint64) * back[1:], dtype=np.uint64))), power


def tiles_by_length(doc: np.ndarray, item: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """What :func:`tiles` gives, without a list of hits: the length of the
    longest match is searched by halving, each length by one hash of every
    unmarked run. Memory is that of the two texts, however often words repeat."""
    sides = [(ids, *_prefix(ids), ids > 0) for ids in (doc, item)]
    free = [known.copy() for *_, known in sides]

    def runs(side: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        _, prefix, power, _ = sides[side]
        taken = np.concatenate(([0], np.cumsum(~free[side])))
        at = np.flatnonzero(taken[length:] == taken[:len(taken) - length])
        return at, (prefix[at + length] - prefix[at]) * power[at + length]

    def first(length: int) -> tuple[int, int] | None:
        at, hashed = runs(0, length)
        to, wanted = runs(1, length)
        if not len(at) or not len(to):
            return None
        values, place = np.unique(hashed, return_index=True)
        k = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
        for j in np.flatnonzero(values[k] == wanted).tolist():
            t, p = int(at[place[k[j]]]), int(to[j])
            if np.array_equal(doc[t:t + length], item[p:p + length]):
                return t, p
        return None

    out, longest = [], min(len(doc), len(item))
    while longest >= n:
        hit = first(longest)
        if hit is None:                                  # matches lie between n - 1 and longest
            low, high = n - 1, longest
            while high - low > 1:
                middle = (low + high) // 2
                got = first(middle)
                if got:
                    low, hit = middle, got
                else:
                    high = middle
            longest = low
        if hit is None:
            break
        out.append((*hit, longest))
        for side, start in enumerate(hit):
            free[side][start:start + longest] = False
    return out


class Block:
    """The seeds of a block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, str]], min_match: int):
        self.vocabulary: dict[str, int] = {}
        self.items = []
        by_length = defaultdict(list)                       # an item shorter than a seed is a seed
        for item_id, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in _WORDS(text.lower())]
            if words:
                by_length[min(min_match, len(words))].append(len(self.items))
                self.items.append((item_id, np.array(words, np.int64)))
        self.seeds = []
        for n, members in sorted(by_length.items()):
            runs = [hashes(self.items[i][1], n) for i in members]
            key = np.concatenate(runs)
            item = np.repeat(members, [len(r) for r in runs])
            place = np.concatenate([np.arange(len(r)) for r in runs])
            order = np.argsort(key, kind="stable")
            self.seeds.append((n, key[order], item[order], place[order]))

    def matches(self, text: str, coverage: float):
        """(item_id, coverage, matched words, item words, tiles) of the items
        that cover a document enough."""
        words = _WORDS(text.lower())
        ids = np.frombuffer(array("i", map(self.vocabulary.get, words, repeat(0))), np.int32).astype(np.int64)
        known = ids > 0
        for n, key, item, place in self.seeds:
            if len(ids) < n:
                continue
            whole = known[:len(ids) - n + 1].copy()
            for k in range(1, n):
                whole &= known[k:len(ids) - n + 1 + k]
            at = np.flatnonzero(whole)
            if not len(at):
                continue
            got = np.zeros(len(at), np.uint64)
            for k in range(n):
                got = got * _BASE + ids[at + k].astype(np.uint64)
            # each hash of the document once, so that what is listed here is bounded by the items' seeds
            order = np.argsort(got, kind="stable")
            at, got = at[order], got[order]
            first = np.flatnonzero(np.concatenate(([True], got[1:] != got[:-1])))
            often = np.diff(np.append(first, len(got)))
            low, high = np.searchsorted(key, got[first], "left"), np.searchsorted(key, got[first], "right")
            counts = high - low
            if not counts.any():
                continue
            run = np.repeat(np.arange(len(first)), counts)
            seed = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            order = np.argsort(item[seed], kind="stable")
            run, seed = run[order], seed[order]
            members, cuts = np.unique(item[seed], return_index=True)
            for i, c, d in zip(members.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(seed)]):
                item_id, target = self.items[i]
                place_in, runs = place[seed[c:d]], run[c:d]
                # positions that seeds cover bound what tiles can cover
                covered = np.zeros(len(target) + 1, np.int64)
                np.add.at(covered, place_in, 1)
                np.add.at(covered, place_in + n, -1)
                if (np.cumsum(covered[:-1]) > 0).sum() < coverage * len(target):
                    continue
                times = often[runs]
                if times.sum() > PAIRS:
                    found = tiles_by_length(ids, target, n)
                else:
                    b = np.repeat(place_in, times)
                    a = at[np.repeat(first[runs] - np.cumsum(times) + times, times) + np.arange(times.sum())]
                    same = np.ones(len(a), bool)
                    for k in range(n):
                        same &= ids[a + k] == target[b + k]
                    found = tiles(a[same], b[same], n)
                matched = sum(f[2] for f in found)
                if matched >= coverage * len(target):
                    yield item_id, matched / len(target), matched, len(target), len(found)


_OUT = "doc_id long, row_key long, item_id long, coverage double, matched_words long, item_words long, n_tiles long"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()),
                     ("matched_words", pa.int64()), ("item_words", pa.int64()), ("n_tiles", pa.int64())])


def _match(items, min_match: int, coverage: float, schema: pa.Schema = _SCHEMA):
    def run(batches):
        block = Block(items, min_match)
        for batch in batches:
            rows = []
            for doc_id, key, text in zip(*[c.to_pylist() for c in batch.columns]):
                rows += [dict(zip(schema.names, (doc_id, key, *found))) for found in block.matches(text, coverage)]
            yield pa.RecordBatch.from_pylist(rows, schema)
    return run


def _blocks(texts: DataFrame, block_chars: int):
    """(digest, text) of the distinct texts, a block at a time: hashed into
    slots, slots cut by running length, and the pieces packed in order."""
    texts = texts.select("text").distinct().withColumn("weight", F.length("text").cast("long") + ROW_CHARS)
    total = texts.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    slots = -(-total // block_chars) * SLOTS or 1
    texts = texts.withColumn("slot", F.pmod(F.xxhash64("text"), F.lit(slots)))
    before = F.sum("weight").over(Window.partitionBy("slot").orderBy("text").rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight")
    texts = materialise(texts.select("text", "weight", F.struct("slot", F.floor(before / block_chars).alias("cut")).alias("piece")),
                        "benchmark_texts")
    held, runs = 0, []
    for piece, size in sorted(tuple(r) for r in texts.groupBy("piece").agg(F.sum("weight")).collect()):
        if not runs or held + size > block_chars:
            runs.append([piece, piece])
            held = 0
        runs[-1][1] = piece
        held += size
    for ends in runs:
        first, last = [F.struct(F.lit(slot).cast("long").alias("slot"), F.lit(cut).cast("long").alias("cut")) for slot, cut in ends]
        yield [tuple(r) for r in texts.where(F.col("piece").between(first, last)).select(F.sha2("text", 256), "text").collect()]


def _found(docs: DataFrame, benchmark: DataFrame, min_match: int, coverage: float, block_chars: int, named: bool,
           key: Column | None = None) -> DataFrame:
    """The matches; those of a large benchmark name their items if ``named``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.lit(0) if key is None else key).cast("long").alias("row_key"),
                       text_of("text").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of("text").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.length("text") + ROW_CHARS), F.lit(0))).first()[0]
    if total <= block_chars:
        return rows.mapInArrow(_match([tuple(r) for r in items.collect()], min_match, coverage), _OUT)
    schema = pa.schema([pa.field("item_id", pa.string()) if f.name == "item_id" else f for f in _SCHEMA])
    out = _OUT.replace("item_id long", "item_id string")
    found = reduce(DataFrame.unionByName, (materialise(rows.mapInArrow(_match(block, min_match, coverage, schema), out), "benchmark_block")
                                           for block in _blocks(items, block_chars)))
    if not named:
        return found
    found = found.withColumnRenamed("item_id", "digest").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    items = items.select("item_id", F.sha2("text", 256).alias("digest"), F.pmod(F.xxhash64("item_id"), F.lit(SALTS)).cast("int").alias("salt"))
    return found.join(items, ["digest", "salt"]).select(*_SCHEMA.names)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row per document and benchmark item (``item_id``, ``text``) whose
    words the document covers: doc_id, row_key (0), item_id,
    coverage, matched_words, item_words, n_tiles.

    Words are runs of ``\\w``, lower-cased. Null texts are empty; items without
    words match nothing; items of fewer words than a seed match as a whole and
    are reported with their ``item_words`` (below ``min_match``: too short to
    show that a document was copied); repeated rows each match; an empty table
    on either side gives no rows.
    """
    return _found(docs, benchmark, min_match, coverage, block_chars, True)


def clean_rows(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, in its own layout, that no item contaminates.

    Items of fewer words than a seed (``min_match``) drop no row: a document
    that has one common word of a benchmark is clean. Null texts and empty
    texts stay, repeated rows stay or go together, and an empty benchmark
    leaves every row.
    """
    names = docs.columns
    key = row_key("doc_id", "text")
    found = _found(docs, benchmark, min_match, coverage, block_chars, False, key)
    found = found.where(F.col("item_words") >= min_match).select(F.col("doc_id").alias("_fid"), F.col("row_key").alias("_fkey")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").alias("_id"), key.alias("_key"))
    rows = rows.join(found, (F.col("_key") == F.col("_fkey")) & F.col("_id").eqNullSafe(F.col("_fid")), "left_anti")
    return rows.select(*[F.col("row").getField(c).alias(c) for c in names])
