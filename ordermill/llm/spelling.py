"""Spelling variants by Bloom-guided neighbourhoods.

The words of the corpus are counted by grouped aggregation. Two words are near
if they differ by one inserted, deleted or replaced letter. Each word's
deletions, and its replacements by a later letter, are generated as rolling
hashes only; together they reach every near pair from one of its ends, an
insertion being a deletion of the other word. The hashes are probed against
blocked Bloom filters of the vocabulary, one per word length, that are
broadcast; only positives are shuffled to the vocabulary, where an exact join
and a comparison of the words remove what the filters let through by chance.

Filters take ``FILTER_BITS`` bits a word. One broadcast holds ``FILTER_BYTES``
at most: larger filters are probed in rounds, each with its own part of the
blocks, so neither the driver nor a task ever holds more and no word is
skipped at any size of the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialise, text_of

TYPO_MODULUS = 97
SHORTEST = 5
LEAST_COUNT = 3
DOMINANCE = 2            # times a word's count that its form has at least
LONG = 64                # lengths from here on share a filter
FILTER_BITS = 20
FILTER_BYTES = 32 << 20
_LANES = 4               # 64-bit words of a block
_BLOCK_BITS = 64 * _LANES
_HELD_WORDS = 200_000    # distinct words that a task counts before it passes them on
_STEP = 1 << 19          # edits hashed at a time
_RUNS = re.compile("[a-zÀ-ÿ]+").findall
_BASE = 0x9E3779B97F4A7C15
_WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def typo(word: str, seed: int) -> str:
    """``word`` as the corpus counts it: one letter less if the checksum of
    its document and itself says so."""
    h = zlib.crc32(word.encode(), seed)
    if h % TYPO_MODULUS:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _count(batches):
    held: Counter = Counter()

    def rows():
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                         schema=_WORDS)
        held.clear()
        return out
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
            for word, n in Counter(_RUNS(text.encode().lower().decode())).items():   # bytes.lower: A-Z alone
                word = typo(word, seed)
                if len(word) >= SHORTEST:
                    held[word] += n
            if len(held) > _HELD_WORDS:
                yield rows()
    if held:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of ``docs`` (``doc_id``, ``text``) that are long
    and frequent enough."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return (rows.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


# --- hashes of words and their edits ---------------------------------------

def _powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    out[1:] = np.uint64(_BASE)
    return np.cumprod(out, dtype=np.uint64)


def _by_length(words: list[str]):
    """(positions, letters as a matrix) of the words of one length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        letters = np.frombuffer("".join([words[k] for k in at.tolist()]).encode("utf-32-le"), "<u4")
        yield at, letters.astype(np.uint64).reshape(len(at), length)


def _prefixes(letters: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, ... letters; the last column is the word's."""
    out = np.zeros((len(letters), letters.shape[1] + 1), np.uint64)
    for k in range(letters.shape[1]):
        out[:, k + 1] = out[:, k] * np.uint64(_BASE) + letters[:, k]
    return out


def word_hashes(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words), np.uint64)
    for at, letters in _by_length(words):
        out[at] = _prefixes(letters)[:, -1]
    return out


def edits(letters: np.ndarray, alphabet: np.ndarray):
    """Hashes of the edits of words of one length, some at a time: (row,
    position, letter or 0 for a deletion, hash) as arrays."""
    n, length = letters.shape
    power, prefix = _powers(length), _prefixes(letters)
    whole = prefix[:, -1:]
    wide = max(1, _STEP // max(1, n * (len(alphabet) + 1)))
    for a in range(0, length, wide):
        at = np.arange(a, min(a + wide, length))
        here = letters[:, at]
        weight = power[length - 1 - at]
        # a run of one letter loses the same by any of its letters
        first = np.concatenate((np.ones((n, 1), bool) if a == 0 else (here[:, :1] != letters[:, a - 1:a]),
                                here[:, 1:] != here[:, :-1]), axis=1)
        shorter = prefix[:, at] * weight + (whole - prefix[:, at + 1] * weight)
        row, k = np.nonzero(first)
        yield row, at[k], np.zeros(len(row), np.uint64), shorter[row, k]
        other = whole[:, :, None] + (alphabet - here[:, :, None]) * weight[:, None]
        row, k, j = np.nonzero(alphabet > here[:, :, None])
        yield row, at[k], alphabet[j], other[row, k, j]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _place(h: np.ndarray, first: int, blocks: int) -> np.ndarray:
    """Number of the block that a hash belongs to, among those of its length."""
    return np.uint64(first) + _mix(h) % np.uint64(blocks)


def _masks(h: np.ndarray) -> np.ndarray:
    """The bits a hash sets in its block: two in each lane."""
    bits = _mix(h + np.uint64(_BASE))
    lanes = []
    for k in range(_LANES):
        one, two = [(bits >> np.uint64(12 * k + 6 * j)) & np.uint64(63) for j in (0, 1)]
        lanes.append((np.uint64(1) << one) | (np.uint64(1) << two))
    return np.stack(lanes, axis=1)


# --- filters -----------------------------------------------------------------

def _hashed(batches):
    for batch in batches:
        words = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(w) for w in words], pa.int64()),
             pa.array(word_hashes(words).view(np.int64))], names=["word", "n", "length", "h"])


def _layout(vocabulary: DataFrame, filter_bits: int) -> dict[int, tuple[int, int]]:
    """First block and number of blocks of each length's filter; lengths from
    ``LONG`` on are one, so these are at most ``LONG`` entries."""
    sizes = vocabulary.groupBy(F.least("length", F.lit(LONG)).alias("length")).count().collect()
    out, first = {}, 0
    for length, n in sorted(tuple(r) for r in sizes):
        out[length] = (first, -(-n * filter_bits // _BLOCK_BITS))
        first += out[length][1]
    return out


def _blocks(layout: dict[int, tuple[int, int]]):
    def run(batches):
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            lengths = np.minimum(batch.column(1).to_numpy(), LONG)
            block = np.zeros(len(h), np.int64)
            for length in np.unique(lengths).tolist():
                at = lengths == length
                block[at] = _place(h[at], *layout[length]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), *[pa.array(np.ascontiguousarray(m).view(np.int64)) for m in _masks(h).T]],
                names=["block", *[f"m{k}" for k in range(_LANES)]])
    return run


def _probe(layout, alphabet: np.ndarray, filters, low: int, high: int):
    """Edits whose hash the blocks from ``low`` to ``high`` hold."""
    names = ["wid", "length", "at", "letter", "edit"]

    def run(batches):
        held = filters.value
        for batch in batches:
            wids = batch.column(0).to_numpy()
            for rows, letters in _by_length(batch.column(1).to_pylist()):
                own = letters.shape[1]
                for row, at, letter, h in edits(letters, alphabet):
                    length = own if len(letter) and letter[0] else own - 1
                    shape = layout.get(min(length, LONG))
                    if shape is None or not len(h):
                        continue
                    block = _place(h, *shape).view(np.int64)
                    here = np.flatnonzero((block >= low) & (block < high))
                    mask = _masks(h[here])
                    hits = here[((held[block[here] - low] & mask) == mask).all(axis=1)]
                    if len(hits):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(wids[rows[row[hits]]]), pa.array(np.full(len(hits), length)),
                             pa.array(at[hits].astype(np.int64)), pa.array(letter[hits].astype(np.int64)),
                             pa.array(h[hits].view(np.int64))], names=names)
    return run


def positives(vocabulary: DataFrame, filter_bits: int = FILTER_BITS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(wid, length, at, letter, edit): edits that the filters hold, with the
    word they were made from."""
    schema = "wid long, length long, at long, letter long, edit long"
    spark = vocabulary.sparkSession
    layout = _layout(vocabulary, filter_bits)
    total = sum(n for _, n in layout.values())
    # the letters that occur: 90 at most
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()
    alphabet = np.array(sorted(ord(r[0]) for r in letters), np.uint64)
    blocks = materialise(vocabulary.select("h", "length").mapInArrow(
        _blocks(layout), "block long, m0 long, m1 long, m2 long, m3 long").groupBy("block").agg(
        *[F.bit_or(f"m{k}").alias(f"m{k}") for k in range(_LANES)]), "bloom_blocks")
    words = vocabulary.select("wid", "word").repartition(spark.sparkContext.defaultParallelism * 2)
    rounds, width = [], max(1, filter_bytes // (8 * _LANES))
    for low in range(0, total, width):
        high = min(low + width, total)
        part = blocks.where(F.col("block").between(low, high - 1)).toArrow()
        held = np.zeros((high - low, _LANES), np.uint64)
        held[part["block"].to_numpy() - low] = np.stack([part[f"m{k}"].to_numpy() for k in range(_LANES)], axis=1).view(np.uint64)
        shared = spark.sparkContext.broadcast(held)
        found = words.mapInArrow(_probe(layout, alphabet, shared, low, high), schema)
        if total > width:                      # one round's filters are held at a time
            found = materialise(found, "bloom_positives")
            shared.unpersist()
        rounds.append(found)
    return reduce(DataFrame.unionByName, rounds) if rounds else spark.createDataFrame([], schema)


def near_pairs(vocabulary: DataFrame, found: DataFrame) -> DataFrame:
    """(wid, n, other, other_wid, other_n) of the near words, both ways: the
    exact join of the positives with the vocabulary."""
    source = vocabulary.select("wid", F.col("word").alias("s"), F.col("n").alias("s_n"))
    target = vocabulary.select(F.col("h").alias("edit"), "length", F.col("word").alias("t"), F.col("n").alias("t_n"),
                               F.col("wid").alias("t_wid"))
    at = F.col("at").cast("int")
    letter = F.when(F.col("letter") > 0, F.char("letter")).otherwise("")
    edited = F.concat(F.substring("s", F.lit(1), at), letter, F.substring("s", at + 2, F.length("s")))
    pairs = found.join(target, ["edit", "length"]).join(source, "wid").where(edited == F.col("t"))
    return (pairs.select("wid", F.col("s_n").alias("n"), F.col("t").alias("other"), F.col("t_wid").alias("other_wid"),
                         F.col("t_n").alias("other_n"))
            .unionByName(pairs.select(F.col("t_wid").alias("wid"), F.col("t_n").alias("n"), F.col("s").alias("other"),
                                      F.col("wid").alias("other_wid"), F.col("s_n").alias("other_n"))))


def _roots(links: DataFrame) -> DataFrame:
    """(wid, root) of the words with a form (``wid``, ``root`` = its form):
    each round doubles the steps taken. A form is ``DOMINANCE`` times as
    frequent as its word, so there are no cycles and few rounds."""
    while True:
        onward = links.select(F.col("wid").alias("root"), F.col("root").alias("further"))
        links = materialise(links.join(onward, "root", "left").select(
            "wid", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling_roots")
        if links.where("moved").isEmpty():
            return links.select("wid", "root")
        links = links.select("wid", "root")


def spelling_variants(docs: DataFrame, filter_bits: int = FILTER_BITS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The vocabulary of ``docs`` with the spelling each word is a variant of:
    word, form, root, n, n_near, form_n.

    Words are runs of Latin letters with A-Z lower-cased, one letter less
    where the checksum of document id and word says so, of ``SHORTEST`` letters
    and ``LEAST_COUNT`` occurrences at least. ``form`` is the most frequent near
    word (of equals the first by code points) if it is ``DOMINANCE`` times as
    frequent, else null; ``root`` follows forms to the last one.

    A null text has no words and a null doc_id counts as an empty one; repeated
    rows count again; texts and words may have any length; an empty table, or
    one without frequent words, gives no rows; other columns are not read.
    """
    hashed = word_counts(docs).mapInArrow(_hashed, "word string, n long, length long, h long")
    vocabulary = materialise(hashed.withColumn("wid", F.monotonically_increasing_id()), "vocabulary")
    found = materialise(positives(vocabulary, filter_bits, filter_bytes), "bloom_positives")
    pairs = near_pairs(vocabulary, found)
    best = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("word"), F.col("other_wid").alias("wid")))
    near = materialise(pairs.groupBy("wid").agg(F.first("n").alias("own"), F.count(F.lit(1)).alias("n_near"), best.alias("best")),
                       "near_words")
    formed = -F.col("best.m") >= DOMINANCE * F.col("own")
    roots = _roots(near.where(formed).select("wid", F.col("best.wid").alias("root")))
    roots = roots.join(vocabulary.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root").select("wid", "root_word")
    near = near.select("wid", "n_near", F.when(formed, F.col("best.word")).alias("form"), F.when(formed, -F.col("best.m")).alias("form_n"))
    return (vocabulary.join(near, "wid", "left").join(roots, "wid", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
