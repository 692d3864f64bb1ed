"""Simple-8b: integers packed into 64-bit words, coded and decoded by numpy.

The top four bits of a word are a selector: how many ids the word holds and at
which width. A file is a sequence of blocks; all numbers are little-endian:

    magic "S8B1", u32 body crc32, u64 documents, u64 ids, u64 words, u64 escapes
    i64 doc_id[documents]   u8 has_id[documents]
    u64 length[documents]   ids of each document
    u64 offset[documents]   first word of each document (documents start a word)
    u64 position[escapes]   u64 value[escapes]   ids wider than 60 bits; 0 in the words
    u64 word[words]
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

# Ids per word and bits per id by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
_HEAD = struct.Struct("<4sIQQQQ")
MAGIC = b"S8B1"


def pack(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each document, positions of escapes)."""
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(lengths), np.uint64), np.empty(0, np.uint64)
    width = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    wide = width > 60
    plain = np.where(wide, np.uint64(0), ids)
    reach = np.where(wide, np.uint8(0), width)           # widest of the next `span` ids
    ends = np.cumsum(lengths.astype(np.int64))
    rest = np.repeat(ends, lengths.astype(np.int64)) - np.arange(n)
    best, span = np.full(n, 15, np.uint8), 1
    for selector in range(14, -1, -1):
        more = int(COUNTS[selector]) - span
        reach[:max(0, n - more)] = np.maximum(reach[:max(0, n - more)], reach[more:])
        span += more
        fits = (reach <= BITS[selector]) & (rest >= span)
        if not fits.any():
            break                                         # longer spans are narrower still
        best[fits] = selector
    step = (np.arange(n) + COUNTS[best]).tolist()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at = step[at]
    starts = np.array(starts)
    chosen = best[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen).tolist():
        if BITS[selector]:
            rows = np.flatnonzero(chosen == selector)
            for k in range(int(COUNTS[selector])):
                words[rows] |= plain[starts[rows] + k] << np.uint64(k * int(BITS[selector]))
    first = np.searchsorted(starts, ends - lengths.astype(np.int64))
    return words, first.astype(np.uint64), np.flatnonzero(wide).astype(np.uint64)


def unpack(words: np.ndarray) -> np.ndarray:
    """The ids of whole words, all at once."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    starts = np.cumsum(counts) - counts
    ids = np.zeros(int(counts.sum()), np.uint64)
    for selector in np.unique(selectors).tolist():
        bits, count = int(BITS[selector]), int(COUNTS[selector])
        if bits:
            rows = np.flatnonzero(selectors == selector)
            mask = np.uint64((1 << bits) - 1)
            for k in range(count):
                ids[starts[rows] + k] = (words[rows] >> np.uint64(k * bits)) & mask
    return ids


def write_block(doc_ids: list, ids: np.ndarray, lengths: list[int]) -> bytes:
    """One block of whole documents; a null doc_id is allowed."""
    ids, lengths = ids.astype(np.uint64), np.array(lengths, np.uint64)
    words, first, escapes = pack(ids, lengths)
    parts = [np.array([0 if d is None else d for d in doc_ids], "<i8"),
             np.array([d is not None for d in doc_ids], np.uint8),
             lengths.astype("<u8"), first.astype("<u8"), escapes.astype("<u8"),
             ids[escapes.astype(np.int64)].astype("<u8"), words.astype("<u8")]
    body = b"".join(p.tobytes() for p in parts)
    return _HEAD.pack(MAGIC, zlib.crc32(body), len(lengths), len(ids), len(words), len(escapes)) + body


def _bodies(content: bytes, end: bytes) -> Iterator[tuple]:
    """Of each block, checked: doc_ids, has_id, lengths, offsets, positions and
    values of escapes, words, and the number of ids."""
    view, at = memoryview(content), 0
    while at < len(view) - len(end):
        magic, crc, docs, n, n_words, n_escapes = _HEAD.unpack_from(view, at)
        at += _HEAD.size
        size = docs * 25 + n_escapes * 16 + n_words * 8
        body = view[at:at + size]
        if magic != MAGIC or len(body) != size or zlib.crc32(body) != crc:
            raise ValueError("damaged block")
        at += size
        pos = 0

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal pos
            out = np.frombuffer(body, kind, count, pos)
            pos += out.nbytes
            return out
        yield (take("<i8", docs), take("u1", docs), take("<u8", docs), take("<u8", docs),
               take("<u8", n_escapes), take("<u8", n_escapes), take("<u8", n_words), n)
    if view[at:] != end:
        raise ValueError("the file is cut short")


def read_blocks(content: bytes, end: bytes = b"") -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc_ids, lengths, ids) of each block of a file closed by ``end``; the
    offsets must point at the words where the lengths have documents start."""
    for doc_ids, has_id, lengths, offsets, where, values, words, n in _bodies(content, end):
        ids = unpack(words)
        ids[where.astype(np.int64)] = values
        counts = COUNTS[(words >> np.uint64(60)).astype(np.int64)]
        first, some = np.cumsum(lengths) - lengths, lengths > 0
        if len(ids) != n or int(lengths.sum()) != n or (offsets[some] >= len(words)).any() or (
                (np.cumsum(counts) - counts)[offsets[some].astype(np.int64)] != first[some]).any():
            raise ValueError("damaged block")
        yield [d if h else None for d, h in zip(doc_ids.tolist(), has_id.tolist())], lengths, ids


def read_document(content: bytes, doc_id: int, end: bytes = b"") -> np.ndarray | None:
    """The ids of a file's first document ``doc_id``: only its words are
    decoded, found by its offset."""
    for doc_ids, has_id, lengths, offsets, where, values, words, _ in _bodies(content, end):
        for k in np.flatnonzero((doc_ids == doc_id) & (has_id > 0)).tolist()[:1]:
            later = offsets[k + 1:][lengths[k + 1:] > 0]
            stop = int(later[0]) if len(later) else len(words)
            start, n = int(lengths[:k].sum()), int(lengths[k])
            ids = unpack(words[int(offsets[k]):stop] if n else words[:0])
            own = (where >= start) & (where < start + n)
            ids[where[own].astype(np.int64) - start] = values[own]
            return ids
    return None
