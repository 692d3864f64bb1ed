"""Token-id output: texts encoded by a public tokenizer, written in doc_id
order as Simple-8b files (:mod:`.simple8b`), and read back."""

from __future__ import annotations

import os
import re
import string
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ordermill.session import shared_dir

from .files import read_files, write_files
from .simple8b import read_blocks, write_block
from .common import materialise, text_of

END_ID = 1
TERMINATOR = "\n"
BLOCK_IDS = 1 << 16
FILE_BYTES = 8 << 20
CACHE_WORDS = 250_000       # of each of a worker's two caches: about 90 MB together
CACHED_CHARS = 64           # longer words seldom come again, so caches hold none
SLICE_CHARS = 1 << 20       # encoded at a time
LATIN_END = 0x250           # letters below this code point
JOINED_WORDS = 200          # distinct words encoded in one call
MERGED_WORDS = 2000         # plain ones
_ENCODERS: dict = {}


class Encoder:
    """Encodes texts word by word, each distinct word once.

    The tokenizer collapses white space and drops it before its merges, so the
    ids of a text are those of its parts between blanks, line feeds and tabs.
    A part that may hold an added token is encoded as it stands; only texts
    of Latin letters are lower-cased here, where that is what the tokenizer's
    own steps do.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        special = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.separator, self.separator_id = special[0] if special else (None, None)
        self.hooks = {a[:2] for a in self.added}
        # Lower-case Latin letters pass the tokenizer's normalizer unchanged and
        # stay one piece, so such words go to the merges at once; the last id of
        # each ends a word.
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        letters = [c for c in map(chr, range(LATIN_END)) if c.isalpha() and c.lower() == c == unicodedata.normalize("NFC", c)]
        self.spelling = {ord(c): spell(c)[0][0] for c in letters}
        self.latin = re.compile(f"[{''.join(letters)}]+").fullmatch
        self.beyond = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}\u2010-\u2027]").search
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = WhitespaceSplit()
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def plain(self, text: str) -> str:
        """A text as blanks part its words, in lower case where that is what
        the tokenizer's own steps make of it."""
        if not any(h in text for h in self.hooks) and (text.isascii() or not self.beyond(text)):
            text = text.lower()
        return text.replace("\n", " ").replace("\t", " ")

    def pieces(self, words: pa.LargeStringArray) -> pa.LargeStringArray:
        """Two pieces a word: the word up to its last letter, and the marks
        after it, which the tokenizer splits off as a piece of their own; the
        second is empty where there are none. Both lie in the words' memory."""
        if not len(words):
            return words
        cores = pc.utf8_rtrim(words, characters=string.punctuation)
        last = pc.utf8_slice_codeunits(cores, -1)
        letters = [c for c in last.unique().to_pylist() if c and c.lower()[-1].isalpha()]
        apart = pc.is_in(last, value_set=pa.array(letters, last.type))
        for hook in self.hooks:
            apart = pc.and_not(apart, pc.match_substring(words, hook))
        sizes = pc.if_else(apart, pc.binary_length(cores), pc.binary_length(words)).to_numpy()
        _, offsets, letters = words.buffers()
        bounds = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
        cuts = np.empty(2 * len(words) + 1, np.int64)
        cuts[::2], cuts[1::2] = bounds, bounds[:-1] + sizes
        return pa.LargeStringArray.from_buffers(2 * len(words), pa.py_buffer(cuts), letters)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word: plain words by the merges alone, others many a
        call, parted by an added token; the empty word has none."""
        got = {"": b""}
        plain = list(filter(self.latin, words)) if self.ends.any() else []
        for k in range(0, len(plain), MERGED_WORDS):
            some = plain[k:k + MERGED_WORDS]
            ids = np.array(self.merges.encode_batch_fast([" ".join(some).translate(self.spelling)], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) != len(some):
                raise ValueError("a word has no end")
            flat = ids.tobytes()
            got.update(zip(some, [flat[a:b] for a, b in zip([0, *cuts], cuts)]))
        rest = [w for w in words if w not in got]
        if rest:
            got |= self._by_calls(rest)
        return [got[w] for w in words]

    def _by_calls(self, words: list[str]) -> dict[str, bytes]:
        part = self.separator
        every = "\n".join(words)
        hooks = {a[:2] for a in self.added if a[:2] in every}
        alone = {w for w in words if part is None or any(h in w for h in hooks)} if hooks or part is None else set()
        joined = [w for w in words if w not in alone] if alone else words
        got: dict[str, bytes] = {}
        calls = [joined[k:k + JOINED_WORDS] for k in range(0, len(joined), JOINED_WORDS)]
        alone = list(alone)
        texts = [f" {part} ".join(c) for c in calls] + alone
        for call, out in zip([*calls, *[[w] for w in alone]],
                             self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(out.ids, "<u4")
            cuts = np.flatnonzero(ids == self.separator_id) if len(call) > 1 else []
            if len(cuts) != len(call) - 1:
                raise ValueError("the separator was not kept apart")
            flat, a = ids.tobytes(), 0
            for word, b in zip(call, [*(4 * np.asarray(cuts, np.int64)).tolist(), len(flat)]):
                got[word] = flat[a:b]
                a = b + 4
        return got

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words: known ones from the two caches, of which the
        older goes once the younger is full, so frequent words stay."""
        got = list(map(self.cache.get, words))
        new = [w for w, ids in zip(words, got) if ids is None]
        if not new:
            return got
        fresh = {w: ids for w, ids in zip(new, map(self.older.get, new)) if ids is not None}
        missing = [w for w in new if w not in fresh] if fresh else new
        fresh.update(zip(missing, self.encode_words(missing)))
        got = [fresh[w] if ids is None else ids for w, ids in zip(words, got)]
        fresh = {w: ids for w, ids in fresh.items() if len(w) <= CACHED_CHARS}
        if len(self.cache) + len(fresh) > CACHE_WORDS:
            self.older, self.cache = self.cache, {}
        self.cache.update(fresh)
        return got

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, lengths = self.encode_all(texts)
        return np.split(ids, np.cumsum(lengths)[:-1]) if texts else []

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has. Words are
        split and numbered as Arrow arrays; Python sees each distinct one."""
        parts = pc.split_pattern(pa.array([self.plain(t) for t in texts], pa.large_string()), " ")
        coded = parts.flatten().dictionary_encode()
        pieces = self.pieces(coded.dictionary).dictionary_encode()
        ids = self.ids_of(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool, sizes = _gather(np.frombuffer(b"".join(ids), "<u4"), sizes, pieces.indices.to_numpy())
        pool, sizes = _gather(pool, sizes[::2] + sizes[1::2], coded.indices.to_numpy())
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return pool, np.diff(ends[parts.offsets.to_numpy()])


def _gather(pool: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen runs of ``pool``, which holds runs of these sizes, in a row;
    and the size of each."""
    first, size = np.cumsum(sizes) - sizes, sizes[chosen]
    ends = np.cumsum(size)
    at = np.repeat(first[chosen] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    return pool[at], size


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _slices(batch: pa.RecordBatch, size: int = SLICE_CHARS):
    """Runs of a batch's documents of about ``size`` characters."""
    ends = np.cumsum(pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = 0
    while a < batch.num_rows:
        before = int(ends[a - 1]) if a else 0
        b = min(int(np.searchsorted(ends, before + size)) + 1, batch.num_rows)
        yield batch.slice(a, b - a)
        a = b


def _blocks(doc_ids: list, ids: np.ndarray, lengths: np.ndarray):
    """Blocks of whole documents, each with its end id, of about ``BLOCK_IDS`` ids."""
    ids = np.insert(ids, np.cumsum(lengths), END_ID)
    ends = np.cumsum(lengths + 1)
    a = 0
    while a < len(doc_ids):
        before = int(ends[a - 1]) if a else 0
        b = min(int(np.searchsorted(ends, before + BLOCK_IDS)) + 1, len(doc_ids))
        yield write_block(doc_ids[a:b], ids[before:int(ends[b - 1])], lengths[a:b] + 1)
        a = b


def _write(path: str):
    def run(batches):
        encoder, done, size = _encoder(path), [], 0
        for batch in batches:
            for part in _slices(batch):
                for block in _blocks(part.column(0).to_pylist(), *encoder.encode_all(part.column(1).to_pylist())):
                    done.append(block)
                    size += len(block)
                    if size >= FILE_BYTES:
                        yield pa.RecordBatch.from_pydict({"file": pa.array([b"".join(done)], pa.binary())})
                        done, size = [], 0
        if done:
            yield pa.RecordBatch.from_pydict({"file": pa.array([b"".join(done)], pa.binary())})

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str | None = None) -> None:
    """Write the ids of ``docs`` (``doc_id``, ``text``) in ascending doc_id
    order; a null id comes first, rows of one id by their texts' hash."""
    tokenizer_path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    files = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
             .mapInArrow(_write(tokenizer_path), "file binary"))
    write_files(files, path, TERMINATOR)


_ROWS = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("doc_id", pa.int64()),
                   ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _read(batches):
    for batch in batches:
        for row in batch.to_pylist():
            at = 0
            for doc_ids, lengths, ids in read_blocks(row["content"], TERMINATOR.encode()):
                ends = np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths.astype(np.int64)
                flat = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                k = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * k, pa.int64()), pa.array([row["chunk"]] * k, pa.int64()),
                     pa.array(doc_ids, pa.int64()), pa.array(starts + at), pa.array(lengths.astype(np.int64)),
                     pa.array(crcs, pa.int64())], schema=_ROWS)
                at += len(ids)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, each
    of which is read once."""
    docs = materialise(read_files(spark, path).mapInArrow(
        _read, "part long, chunk long, doc_id long, local long, n_tokens long, ids_crc32 long"), "token_rows")
    files = docs.groupBy("part", "chunk").agg(F.max(F.col("local") + F.col("n_tokens")).alias("n"))      # a row per file
    before = Window.orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return docs.join(files, ["part", "chunk"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Write and read back; null text is empty (the end id alone), an empty
    table gives no files and no rows, repeated rows are written again."""
    path = shared_dir(docs.sparkSession, "llm", "token_files")
    write_tokens(docs, path, tokenizer_path)
    return read_tokens(docs.sparkSession, path)
