"""WARC archives in Zstandard frames: written by Spark, read back validated.

An archive starts with a skippable frame that holds the dictionary its records
were compressed with; then follows one zstd frame per record. The closing empty
skippable frame marks the end of the file. Archives are about ``ARCHIVE_BYTES``
of payload, so a task holds one at a time. Archives of other writers are read
as well: without dictionary, with a compressed one, and without closing frame.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ordermill.session import shared_dir

from .common import text_of
from .files import read_files, write_files

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 1 << 20
DICT_BYTES = 16 << 10
SALTS = 16
DATE = "2000-01-01T00:00:00Z"       # of every record, as the tables hold no fetch time
# Fixed values of the formats.
DICT_MAGIC = b"\x5d\x2a\x4d\x18"
END = "P*M\x18\0\0\0\0"              # an empty skippable frame
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSIONS = ("WARC/1.0", "WARC/1.1")
LENGTH = "X-Payload-Length"          # in own records only
_NAMES = {n.lower(): n for n in ("WARC-Type", "WARC-Record-ID", "WARC-Payload-Digest", "WARC-Block-Digest", "WARC-Target-URI",
                                 "WARC-Refers-To", "WARC-Truncated", "Content-Type", "Content-Length")}
_CHUNK = re.compile(rb"([0-9A-Fa-f]{1,8})[^\r\n]*\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id, url, payload: bytes, digest: str, size: int, refers_to, revisit: bool) -> bytes:
    """A WARC/1.1 record; a revisit has the headers but no payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE),
              ("WARC-Payload-Digest", f"sha256:{digest}"), (LENGTH, size),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    if url is not None:       # line ends would end the header
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _urn(page_id) -> str:
    return "<urn:x-page:null>" if page_id is None else f"<urn:x-page:{page_id}>"


def _page_id(urn: str):
    got = re.fullmatch(r"<urn:x-page:(null|-?\d+)>", urn)
    if not got:
        raise ValueError(f"record id {urn!r}")
    return None if got[1] == "null" else int(got[1])


def archive(records: list[bytes]) -> bytes:
    """The dictionary frame and a frame per record."""
    samples, held = [], 0
    for r in records:
        if held < SAMPLE_BYTES:
            samples.append(r[:32 << 10])
            held += len(samples[-1])
    try:
        trained = zstandard.train_dictionary(DICT_BYTES, samples, k=200, d=8)
        data = trained.as_bytes()
    except zstandard.ZstdError:      # too few records to train on: an empty dictionary frame
        trained, data = None, b""
    packer = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
    return b"".join([DICT_MAGIC + len(data).to_bytes(4, "little") + data, *map(packer.compress, records)])


def _write(batches):
    def out(records):
        return pa.RecordBatch.from_pydict({"file": pa.array([archive(records)], pa.binary())})
    records, held = [], 0
    for batch in batches:
        for r in zip(*[c.to_pylist() for c in batch.columns]):
            page_id, url, payload, digest, size, refers_to, revisit = r
            records.append(record(page_id, url, payload, digest, size, refers_to, revisit))
            held += len(records[-1])
            if held >= ARCHIVE_BYTES:
                yield out(records)
                records, held = [], 0
    if records:
        yield out(records)


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html; null html is empty) as archives.

    Of equal payloads of ``MIN_REVISIT_BYTES`` or more, the one with the
    smallest page_id is a response and the others revisit it (rows repeating
    that id are responses too). Only digests are grouped; the few groups of
    more than one row are dealt over ``SALTS`` copies for the join.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(text_of("html"), "utf-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    groups = (rows.where(F.col("size") >= MIN_REVISIT_BYTES).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    rows = (rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
            .join(groups, ["digest", "salt"], "left")
            .withColumn("revisit", F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))))
    write_files(rows.select("page_id", "url", "payload", "digest", "size", F.col("first").alias("refers_to"), "revisit")
                .mapInArrow(_write, "file binary"), path, END)


def _frame_end(data: memoryview, at: int) -> int:
    """Where the zstd frame at ``at`` ends: its block headers give the sizes."""
    info = zstandard.get_frame_parameters(data[at:at + 18])
    end = at + zstandard.frame_header_size(data[at:at + 18])
    last = False
    while not last:
        head = int.from_bytes(data[end:end + 3], "little")
        last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
        end += 3 + (1 if kind == 1 else size)
        if end > len(data):
            raise ValueError("the archive is cut short")
    return end + 4 * info.has_checksum


def read_records(content: bytes):
    """(headers, http headers, payload) of each record, validated."""
    data = memoryview(content)
    at, known = 0, None
    if bytes(data[:4]) == DICT_MAGIC:
        at = _skipped(data, 0)
        held = bytes(data[8:at])
        if held[:4] == FRAME_MAGIC:
            held = _unpack(zstandard.ZstdDecompressor(), held)
        known = zstandard.ZstdCompressionDict(held) if held else None
    reader = zstandard.ZstdDecompressor(dict_data=known)
    own = closed = found = False
    while at < len(data):
        magic = bytes(data[at:at + 4])
        if magic[1:] == END.encode()[1:4] and magic[0] >> 4 == 5:       # a skippable frame
            stop = _skipped(data, at)
            closed = stop == len(data) and bytes(data[at:stop]) == END.encode()
        elif magic == FRAME_MAGIC:
            stop = _frame_end(data, at)
            for got in parse(_unpack(reader, data[at:stop])):
                own, found = own or LENGTH in got[0], True
                yield got
        else:
            raise ValueError("not a zstd frame")
        at = stop
    if not closed and (own or not found):
        raise ValueError("the archive is cut short")


def _skipped(data: memoryview, at: int) -> int:
    """Where the skippable frame at ``at`` ends."""
    end = at + 8 + int.from_bytes(data[at + 4:at + 8], "little")
    if len(data) < max(at + 8, end):
        raise ValueError("the archive is cut short")
    return end


def _unpack(reader, frame) -> bytes:
    """A whole frame, whether or not its header gives the size."""
    if zstandard.get_frame_parameters(frame).content_size != zstandard.CONTENTSIZE_UNKNOWN:
        return reader.decompress(frame)
    run = reader.decompressobj()
    raw = run.decompress(frame)
    if not run.eof:
        raise ValueError("the archive is cut short")
    return raw


def parse(raw: bytes):
    """The records of one frame."""
    at = 0
    while at < len(raw) or not at:
        stop = raw.find(b"\r\n\r\n", at)
        if stop < 0:
            raise ValueError("no record header")
        headers = _headers(raw[at:stop].decode("utf-8", "replace"))
        size = headers.get("Content-Length", "")
        if not re.fullmatch("[0-9]+", size):
            raise ValueError("no Content-Length")
        block = raw[stop + 4:stop + 4 + int(size)]
        at = stop + 8 + int(size)
        if len(block) != int(size) or raw[at - 4:at] != b"\r\n\r\n":
            raise ValueError("the record's length differs from its header")
        yield headers, *_validated(headers, block)


def _headers(head: str) -> dict[str, str]:
    version, *lines = re.sub(r"\r\n[ \t]+", " ", head).split("\r\n")
    if version not in VERSIONS:
        raise ValueError(f"version {version!r}")
    out = {}
    for line in lines:
        name, found, value = line.partition(":")
        if not found:
            raise ValueError(f"header line {line!r}")
        name = name.strip(" \t")
        out[_NAMES.get(name.lower(), name)] = value.strip(" \t")      # no other blanks: a URL may end in one
    return out


def _validated(headers: dict[str, str], block: bytes):
    """(http headers, payload): own records by all of their headers, others by
    the digests they give; a revisit's payload is elsewhere."""
    kind, digest = headers.get("WARC-Type"), headers.get("WARC-Payload-Digest")
    http, found, payload = block.partition(b"\r\n\r\n")
    if LENGTH in headers:
        size = int(headers[LENGTH])
        if not found or f"Content-Length: {size}".encode() not in http.split(b"\r\n"):
            raise ValueError("the HTTP header differs from the record's")
        if kind == "response":
            if len(payload) != size or digest != f"sha256:{hashlib.sha256(payload).hexdigest()}":
                raise ValueError("the payload differs from its digest")
        elif kind != "revisit" or payload:
            raise ValueError("neither a response nor an empty revisit")
        return http, payload
    if not kind:
        raise ValueError("no WARC-Type")
    if not headers.get("Content-Type", "").lower().startswith("application/http"):
        http, payload = b"", block
    if not _agrees(headers.get("WARC-Block-Digest"), block):
        raise ValueError("the block differs from its digest")
    if kind != "revisit" and "WARC-Truncated" not in headers and not (
            _agrees(digest, payload) or _agrees(digest, _joined(payload))):
        raise ValueError("the payload differs from its digest")
    return http, payload


def _agrees(label: str | None, data: bytes) -> bool:
    """Whether a labelled digest, hex or base32, is that of ``data``; none
    and unknown kinds cannot be checked."""
    kind, _, value = (label or "").partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return True
    own = hashlib.new(kind, data).digest()
    return value.lower() == own.hex() or value.upper().rstrip("=") == base64.b32encode(own).decode().rstrip("=")


def _joined(body: bytes) -> bytes:
    """A body without its chunked transfer coding; any other as it is."""
    out, at = [], 0
    while got := _CHUNK.match(body, at):
        size = int(got[1], 16)
        if not size:
            return b"".join(out)
        out.append(body[got.end():got.end() + size])
        at = got.end() + size + 2
    return body


_FIELDS = ("page_id long, url string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long")
_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                  ("payload_digest", pa.string()), ("record_type", pa.string()),
                  ("refers_to", pa.int64()), ("payload", pa.binary()), ("record_id", pa.string()), ("refers_to_id", pa.string())])
_IDS = ("record_id", "refers_to_id")


def _reader(payloads: bool, ids: bool):
    schema = pa.schema([f for f in _OUT if (payloads or f.name != "payload") and (ids or f.name not in _IDS)])

    def rows(content):
        for headers, _, payload in read_records(content):
            url, number, refers = headers.get("WARC-Target-URI"), headers.get("WARC-Record-ID", ""), headers.get("WARC-Refers-To")
            own, revisit = LENGTH in headers, headers["WARC-Type"] == "revisit"
            if own:
                url = url and re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)) if m[1] in _OWN else m[0], url)
                size = int(headers[LENGTH])
            else:
                url = url and re.sub(r"^<(.*)>$", r"\1", url)
                size = None if revisit else len(payload)
            digest = headers.get("WARC-Payload-Digest")
            row = {"page_id": _page_id(number) if own else None, "url": url, "payload_bytes": size,
                   "payload_digest": digest and digest.removeprefix("sha256:"), "record_type": headers["WARC-Type"],
                   "refers_to": _page_id(refers) if own and refers else None, "payload": None if revisit else payload,
                   "record_id": number or None, "refers_to_id": refers}
            yield {name: row[name] for name in schema.names}

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                got = []
                for row in rows(content):
                    got.append(row)
                    if len(got) == 1000:
                        yield pa.RecordBatch.from_pylist(got, schema)
                        got = []
                yield pa.RecordBatch.from_pylist(got, schema)
    return run


_OWN = {f"{c:02X}" for c in (*range(0x21), 0x25, 0x7F)}      # escapes that record() makes


def read_archives(spark: SparkSession, path: str, payloads: bool = False, ids: bool = False, names: str = "part-*") -> DataFrame:
    """A row per record of the archives under ``path`` whose file names match
    ``names``. ``payloads`` adds the payload (null for a revisit), ``ids`` the
    record ids as written. Archives of other writers are read, too: records of
    every type, with null page_id and refers_to, the payload's bytes (null for
    a revisit) and the digest if given (without ``sha256:``). A damaged archive
    raises ValueError; only an own one is known by its closing frame to be whole."""
    return read_files(spark, path, names).select("content").mapInArrow(
        _reader(payloads, ids), _FIELDS + (", payload binary" if payloads else "") + (", record_id string, refers_to_id string" if ids else ""))


def round_trip(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Write ``pages`` and read the archives back; an empty table writes no
    archive and gives no rows; null url and page_id stay null."""
    path = shared_dir(pages.sparkSession, "llm", "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path, payloads)
