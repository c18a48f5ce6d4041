"""Operator 3 — media columns: signature sniffing, type correction and carving.

An Aho-Corasick automaton finds every magic number in one pass over the bytes.  A hit counts only
if the format's own structure holds there: lengths, checksums and end markers are followed, which
also gives the extent of the medium.  A medium that starts at 0 corrects the declared type; media
inside another one are carved.  Outermost, leftmost media win; a carved medium is not searched again
(its container's samples are: a WAV file's data chunk may hold anything).

A PDF's end is the last end mark before the next PDF header whose cross-reference table is in its place.

Defined cases: null bytes give a null type and no media; empty bytes and unknown formats keep the
declared type; truncated media are not media; equal bytes give equal results; null ids
are kept; columns that are named like the results are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import batches, doc_columns, map_arrow, prepare, stage, texts_of

UNIT = 64
#: Bytes given to a decompressor at a time.
SLICE = 1 << 16
_OGG_TABLE: list[int] = []


#: What validators have found out about the bytes at hand, so that no stretch is searched again for each hit.
Memo = dict


def _png(d: bytes, i: int, memo: Memo) -> int | None:
    at = i + 8
    if d[at : at + 8] != b"\0\0\0\rIHDR":
        return None
    while at + 12 <= len(d):
        n = int.from_bytes(d[at : at + 4], "big")
        stop = at + 12 + n
        if stop > len(d) or not d[at + 4 : at + 8].isalpha() or zlib.crc32(memoryview(d)[at + 4 : at + 8 + n]) != int.from_bytes(d[stop - 4 : stop], "big"):
            return None
        if d[at + 4 : at + 8] == b"IEND":
            return stop
        at = stop
    return None


def _wav(d: bytes, i: int, memo: Memo) -> int | None:
    if d[i + 8 : i + 12] != b"WAVE":
        return None
    stop = i + 8 + int.from_bytes(d[i + 4 : i + 8], "little")
    at, seen = i + 12, set()
    while at + 8 <= stop <= len(d):
        seen.add(d[at : at + 4])
        n = int.from_bytes(d[at + 4 : at + 8], "little")
        at += 8 + n + (n & 1)
    return stop if at == stop and {b"fmt ", b"data"} <= seen else None


def _gif(d: bytes, i: int, memo: Memo) -> int | None:
    if i + 13 > len(d):
        return None
    at = i + 13 + (3 << ((d[i + 10] & 7) + 1) if d[i + 10] & 128 else 0)

    def blocks(at: int) -> int | None:
        while at < len(d):
            if not d[at]:
                return at + 1
            at += 1 + d[at]
        return None

    while at < len(d):
        if d[at] == 0x3B:
            return at + 1
        if d[at] == 0x21:
            after = blocks(at + 2)
        elif d[at] == 0x2C and at + 10 <= len(d):
            after = blocks(at + 11 + (3 << ((d[at + 9] & 7) + 1) if d[at + 9] & 128 else 0))
        else:
            return None
        if after is None:
            return None
        at = after
    return None


def _jpeg(d: bytes, i: int, memo: Memo) -> int | None:
    at = i + 2
    while at + 4 <= len(d) and d[at] == 0xFF:
        kind = d[at + 1]
        if kind == 0xD9:
            return at + 2
        at += 2 + int.from_bytes(d[at + 2 : at + 4], "big")
        if kind == 0xDA:  # entropy-coded data up to the next real marker
            while (at := d.find(b"\xff", at)) >= 0 and at + 1 < len(d) and (d[at + 1] == 0 or 0xD0 <= d[at + 1] <= 0xD7):
                at += 2
            if at < 0:
                return None
            if d[at : at + 2] == b"\xff\xd9":
                return at + 2
    return None


def _bmp(d: bytes, i: int, memo: Memo) -> int | None:
    if i + 54 > len(d):
        return None
    size, zero, start, header = struct.unpack_from("<IIII", d, i + 2)
    return i + size if not zero and 54 <= start <= size <= len(d) - i and header in (40, 108, 124) else None


def _next_nul(d: bytes, at: int, memo: Memo) -> int:
    """The first NUL byte from a place on, -1 if there is none; a stretch is searched once."""
    low, high = memo.get("nul", (0, -2))
    if high == -2 or not low <= at <= (len(d) if high == -1 else high):
        high = d.find(b"\0", at)
        memo["nul"] = at, high
    return high


def _gzip_data(d: bytes, i: int, memo: Memo) -> int | None:
    """Where the deflated data of a member begin; its header is whole and has no reserved flag."""
    if i + 18 > len(d) or d[i + 3] & 0xE0:
        return None
    flags, at = d[i + 3], i + 10
    if flags & 4:
        at += 2 + int.from_bytes(d[at : at + 2], "little")
    for named in (8, 16):
        if flags & named:
            end = _next_nul(d, at, memo) if at < len(d) else -1
            if end < 0:
                return None
            at = end + 1
    if flags & 2:
        at += 2
    return at if at + 8 < len(d) else None


def _inflated(d: bytes, first: int) -> int | None:
    """Where a member ends whose data begin at ``first``, read in growing slices of the bytes themselves."""
    reader, view, at, crc, size, step = zlib.decompressobj(-15), memoryview(d), first, 0, 0, 512
    try:
        while at < len(d) and not reader.eof:
            left, at, step = view[at : at + step], at + step, min(2 * step, SLICE)
            while len(left) and not reader.eof:
                out = reader.decompress(left, 1 << 20)
                crc, size, left = zlib.crc32(out, crc), size + len(out), reader.unconsumed_tail
    except zlib.error:
        return None
    stop = min(at, len(d)) - len(reader.unused_data)
    whole = reader.eof and stop + 8 <= len(d) and struct.unpack_from("<II", d, stop) == (crc, size & 0xFFFFFFFF)
    return stop + 8 if whole else None


def _gzip(d: bytes, i: int, memo: Memo) -> int | None:
    """Headers may share one place where their data begin: it is inflated once."""
    ends = memo.setdefault("gzip", {})
    at = _gzip_data(d, i, memo)
    if at is None:
        return None
    if at not in ends:
        ends[at] = _inflated(d, at)
    if d[i + 3] & 2 and ends[at] and zlib.crc32(memoryview(d)[i : at - 2]) & 0xFFFF != int.from_bytes(d[at - 2 : at], "little"):
        return None
    return ends[at]


def _zip_ends(d: bytes) -> dict[int, int]:
    """Start and stop of every archive, from the end records: they tell where their archive starts."""
    found: dict[int, int] = {}
    at = d.find(b"PK\x05\x06")
    while at >= 0 and at + 22 <= len(d):
        size, offset, note = struct.unpack_from("<IIH", d, at + 12)
        start = at - size - offset
        if start >= 0 and at + 22 + note <= len(d) and d[at - size : at - size + 4] in (b"PK\x01\x02", b"PK\x05\x06"):
            found.setdefault(start, at + 22 + note)
        at = d.find(b"PK\x05\x06", at + 4)
    return found


def _zip(d: bytes, i: int, memo: Memo) -> int | None:
    if "zip" not in memo:
        memo["zip"] = _zip_ends(d)
    return memo["zip"].get(i)


_PDF_END = re.compile(rb"startxref\s{1,8}(\d{1,15})\s{1,8}%%EOF")
_PDF_OBJECT = re.compile(rb"\d{1,10}\s\d{1,5}\sobj")


def _pdf(d: bytes, i: int, memo: Memo) -> int | None:
    """The last end mark before the next header whose cross-reference table is where it says."""
    if "pdf" not in memo:
        memo["pdf"] = [m.start() for m in re.finditer(b"%PDF-", d)], [(m.start(), m.end(), int(m[1])) for m in _PDF_END.finditer(d)]
    heads, ends = memo["pdf"]
    place = bisect_right(heads, i)
    upto = bisect_left(ends, (heads[place] if place < len(heads) else len(d),))
    for k in range(upto - 1, -1, -1):
        start, stop, offset = ends[k]
        if start < i:
            break
        at = i + offset
        if at < start and (d.startswith(b"xref", at) or _PDF_OBJECT.match(d, at)):
            return stop
    return None


def _ogg_crc(page: bytes) -> int:
    if not _OGG_TABLE:
        for k in range(256):
            c = k << 24
            for _ in range(8):
                c = (c << 1 ^ 0x04C11DB7) & 0xFFFFFFFF if c >> 31 else c << 1
            _OGG_TABLE.append(c)
    c = 0
    for x in page:
        c = (c << 8 & 0xFFFFFFFF) ^ _OGG_TABLE[c >> 24 ^ x]
    return c


def _ogg(d: bytes, i: int, memo: Memo) -> int | None:
    dead, seen, at = memo.setdefault("ogg", set()), [], i
    while d[at : at + 4] == b"OggS" and at + 27 <= len(d) and at not in dead:
        seen.append(at)
        n = d[at + 26]
        stop = at + 27 + n + sum(d[at + 27 : at + 27 + n])
        if stop > len(d) or d[at + 4] or _ogg_crc(d[at : at + 22] + bytes(4) + d[at + 26 : stop]) != int.from_bytes(d[at + 22 : at + 26], "little"):
            break
        if d[at + 5] & 4:
            return stop
        at = stop
    dead.update(seen)
    return None


#: Magic numbers of the formats, their media types and their validators.
FORMATS: dict[bytes, tuple[str, Callable[[bytes, int, Memo], int | None]]] = {
    b"\x89PNG\r\n\x1a\n": ("image/png", _png),
    b"RIFF": ("audio/wav", _wav),
    b"GIF87a": ("image/gif", _gif),
    b"GIF89a": ("image/gif", _gif),
    b"\xff\xd8\xff": ("image/jpeg", _jpeg),
    b"BM": ("image/bmp", _bmp),
    b"\x1f\x8b\x08": ("application/gzip", _gzip),
    b"PK\x03\x04": ("application/zip", _zip),
    b"%PDF-": ("application/pdf", _pdf),
    b"OggS": ("audio/ogg", _ogg),
}


@lru_cache(1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for magic in FORMATS:
        found.add_word(magic.decode("latin-1"), magic)
    found.make_automaton()
    return found


def sniff(data: bytes | None, declared: str | None = None) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The corrected type, and (type, start, length) of the media carved from inside."""
    if data is None:
        return None, []
    whole, inside, free = None, [], 0
    memo: Memo = {}
    for last, magic in _automaton().iter(data.decode("latin-1")):
        start = last + 1 - len(magic)
        if start < free:
            continue
        kind, validate = FORMATS[magic]
        stop = validate(data, start, memo)
        if stop is None:
            continue
        if start == 0:
            whole = kind
            if stop == len(data):
                continue  # the container itself: go on inside it
        inside.append((kind, start, stop - start))
        free = stop
    return whole or declared, inside


def wav(samples: bytes, rate: int = 8000) -> bytes:
    """8-bit mono PCM of the samples, an even number of them."""
    fmt = struct.pack("<HHIIHH", 1, 1, rate, rate, 1, 8)
    return b"RIFF" + struct.pack("<I", 36 + len(samples)) + b"WAVEfmt " + struct.pack("<I", 16) + fmt + b"data" + struct.pack("<I", len(samples)) + samples


def wav_samples(media: bytes) -> bytes:
    """The samples of a stored medium, found by its chunks."""
    if _wav(media, 0, {}) != len(media):
        raise ValueError("not a whole WAV file")
    at = 12
    while media[at : at + 4] != b"data":
        n = int.from_bytes(media[at + 4 : at + 8], "little")
        at += 8 + n + (n & 1)
    return media[at + 8 : at + 8 + int.from_bytes(media[at + 4 : at + 8], "little")]


def sniff_media(media: DataFrame, column: str = "media", declared: str = "declared") -> DataFrame:
    """The rows of ``media`` with sniffed_type and carved, an array of (type, start, length)."""
    prepare(media.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema.fields if f.name not in ("sniffed_type", "carved"))
    names = [f.name for f in media.schema.fields if f.name not in ("sniffed_type", "carved")]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))
        for b in batches(rows):
            found = [sniff(d, t) for d, t in zip(b.column(column).to_pylist(), b.column(declared).to_pylist(), strict=True)]
            carved = pa.array([[{"type": t, "start": s, "length": n} for t, s, n in c] for _, c in found], kind)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array([t for t, _ in found], pa.string()), carved], names=[*names, "sniffed_type", "carved"])

    return map_arrow(media.select(*[f"`{n}`" for n in names]), run, fields + ", sniffed_type string, carved array<struct<type:string,start:bigint,length:bigint>>")


def store_texts(documents: DataFrame) -> DataFrame:
    """Every whole text, zero-padded to a positive multiple of 64 bytes, as a WAV file in a written table."""
    prepare(documents.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            raw = [t.encode() for t in texts_of(b.column("text"))]
            stored = [wav(x + bytes(max(UNIT, -(-len(x) // UNIT) * UNIT) - len(x))) for x in raw]
            kinds = pa.array(["application/octet-stream"] * len(raw), pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(map(len, raw), pa.int64()), kinds, pa.array(stored, pa.binary())], names=["doc_id", "n_bytes", "declared", "media"])

    stored = map_arrow(doc_columns(documents, "doc_id", "text"), run, "doc_id long, n_bytes long, declared string, media binary")
    return stage(documents.sparkSession, stored, "media")


def media_digest(documents: DataFrame) -> DataFrame:
    """Store all texts, read the stored media back, sniff them and describe what was read."""
    sniffed = sniff_media(store_texts(documents))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            media = b.column("media").to_pylist()
            payloads = [wav_samples(m) for m in media]
            columns = [
                b.column("doc_id"),
                b.column("n_bytes"),
                pa.array(map(len, payloads), pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in payloads], pa.string()),
                pa.array([zlib.crc32(p[-UNIT:]) for p in payloads], pa.int64()),
                pa.array(map(len, media), pa.int64()),
                pa.array([hashlib.sha256(m).hexdigest() for m in media], pa.string()),
                b.column("declared"),
                b.column("sniffed_type"),
                b.column("carved"),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "declared", "sniffed_type", "carved"]
    read = map_arrow(sniffed, run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, declared string, sniffed_type string, carved array<struct<type:string,start:bigint,length:bigint>>")
    spans = F.array_join(F.transform("carved", lambda c: F.concat_ws(":", c["type"], c["start"].cast("string"), c["length"].cast("string"))), ",")
    feature = F.concat(F.lit("declared="), "declared", F.lit(";type="), F.coalesce("sniffed_type", F.lit("")), F.lit(";carved="), spans)
    return read.withColumn("feature", feature).drop("declared", "sniffed_type", "carved")
