"""Media columns: signature sniffing with an Aho-Corasick automaton.

One pass of the automaton over a value's bytes locates the magic bytes of all formats at once. A validator of the
format then confirms structure and length at each place. A confirmed signature at the start gives the true type, which
corrects the declared one; confirmed ones further in are carved out as embedded media.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import common as C
from tallyforge.session import ship

#: Samples of a payload come in multiples of this.
ALIGN = 64
SAMPLE_RATE = 8000


class Value:
    """A value's bytes, read in place. End marks are searched from left to right once: the next one after a place is also
    the next one after all places up to it."""

    def __init__(self, raw: bytes) -> None:
        self.raw, self.view, self.size = raw, memoryview(raw), len(raw)
        self._next: dict[bytes, tuple[int, int]] = {}
        self._chunks: dict[int, tuple[int, int, int, int, int]] = {}
        self._blocks: dict[int, int] = {}
        self.frames: dict[int, tuple[int, bool]] = {}

    def find(self, mark: bytes, at: int) -> int:
        since, place = self._next.get(mark, (0, -2))
        if place == -2 or at < since or -1 < place < at:
            place = self.raw.find(mark, at)
            self._next[mark] = (at, place)
        return place

    def chunk(self, at: int) -> tuple[int, int, int, int, int]:
        """Of a RIFF chunk: the next one, one far ahead, how many follow, and the first chunk from here on of kind fmt and
        of kind data (the size of the value plus one if there is none). Chunks follow one another in one way only, so each
        is looked at once however many files claim it; the far ones halve the way to any place ahead."""
        never = self.size + 1
        path = []
        while at not in self._chunks and at + 8 <= self.size:
            path.append(at)
            size = self.number(at + 4, 4)
            at += 8 + size + size % 2
        last = self._chunks.get(at)
        for place in reversed(path):
            if last is None:
                here = (at, at, 1, never, never)
            else:
                far = self._chunks.get(last[1])
                # as in a skew-binary list: two stretches of one length make one
                same = far is not None and last[2] - far[2] == far[2] - (self._chunks[far[1]][2] if far[1] in self._chunks else 0)
                here = (at, far[1] if same else at, last[2] + 1, last[3], last[4])
            kind = bytes(self.view[place : place + 4])
            here = (*here[:3], place if kind == b"fmt " else here[3], place if kind == b"data" else here[4])
            self._chunks[place] = last = here
            at = place
        return last if last is not None else (at, at, 0, never, never)

    def after_blocks(self, at: int) -> int:
        """The place behind a run of GIF sub-blocks, each with its length before it; each block is passed once."""
        path = []
        while at not in self._blocks and at < self.size and self.raw[at]:
            path.append(at)
            at += 1 + self.raw[at]
        end = self._blocks.get(at, at + 1)
        for place in path:
            self._blocks[place] = end
        return end

    def number(self, at: int, size: int, order: str = "little") -> int:
        return int.from_bytes(self.view[at : at + size], order)


def _wav(v: Value, at: int) -> int:
    """Length of a RIFF/WAVE file: chunks must follow one another to the declared end and include fmt and data."""
    if at + 12 > v.size or v.view[at + 8 : at + 12] != b"WAVE":
        return 0
    end = at + 8 + v.number(at + 4, 4)
    if end > v.size:
        return 0
    chunk = at + 12
    if chunk + 8 > end:
        return 0
    first = v.chunk(chunk)
    if max(first[3], first[4]) + 8 > end:
        return 0
    while chunk + 8 <= end:
        step = v.chunk(chunk)
        chunk = step[1] if step[1] + 8 <= end else step[0]
    return end - at if chunk in (end, end + 1) else 0


def _png(v: Value, at: int) -> int:
    """Chunks with right checksums from an IHDR of 13 bytes to IEND."""
    chunk = at + 8
    while chunk + 12 <= v.size:
        size = v.number(chunk, 4, "big")
        kind = bytes(v.view[chunk + 4 : chunk + 8])
        if chunk + 12 + size > v.size or (chunk == at + 8 and (kind, size) != (b"IHDR", 13)):
            return 0
        if zlib.crc32(v.view[chunk + 4 : chunk + 8 + size]) != v.number(chunk + 8 + size, 4, "big"):
            return 0
        chunk += 12 + size
        if kind == b"IEND":
            return chunk - at
    return 0


def _gif(v: Value, at: int) -> int:
    """Logical screen, colour table, blocks, trailer. What follows a block does not depend on what came before, so the end
    and whether an image comes are kept for each place passed."""
    b = v.raw
    if at + 14 > v.size:
        return 0
    place, path = at + 13 + (3 << (b[at + 10] & 7) + 1 if b[at + 10] & 0x80 else 0), []
    while place < v.size and place not in v.frames:
        kind = b[place]
        if kind == 0x3B:
            v.frames[place] = (place + 1, False)
        elif kind == 0x21:
            path.append((place, False))
            place = v.after_blocks(place + 2)
        elif kind == 0x2C and place + 10 < v.size:
            path.append((place, True))
            place = v.after_blocks(place + 11 + (3 << (b[place + 9] & 7) + 1 if b[place + 9] & 0x80 else 0))
        else:
            v.frames[place] = (0, False)
    end, images = v.frames.get(place, (0, False))
    for passed, image in reversed(path):
        images = images or image
        v.frames[passed] = (end, images)
    return end - at if end and images else 0


def _jpeg(v: Value, at: int) -> int:
    """Segments with lengths up to a scan, then the end marker."""
    segment = at + 2
    while segment + 4 <= v.size:
        if v.raw[segment] != 0xFF:
            return 0
        if v.raw[segment + 1] == 0xDA:
            end = v.find(b"\xff\xd9", segment)
            return end + 2 - at if end > 0 else 0
        segment += 2 + max(2, v.number(segment + 2, 2, "big"))
    return 0


def _pgm(v: Value, at: int) -> int:
    """Binary grey map: width, height and depth of at most 255, then as many bytes."""
    m = _PGM_HEAD.match(v.raw, at, at + 40)
    if not m or int(m[3]) > 255:
        return 0
    size = int(m[1]) * int(m[2])
    return m.end() + size - at if size and m.end() + size <= v.size else 0


_PGM_HEAD = re.compile(rb"P5\s+([0-9]+)\s+([0-9]+)\s+([0-9]+)\s")


def _pdf(v: Value, at: int) -> int:
    end = v.find(b"%%EOF", at) if v.raw[at + 5 : at + 8].replace(b".", b"0").isdigit() else -1
    return end + 5 - at if end > 0 else 0


def _zip(v: Value, at: int) -> int:
    """A local file header whose archive ends in a directory record within the value."""
    end = v.find(b"PK\x05\x06", at)
    if end < at + 30 or end + 22 > v.size or v.number(end + 16, 4) > end - at:
        return 0
    return end + 22 + v.number(end + 20, 2) - at


def _gzip(v: Value, at: int) -> int:
    """Header fields up to their ends, deflated data, checksum and size."""
    if at + 18 > v.size or v.raw[at + 3] & 0xE0:
        return 0
    flags, place = v.raw[at + 3], at + 10
    if flags & 4:
        place += 2 + v.number(place, 2)
    for _ in range((flags >> 3 & 1) + (flags >> 4 & 1)):  # name and comment
        place = v.find(b"\0", place) + 1
        if not place:
            return 0
    place += flags & 2
    d, crc, size = zlib.decompressobj(-15), 0, 0
    try:
        for begin in range(place, v.size, 1 << 16):
            piece = v.view[begin : begin + (1 << 16)]
            while not d.eof and len(piece):
                out = d.decompress(piece, 1 << 20)
                crc, size, piece = zlib.crc32(out, crc), size + len(out), d.unconsumed_tail
            if d.eof:
                end = min(begin + (1 << 16), v.size) - len(d.unused_data)
                right = end + 8 <= v.size and (v.number(end, 4), v.number(end + 4, 4)) == (crc, size & 0xFFFFFFFF)
                return end + 8 - at if right else 0
    except zlib.error:
        pass
    return 0


#: Magic bytes, media type, validator (length of the file at a place, 0 if it is none).
SIGNATURES: list[tuple[bytes, str, Callable[[Value, int], int]]] = [
    (b"RIFF", "audio/wav", _wav),
    (b"\x89PNG\r\n\x1a\n", "image/png", _png),
    (b"GIF87a", "image/gif", _gif),
    (b"GIF89a", "image/gif", _gif),
    (b"\xff\xd8\xff", "image/jpeg", _jpeg),
    (b"P5", "image/x-portable-graymap", _pgm),
    (b"%PDF-", "application/pdf", _pdf),
    (b"PK\x03\x04", "application/zip", _zip),
    (b"\x1f\x8b\x08", "application/gzip", _gzip),
]


def automaton() -> ahocorasick.Automaton:
    """The magic bytes of all formats, over bytes read as Latin-1."""
    a = ahocorasick.Automaton()
    for i, (magic, _, _) in enumerate(SIGNATURES):
        a.add_word(magic.decode("latin-1"), i)
    a.make_automaton()
    return a


def sniff(value: bytes, machine: ahocorasick.Automaton) -> tuple[str, int, list[tuple[str, int, int]], int]:
    """``type, length, embedded, places``: the confirmed type and length at the start ("" and 0 if none), confirmed media
    further in as (type, start, end), and how many magic bytes were found. Media inside carved media are not
    carved again."""
    v = Value(value)
    kind, length, embedded, places, free = "", 0, [], 0, 1
    for last, i in machine.iter(value.decode("latin-1")):
        magic, name, check = SIGNATURES[i]
        at = last - len(magic) + 1
        places += 1
        if at and at < free:
            continue
        size = check(v, at)
        if size and at == 0:
            kind, length = name, size
        elif size:
            embedded.append((name, at, at + size))
            free = at + size
    return kind, length, embedded, places


def to_wav(payload: bytes) -> bytes:
    """A mono WAV file with one unsigned 8-bit sample for each byte; the length must be even."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, SAMPLE_RATE, SAMPLE_RATE, 1, 8, b"data", len(payload))
    return head + payload


def from_wav(stored: bytes) -> bytes:
    """The samples of a mono 8-bit WAV file, found by its chunk sizes."""
    if stored[:4] != b"RIFF" or not _wav(Value(stored), 0):
        raise ValueError("not a WAV file")
    at = 12
    while stored[at : at + 4] != b"data":
        size = int.from_bytes(stored[at + 4 : at + 8], "little")
        at += 8 + size + size % 2
    return stored[at + 8 : at + 8 + int.from_bytes(stored[at + 4 : at + 8], "little")]


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offs in C.text_chunks(batch.column(1)):
            raw = data.tobytes()
            made = []
            for s, e in zip(offs[:-1], offs[1:], strict=True):
                n = max(ALIGN, -(-int(e - s) // ALIGN) * ALIGN)
                made.append(to_wav(raw[s:e].ljust(n, b"\0")))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(offs), pa.int64()), pa.array(made, pa.binary())], ["doc_id", "n_bytes", "media"])


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, media, declared``: each text's UTF-8 bytes, padded to a positive multiple of 64, as a WAV file. Null
    texts are stored like empty ones; null ids stay null; repeated rows repeat; other columns are left out."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(C.tidy(_encode), "doc_id long, n_bytes long, media binary").withColumn("declared", F.lit("application/octet-stream"))


_SNIFFED = "type string, length long, corrected boolean, places int, embedded array<struct<type:string,start:long,end:long>>"


def _sniffer(media: int, declared: int, carry: list[int], names: list[str]):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for batch in batches:
            kinds, lengths, corrected, places, inside = [], [], [], [], []
            for value, said in zip(batch.column(media), batch.column(declared), strict=True):
                raw, said = value.as_py(), said.as_py()
                kind, length, found, n = sniff(raw, machine) if raw else ("", 0, [], 0)
                kinds.append(kind or said)
                lengths.append(length)
                corrected.append(bool(kind) and kind != said)
                places.append(n)
                inside.append([{"type": t, "start": a, "end": b} for t, a, b in found])
            kept = [batch.column(i) for i in carry]
            new = [
                pa.array(kinds, pa.string()),
                pa.array(lengths, pa.int64()),
                pa.array(corrected, pa.bool_()),
                pa.array(places, pa.int32()),
                pa.array(inside, pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
            ]
            yield pa.RecordBatch.from_arrays(kept + new, names=names)

    return run


def sniff_media(df: DataFrame, media_col: str = "media", declared_col: str = "declared") -> DataFrame:
    """Add ``type`` (confirmed, else as declared), ``length`` of the confirmed file (0 if none), ``corrected``, ``places`` (magic bytes
    found) and ``embedded`` (carved media). Null and empty values keep the declared type. Columns of ``df`` with those
    names are replaced. Every row is handled by itself, without a shuffle."""
    ship(df.sparkSession)
    new = [c.split()[0] for c in ("type", "length", "corrected", "places", "embedded")]
    carry = [c for c in df.columns if c not in new]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in carry), _SNIFFED])
    order = df.columns
    return df.mapInArrow(C.tidy(_sniffer(order.index(media_col), order.index(declared_col), [order.index(c) for c in carry], carry + new)), schema)


def carve(sniffed: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row per embedded medium: ``id_col, part, type, bytes``."""
    parts = sniffed.select(id_col, media_col, F.posexplode("embedded").alias("part", "e"))
    return parts.select(id_col, "part", "e.type", F.substring(F.col(media_col), (F.col("e.start") + 1).cast("int"), (F.col("e.end") - F.col("e.start")).cast("int")).alias("bytes"))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for value, kind, places, inside in zip(batch.column(2), batch.column(3), batch.column(4), batch.column(5), strict=True):
            raw = value.as_py()
            samples = from_wav(raw)
            wave = np.frombuffer(samples, np.uint8)
            feature = f"{kind.as_py()} mean={wave.mean():.3f} std={wave.std():.3f} crossings={int((np.diff((wave >= 128).astype(np.int8)) != 0).sum())} places={places.as_py()} embedded={len(inside)}"
            for x, v in zip(out, (len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-ALIGN:]), len(raw), hashlib.sha256(raw).hexdigest(), feature), strict=True):
                x.append(v)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x, t) for x, t in zip(out, kinds, strict=True))], names=names)


def digest(stored: DataFrame) -> DataFrame:
    """Read stored media back and describe each row; equal texts give equal values."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    rows = sniff_media(stored).select("doc_id", "n_bytes", "media", "type", "places", F.transform("embedded", lambda e: e["start"]).alias("inside"))
    return rows.mapInArrow(C.tidy(_features), schema)
