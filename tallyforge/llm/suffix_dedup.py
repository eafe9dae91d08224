"""Removal of repeated passages by longest-previous-factor arrays over a partitioned suffix order.

A byte goes when a string of ``least`` bytes that covers it also starts in a document with a smaller id. In suffix order
that is a longest previous factor (LPF) of ``least`` or more, where "previous" means an earlier document: it is the longer
of the common prefixes with the nearest suffix before and after (previous and next smaller value) that belongs to an
earlier document. The suffix array of a corpus is too large to sort, so it is cut in parts that hold all suffixes with a
possible match, and only those:

1. *Parts.* Each window of ``least`` bytes is assigned to its anchor, the substring of ``gram`` bytes with the smallest hash
   in it (a minimizer, the leftmost of equals). Equal windows have equal anchors at equal offsets, so suffixes that share
   ``least`` bytes share a part. Consecutive windows with one anchor are a run; a run is one entry of some 15 bytes.
2. *Equal runs.* Whole runs that are equal are neighbours in suffix order, and all but those of the smallest document have
   a previous smaller position with a common prefix of the whole run. They are settled by key and never fetched. Equal runs
   within one piece of input are settled before anything moves, so a passage that all documents hold is sent once per piece.
3. *Suffix order.* What is left are anchors with different runs around them, such as the ends of a shared passage. The
   bytes of the first document of each run are fetched, and the part's suffixes are sorted byte by byte; common prefixes
   of neighbours and previous and next smaller documents give the LPF of each.
4. The texts are joined with their removed spans and cut.

An anchor with over ``hot_runs`` different runs is split: its windows become suffixes of their own, dealt by all their bytes, so
a frequent phrase between changing words is no large task. The texts are shuffled once, compressed, and serve steps 3 and 4.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import common as C
from tallyforge.session import ship

#: Bytes of a repeated string, and of text for each part of the suffix order.
LEAST, PART_BYTES = 50, 16 << 20
#: Different runs of one anchor from which its windows are dealt by all their bytes.
HOT = 1 << 14
#: Windows that one task sorts, about; bytes of text, or of fetched runs, that are settled before they are sent.
SORT_WINDOWS, POOL_BYTES = 1 << 20, 8 << 20

_U = np.uint64
_BYTE = C.mix(np.arange(1, 257, dtype=_U) * _U(0x9FB21C651E98DF25)) | _U(1)
_LOW40 = _U((1 << 40) - 1)
#: Marks an entry that is settled already.
_SETTLED = 0x80


def _gram(least: int) -> int:
    return max(1, least // 3)


# --- packed columns ---------------------------------------------------------------------------------------------


def _pack(*columns: tuple[np.ndarray, int]) -> bytes:
    """Arrays as byte planes, the first so many bytes of each little-endian number, compressed."""
    sizes = np.array([len(a) for a, _ in columns], dtype="<u4").tobytes()
    planes = [a.astype(a.dtype.newbyteorder("<")).view(np.uint8).reshape(len(a), a.dtype.itemsize)[:, :keep].T.tobytes() for a, keep in columns]
    raw = sizes + b"".join(planes)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes, *columns: tuple[type, int]) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True), np.uint8)
    sizes, at, out = raw[: 4 * len(columns)].view("<u4").tolist(), 4 * len(columns), []
    for n, (kind, keep) in zip(sizes, columns, strict=True):
        wide = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
        wide[:, :keep] = raw[at : at + n * keep].reshape(keep, n).T
        out.append(wide.view(kind).reshape(n))
        at += n * keep
    return out


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _expand(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


# --- 1. runs of windows with one anchor -------------------------------------------------------------------------


def _slide(h: np.ndarray, w: int) -> np.ndarray:
    """The smallest of each ``w`` consecutive values, by doubling."""
    low, span = h, 1
    while span * 2 <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[: len(low) - (w - span)], low[w - span :]) if span < w else low


def runs(data: np.ndarray, offs: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the windows of ``least`` bytes of each row: row, place of the first window in ``data``, number of windows,
    anchor key and run key. Every window that lies in one row is in exactly one run."""
    none = np.zeros(0, np.int64)
    n, k = len(data), _gram(least)
    if n < least:
        return none, none, none, none.astype(_U), none.astype(_U)
    w = least - k + 1
    power, inverse = C._powers(n + 1)
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum(_BYTE[data] * power[:n], dtype=_U, out=total[1:])
    grams = C.mix((total[k:] - total[:-k]) * inverse[: n - k + 1])
    order = (grams >> _U(32)).astype(np.uint32)
    low = _slide(order, w)
    windows = len(low)
    ends = offs[1:]
    row = np.searchsorted(ends, np.arange(windows), "right")
    whole = np.arange(windows) + least <= ends[np.minimum(row, len(ends) - 1)]
    begin = whole.copy()
    begin[1:] &= (low[1:] != low[:-1]) | ~whole[:-1]
    # the first windows of rows that meet without a gap (least = 1) begin a run, too
    begin[1:] |= whole[1:] & (row[1:] != row[:-1])
    start = np.flatnonzero(begin)
    if not len(start):
        return none, none, none, none.astype(_U), none.astype(_U)
    stop = np.append(start[1:], windows)
    stop = np.minimum(stop, np.maximum(ends[row[start]] - least + 1, start + 1))
    anchor = start.copy()
    for a in range(0, len(start), 65536):
        some = start[a : a + 65536]
        anchor[a : a + 65536] = some + order[some[:, None] + np.arange(w)].argmin(axis=1)
    # an equal smallest value further on: the windows behind an anchor have the next one
    late = np.flatnonzero(stop > anchor + 1)
    if len(late):
        more_start, more_stop, more_anchor = [], [], []
        for i in late.tolist():
            s, e = int(start[i]), int(stop[i])
            at = s + np.flatnonzero(order[s : e + w - 1] == low[s])
            at = at[: int(np.searchsorted(at, e)) + 1]
            first = np.maximum(s, np.append(s, at[:-1] + 1))
            keep = first < e
            more_start.append(first[keep])
            more_stop.append(np.minimum(at + 1, e)[keep])
            more_anchor.append(at[keep])
        rest = np.ones(len(start), bool)
        rest[late] = False
        start, stop, anchor = (np.concatenate([x[rest], *more]) for x, more in ((start, more_start), (stop, more_stop), (anchor, more_anchor)))
        by = np.argsort(start, kind="stable")
        start, stop, anchor = start[by], stop[by], anchor[by]
    text = (total[stop + least - 1] - total[start]) * inverse[start]
    run = C.mix(text + (anchor - start + 1).astype(_U) * _U(0x9E3779B97F4A7C15))
    return row[start], start, stop - start, grams[anchor], run


def _pieces(column: pa.Array, least: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows as in ``text_chunks``, a longer text in pieces that overlap by a window: first row, place in its text."""
    for first, _, data, offs in C.text_chunks(column):
        if len(offs) == 2 and len(data) > C.CHUNK_BYTES:
            for at in range(0, len(data) - least + 1, C.CHUNK_BYTES):
                part = data[at : at + C.CHUNK_BYTES + least - 1]
                yield first, at, part, np.array([0, len(part)])
        else:
            yield first, 0, data, offs


_ENTRY = ((np.int64, 8), (np.uint32, 4), (np.uint32, 4), (np.uint32, 4), (np.uint8, 1), (np.uint64, 5), (np.uint64, 7))


def _send(ids: np.ndarray, marks: np.ndarray, doc: np.ndarray, at: np.ndarray, n: np.ndarray, part: np.ndarray, *keys: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Packed entries for each part, those of one document together."""
    by = np.argsort(part, kind="stable")
    cut = np.append(np.flatnonzero(np.append(True, part[by][1:] != part[by][:-1])), len(by))
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        some = by[a:b]
        docs, count = np.unique(doc[some], return_counts=True)
        yield int(part[some[0]]), _pack((ids[docs], 8), (marks[docs], 4), (count.astype(np.uint32), 4), (at[some].astype(np.uint32), 4), (n[some].astype(np.uint8), 1), *((x[some], keep) for x, keep in zip(keys, (5, 7), strict=True)))


def _entries(least: int, parts: int):  # noqa: ANN202
    def flush(pool: list[tuple], table: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        doc, at, n, h, r = (np.concatenate(x) for x in zip(*pool, strict=True))
        ids, marks = (np.concatenate(x) for x in zip(*table, strict=True))
        by = np.lexsort((ids[doc], r, h))
        new = np.append(True, (h[by][1:] != h[by][:-1]) | (r[by][1:] != r[by][:-1]))
        least_id = ids[doc[by]][new][np.cumsum(new) - 1]
        settled = np.zeros(len(h), bool)
        settled[by] = ids[doc[by]] > least_id
        part = np.where(settled, (at + marks[doc]).astype(_U) % _U(parts), (h >> _U(40)) % _U(parts)).astype(np.int64)
        h, r = np.where(settled, _U(0), h & _LOW40), np.where(settled, _U(0), r >> _U(8))
        sent = list(_send(ids, marks, doc, at, n | np.where(settled, _SETTLED, 0), part, h, r))
        for a in range(0, len(sent), 256):
            part_of, blobs = zip(*sent[a : a + 256], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(part_of, pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, table, rows, held = [], [], 0, 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            marks = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32).view(np.uint32)
            for first, shift, data, offs in _pieces(batch.column(2), least):
                row, at, n, h, r = runs(data, offs, least)
                if len(row):
                    pool.append((row + rows, at - offs[row] + shift, n, h, r))
                    table.append((ids[first : first + len(offs) - 1], marks[first : first + len(offs) - 1]))
                    rows += len(offs) - 1
                held += len(data)
                if held >= POOL_BYTES and pool:
                    yield from flush(pool, table)
                    pool, table, rows, held = [], [], 0, 0
        if pool:
            yield from flush(pool, table)

    return run


# --- 2. equal runs ----------------------------------------------------------------------------------------------

#: A document's settled spans (place, windows), and the spans whose bytes are asked for (place, windows, part).
_SPANS = "doc_id long, mark int, gone array<long>, asked array<long>, parts array<long>"
_REPLY = ((np.int64, 8), (np.uint32, 4), (np.int64, 6), (np.int64, 5))


def _reply(ids: np.ndarray, marks: np.ndarray, spans: np.ndarray, route: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Spans packed for the task that gathers their documents. ``route`` is 0 for a settled span, else the part it is asked
    for in, plus 2, or 1 for a hot one."""
    home = ((C.mix(ids.view(_U) ^ marks.astype(_U))) % _U(parts)).astype(np.int64)
    by = np.lexsort((spans, marks, ids, home))
    cut = np.append(np.flatnonzero(np.append(True, home[by][1:] != home[by][:-1])), len(by)) if len(by) else np.zeros(1, np.int64)
    to, blobs = [], []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        some = by[a:b]
        to.append(int(home[some[0]]))
        blobs.append(_pack((ids[some], 8), (marks[some], 4), (spans[some], 6), (route[some], 5)))
        if len(blobs) == 256:
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(blobs, pa.binary())], ["home", "blob"])
            to, blobs = [], []
    if blobs:
        yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(blobs, pa.binary())], ["home", "blob"])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document that has spans."""
    got = [_unpack(blob, *_REPLY) for batch in batches for blob in batch.column(1).to_pylist()]
    if not got:
        return
    ids, marks, spans, route = (np.concatenate(x) for x in zip(*got, strict=True))
    got.clear()
    by = np.lexsort((spans, marks, ids))
    ids, marks, spans, route = ids[by], marks[by], spans[by], route[by]
    cut = np.append(np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1]))), len(ids))
    for a in range(0, len(cut) - 1, 4096):
        some = cut[a : a + 4097]
        inside = slice(int(some[0]), int(some[-1]))
        doc = np.repeat(np.arange(len(some) - 1), np.diff(some))

        def lists(keep: np.ndarray, values: np.ndarray, doc: np.ndarray = doc, n: int = len(some) - 1) -> pa.Array:
            offs = np.zeros(n + 1, np.int32)
            np.cumsum(np.bincount(doc[keep], minlength=n), out=offs[1:])
            return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values[keep], pa.int64()))

        head, at, to = some[:-1], spans[inside], route[inside]
        yield pa.RecordBatch.from_arrays([pa.array(ids[head]), pa.array(marks[head].view(np.int32)), lists(to == 0, at), lists(to > 0, at), lists(to > 0, to - 2)], ["doc_id", "mark", "gone", "asked", "parts"])


def _settle(batches: Iterator[pa.RecordBatch], hot_runs: int, parts: int) -> Iterator[pa.RecordBatch]:
    got = []
    for batch in batches:
        for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids, marks, count, at, n, h, r = _unpack(blob, *_ENTRY)
            got.append((np.repeat(ids, count), np.repeat(marks, count), (at.astype(np.int64) << 8) | (n & 0x7F), n >= _SETTLED, h | _U(part << 40), r))
    if not got:
        return
    ids, marks, spans, settled, h, r = (np.concatenate(x) for x in zip(*got, strict=True))
    got.clear()
    live = np.flatnonzero(~settled)
    live = live[np.lexsort((ids[live], r[live], h[live]))]
    gone, route = settled, np.zeros(len(h), np.int64)
    if len(live):
        group = np.append(True, h[live][1:] != h[live][:-1])
        same = group | np.append(True, r[live][1:] != r[live][:-1])
        first_id = ids[live][same][np.cumsum(same) - 1]
        later = ids[live] > first_id
        gone[live] = later
        # the firsts of each run; an anchor is asked for when they belong to different documents
        which = np.cumsum(group) - 1
        firsts, at = live[~later], which[~later]
        heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        differ = np.minimum.reduceat(ids[firsts], heads) < np.maximum.reduceat(ids[firsts], heads)
        hot = np.add.reduceat(same[~later].astype(np.int64), heads) > hot_runs
        size = np.diff(np.append(heads, len(firsts)))
        key = np.where(np.repeat(hot, size), 1, (C.mix(h[firsts]) >> _U(33)).astype(np.int64) + 2)
        route[firsts] = np.where(np.repeat(differ, size), key, 0)
    told = np.flatnonzero(gone | (route > 0))
    yield from _reply(ids[told], marks[told], spans[told], route[told], parts)


# --- 3. suffix order --------------------------------------------------------------------------------------------

_CONTEXT = ((np.int64, 8), (np.uint32, 4), (np.uint32, 4), (np.uint32, 4), (np.uint8, 1), (np.uint8, 1))


def _fetch(least: int, parts: int):  # noqa: ANN202
    """The bytes of the asked runs, packed for the part of the suffix order they belong to."""
    a1, a2 = (C.mix(np.arange(1, least + 1, dtype=_U) * _U(s)) | _U(1) for s in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))

    def flush(pool: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, marks, at, n, route, text = [], [], [], [], [], []
        hot: list[tuple] = []
        for doc, mark, data, spans, keys in pool:
            for span, key in zip(spans.tolist(), keys.tolist(), strict=True):
                place, windows = span >> 8, span & 0xFF
                if key < 0:
                    hot.append((doc, mark, place, windows, data))
                    continue
                ids.append(doc)
                marks.append(mark)
                at.append(place)
                n.append(windows)
                route.append(key % parts)
                text.append(data[place : place + windows + least - 1])
        if hot:
            starts = [(d, m, p + j, x[p + j : p + j + least]) for d, m, p, w, x in hot for j in range(w)]
            one = np.array([s[0] for s in starts], dtype=np.int64)
            grid = np.frombuffer(b"".join(s[3] for s in starts), np.uint8).reshape(len(starts), least).astype(_U)
            k1, k2 = C.mix((grid * a1).sum(axis=1, dtype=_U)), (grid * a2).sum(axis=1, dtype=_U)
            by = np.lexsort((one, k2, k1))
            new = np.append(True, (k1[by][1:] != k1[by][:-1]) | (k2[by][1:] != k2[by][:-1]))
            settled = np.zeros(len(starts), bool)
            settled[by] = one[by] > one[by][new][np.cumsum(new) - 1]
            for i, (doc, mark, place, window) in enumerate(starts):
                ids.append(doc)
                marks.append(mark)
                at.append(place)
                n.append(1 | (_SETTLED if settled[i] else 0))
                route.append((place + mark if settled[i] else int(k1[i])) % parts)
                text.append(b"" if settled[i] else window)
        ids, marks = np.array(ids, np.int64), np.array(marks, np.int64).astype(np.uint32)
        at, n, route = np.array(at, np.uint32), np.array(n, np.uint8), np.array(route, np.int64)
        by = np.argsort(route, kind="stable")
        cut = np.append(np.flatnonzero(np.append(True, route[by][1:] != route[by][:-1])), len(by))
        blobs, to = [], []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            some = by[a:b]
            raw = np.frombuffer(b"".join(text[i] for i in some.tolist()), np.uint8)
            to.append(int(route[some[0]]))
            blobs.append(_pack((ids[some], 8), (marks[some], 4), (np.ones(len(some), np.uint32), 1), (at[some], 4), (n[some], 1), (raw, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, held = [], 0
        for batch in batches:
            for i in np.flatnonzero(batch.column(3).is_valid().to_numpy(zero_copy_only=False)).tolist():
                spans = np.array(batch.column(3)[i].as_py(), dtype=np.int64)
                if not len(spans):
                    continue
                keys = np.array(batch.column(4)[i].as_py(), dtype=np.int64)
                # the texts of a pool stay whole until it is sent, so they count in full
                data = _expand(batch.column(2)[i].as_py())
                pool.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py() & 0xFFFFFFFF, data, spans, keys))
                held += len(data) + int((spans & 0xFF).sum()) * (least if (keys < 0).any() else 4)
                if held >= POOL_BYTES:
                    yield from flush(pool)
                    pool, held = [], 0
        if pool:
            yield from flush(pool)

    return run


def previous_factors(doc: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """For suffixes in order, the longest common prefix with the nearest one before that has a smaller ``doc``; 0 where
    it is under ``least``. ``lcp[i]`` is the common prefix of suffixes i - 1 and i. An open position jumps over what its
    predecessor has jumped over already, so the jumps double."""
    at, low = np.arange(-1, len(doc) - 1), lcp.astype(np.int64)
    if len(low):
        low[0] = 0
    wait = np.flatnonzero((low >= least) & (doc[at] >= doc))
    while len(wait):
        via = at[wait]
        low[wait], at[wait] = np.minimum(low[wait], low[via]), at[via]
        wait = wait[(at[wait] >= 0) & (low[wait] >= least)]
        wait = wait[doc[at[wait]] >= doc[wait]]
    low[(at < 0) | (low < least)] = 0
    return low


def factors(data: np.ndarray, starts: np.ndarray, doc: np.ndarray, least: int) -> np.ndarray:
    """The longest previous factor, up to ``least``, of the suffixes of ``data`` at ``starts``; ``doc`` says whose they are.
    Suffixes are sorted by their first ``least`` bytes, eight at a time from the last."""
    if not len(starts):
        return np.zeros(0, np.int64)
    out = np.zeros(len(starts), np.int64)
    # a suffix whose first bytes no other one has, by a hash, has no factor of that length and needs no place
    power, inverse = C._powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTE[data] * power[: len(data)], dtype=_U, out=total[1:])
    prints = (total[starts + least] - total[starts]) * inverse[starts]
    by = np.argsort(prints)
    same = prints[by][1:] == prints[by][:-1]
    keep = np.sort(by[np.append(same, False) | np.append(False, same)])
    if not len(keep):
        return out
    starts, doc = starts[keep], doc[keep]
    wide = np.concatenate([data, np.zeros(least + 8, np.uint8)])
    by = np.arange(len(starts))
    for word in range(-(-least // 8) - 1, -1, -1):
        key = np.zeros(len(starts), dtype=_U)
        for i in range(8 * word, min(8 * word + 8, least)):
            key = (key << _U(8)) | wide[starts + i]
        by = by[np.argsort(key[by], kind="stable")]
    lcp = np.zeros(len(starts), np.int64)
    for a in range(1, len(by), 1 << 16):
        some = np.arange(a, min(a + (1 << 16), len(by)))
        left, right = starts[by[some - 1]][:, None] + np.arange(least), starts[by[some]][:, None] + np.arange(least)
        differ = wide[left] != wide[right]
        lcp[some] = np.where(differ.any(axis=1), differ.argmax(axis=1), least)
    order = doc[by]
    before = previous_factors(order, lcp, least)
    after = previous_factors(order[::-1], np.append(0, lcp[1:][::-1]), least)[::-1]
    out[keep[by]] = np.maximum(before, after)
    return out


def _sort(least: int, parts: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [_unpack(blob, (np.int64, 8), (np.uint32, 4), (np.uint32, 1), (np.uint32, 4), (np.uint8, 1), (np.uint8, 1)) for batch in batches for blob in batch.column(1).to_pylist()]
        if not got:
            return
        ids, marks, _, at, n, data = (np.concatenate(x) for x in zip(*got, strict=True))
        got.clear()
        windows, settled = (n & 0x7F).astype(np.int64), n >= _SETTLED
        size = np.where(settled, 0, windows + least - 1)
        begin = np.cumsum(size) - size
        many = np.where(settled, 0, windows)
        owner = np.repeat(np.arange(len(ids)), many)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        hit = factors(data, begin[owner] + inside, ids[owner], least) >= least
        owner, inside = owner[hit], inside[hit]
        # neighbouring windows of one run are one span
        new = np.append(True, (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1] + 1)) if len(owner) else np.zeros(0, bool)
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(owner)))
        spans = ((at[owner[head]].astype(np.int64) + inside[head]) << 8) | count
        done = np.flatnonzero(settled)
        ids, marks = np.concatenate([ids[owner[head]], ids[done]]), np.concatenate([marks[owner[head]], marks[done]])
        spans = np.concatenate([spans, (at[done].astype(np.int64) << 8) | 1])
        yield from _reply(ids, marks, spans, np.zeros(len(ids), np.int64), parts)

    return run


# --- 4. cut -----------------------------------------------------------------------------------------------------


def _cut(least: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                size, removed, spans, kept = [], [], [], []
                for z, gone in zip(batch.column(1).slice(a, 64).to_pylist(), batch.column(2).slice(a, 64).to_pylist(), strict=True):
                    data = _expand(z)
                    size.append(len(data))
                    if not gone:
                        removed.append(0)
                        spans.append([])
                        kept.append(data)
                        continue
                    gone = np.array(gone, dtype=np.int64)
                    step = np.zeros(len(data) + 1, np.int64)
                    np.add.at(step, gone >> 8, 1)
                    np.add.at(step, (gone >> 8) + (gone & 0xFF) + least - 1, -1)
                    off = np.cumsum(step)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], off.view(np.int8), [0]))))
                    removed.append(int(off.sum()))
                    spans.append([{"start": s, "stop": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
                    kept.append(np.frombuffer(data, np.uint8)[~off].tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, 64), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return run


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offs in C.text_chunks(batch.column(2)):
            raw = data.tobytes()
            blobs = [_squeeze(raw[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first), pa.array(blobs, pa.binary())], ["doc_id", "mark", "z"])


def remove_repeats(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text", hot_runs: int = HOT) -> DataFrame:
    """Cut from each text the bytes covered by a string of ``least`` bytes that also starts in a document with a smaller id.

    Returns one row per row of ``docs``: ``doc_id, n_bytes, n_removed, spans`` (maximal removed runs, bytes, end exclusive)
    and ``kept`` (the remaining bytes, which need not be valid UTF-8). All is judged on the input: a removed copy still
    removes later ones. Matches never cross documents, and repeats inside one document stay.

    A null text counts as empty; texts under ``least`` bytes lose nothing. A row without id neither removes nor loses
    bytes. Rows that repeat an id are one place in the order: they do not remove each other's bytes, and each row is cut
    by its own text. Other columns are ignored; an empty table gives none. ``least`` is 3 to 150.

    Keys of equal runs have 96 bits and more, so a chance collision is negligible but not impossible; the suffix
    order compares bytes.
    """
    if not 3 <= least <= 150:
        raise ValueError("least must be 3 to 150")
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    marked = rows.select("doc_id", F.hash("text").alias("mark"), "text")
    entries = marked.where((F.octet_length("text") >= least) & F.col("doc_id").isNotNull()).mapInArrow(C.tidy(_entries(least, parts)), "part int, blob binary")
    settled = entries.repartitionById(parts, "part").mapInArrow(C.tidy(lambda batches: _settle(batches, hot_runs, parts)), "home int, blob binary")
    found = C.stage(settled.repartitionById(parts, "home").mapInArrow(C.tidy(_gather), _SPANS), "runs")
    windows = found.agg(F.sum(F.aggregate("asked", F.lit(0).cast("long"), lambda s, x: s + x.bitwiseAND(255)))).first()[0] or 0
    pieces = max(parts, -(-windows // SORT_WINDOWS))

    # one exchange of texts serves both joins: their left sides are the same plan
    texts = marked.mapInArrow(C.tidy(_compressed), "doc_id long, mark int, z binary").repartition(parts, "doc_id", "mark")
    joined = texts.join(found.hint("shuffle_merge"), ["doc_id", "mark"], "left")
    fetched = joined.select("doc_id", "mark", "z", "asked", "parts").mapInArrow(C.tidy(_fetch(least, pieces)), "part int, blob binary")
    ordered = fetched.repartitionById(pieces, "part").mapInArrow(C.tidy(_sort(least, parts)), "home int, blob binary")
    more = ordered.repartitionById(parts, "home").mapInArrow(C.tidy(_gather), _SPANS).select("doc_id", "mark", F.col("gone").alias("more"))
    none = F.array().cast("array<long>")
    both = texts.join(found.select("doc_id", "mark", "gone").hint("shuffle_merge"), ["doc_id", "mark"], "left").join(more.hint("shuffle_merge"), ["doc_id", "mark"], "left")
    return both.select("doc_id", "z", F.concat(F.coalesce("gone", none), F.coalesce("more", none)).alias("gone")).mapInArrow(
        C.tidy(_cut(least)), "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary"
    )


def digest(cut: DataFrame) -> DataFrame:
    """One short row for each document of ``remove_repeats``."""
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
