"""Token ids in Re-Pair shard files.

Documents are tokenised, put in ascending id order by a range shuffle, and written in blocks. Within a block frequent
neighbouring id pairs are replaced by nonterminals, again and again; the block keeps the rules, the expansion length
of each symbol, and where each document begins, so that one document can be decoded without the rest.

A block (bytes, little-endian): ``RPB2``; uint32 counts of documents, terminal ids, rules and symbols, and the width of a
symbol (2 or 4 bytes); per document uint64 first symbol and uint64 first id; rules as pairs of symbols; expansion
lengths as uint32; the symbols. Nonterminal ``i`` has the number ``terminals + i``. No rule crosses the end of a document.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm import common as C
from tallyforge.session import ship

END_ID = 1
#: Ids after which a block is closed (a longer document is a block of its own).
BLOCK_IDS = 1 << 20
#: A rule is worth its place from this many uses: it takes 8 bytes (two symbols, a length), each use saves one symbol of two.
LEAST = 5
#: A round replaces all pairs at least 1 / RATIO as frequent as the most frequent one.
RATIO = 16
#: A special token of the vocabulary that stands between words which are encoded together.
SEPARATOR = "<|startoftext|>"
#: Words that a worker remembers with their ids, and pre-tokens that it remembers within a task.
CACHE_WORDS, CACHE_PIECES = 1 << 20, 1 << 19
#: Bytes of text encoded at a time: a word beyond the remembered ones is encoded once in each.
CHUNK_BYTES = 2 << 20
#: The most bytes of text that one shard should hold. There are at least as many shards as shuffle partitions.
SHARD_BYTES = 512 << 20

_BLOCK_SCHEMA = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("first_id", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("payload", T.BinaryType()),
    ]
)


#: Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others for 256 and up, in order.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE) if b != 0x0A}
#: Words of which normaliser and pre-tokenizer are known character by character: ASCII (without "<", which may begin a
#: special token) and lower-case Latin letters; and how the pre-tokenizer cuts them.
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u024f"
_PLAIN = re.compile(f"[!-;=-@\\[-`{{-~{_LETTERS}]+")
_PIECES = re.compile(f"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\n0-9{_LETTERS}]+")


class _Numbers:
    """Numbers of 64-bit word hashes, an open-addressing table in two arrays."""

    def __init__(self) -> None:
        self.n = 0
        self.keys, self.at = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where unknown."""
        out = np.full(len(hashes), -1, dtype=np.int32)
        todo, mask = np.arange(len(hashes)), np.uint64(len(self.keys) - 1)
        place = (hashes & mask).astype(np.int64)
        while len(todo):
            held = self.keys[place]
            same = held == hashes[todo]
            out[todo[same]] = self.at[place[same]]
            on = ~same & (held != 0)
            todo, place = todo[on], (place[on] + 1) & int(mask)
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number distinct unknown hashes in their order."""
        if 2 * (self.n + len(hashes)) > len(self.keys):
            old, at = self.keys, self.at
            size = 1 << int(2 * (self.n + len(hashes))).bit_length()
            self.keys, self.at = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            self._put(old[old != 0], at[old != 0])
        self._put(hashes, np.arange(self.n, self.n + len(hashes), dtype=np.int32))
        self.n += len(hashes)

    def _put(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        mask = len(self.keys) - 1
        place = (hashes & np.uint64(mask)).astype(np.int64)
        while len(hashes):
            free = self.keys[place] == 0
            self.keys[place[free]] = hashes[free]  # of several that meet in a place the last one stays
            self.at[place[free]] = numbers[free]
            on = self.keys[place] != hashes
            hashes, numbers, place = hashes[on], numbers[on], (place[on] + 1) & mask


class _Lists:
    """Numbered lists of ids in one array, with those of several numbers taken at once."""

    def __init__(self) -> None:
        self.flat, self.begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def append(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes, dtype=np.int64)])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids, one list after the other, and how many each has."""
        lo = self.begin[numbers]
        sizes = self.begin[numbers + 1] - lo
        lo, n = lo[sizes > 0], sizes[sizes > 0]
        return _runs(self.flat, lo, n), sizes


def _runs(pool: np.ndarray, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` that begin at ``lo`` and hold ``n`` > 0 entries, one after the other."""
    if not len(n):
        return pool[:0]
    step = np.ones(int(n.sum()), dtype=np.int64)
    step[0] = lo[0]
    step[np.cumsum(n[:-1])] = lo[1:] - (lo[:-1] + n[:-1] - 1)
    return pool[np.cumsum(step)]


class TextEncoder:
    """Ids of whole texts, by the tokenizer itself: for any vocabulary."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: one more than the largest id, the end id included
        self.terminals = max([END_ID, *self.tokenizer.get_vocab(with_added_tokens=True).values()]) + 1

    def rest(self) -> None:
        """Let go of what only one task needs: workers are used again by other operators."""

    def encode(self, data: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(offs[:-1], offs[1:], strict=True)]
        for got in self.tokenizer.encode_batch(texts, add_special_tokens=False):
            yield np.array(got.ids, dtype=np.uint32)


class WordEncoder(TextEncoder):
    """Ids of whole texts for lower-casing vocabularies that never join across white space (``fits``).

    Each distinct word is encoded once, A-Z lowered as the normaliser does, and remembered by its 64-bit hash. Plain
    words are cut in pre-tokens here, and each distinct one goes straight to the BPE model; other words go through the
    whole tokenizer. Equality with encoding whole texts is tested.
    """

    def __init__(self, path: str) -> None:
        super().__init__(path)
        from tokenizers import Tokenizer, pre_tokenizers

        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a pre-token
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words, self.ids = _Numbers(), _Lists()
        self.pieces: dict[str, int] = {}
        self.piece_ids = _Lists()

    def rest(self) -> None:
        self.pieces, self.piece_ids = {}, _Lists()

    @staticmethod
    def fits(spec: dict) -> bool:
        """Whether a tokenizer file has the normaliser, pre-tokenizer and model that this encoder stands for."""
        normal, pre, model = (spec.get(k) or {} for k in ("normalizer", "pre_tokenizer", "model"))
        kinds = [(x.get("type"), (x.get("pattern") or {}).get("Regex")) for x in [*normal.get("normalizers", []), *pre.get("pretokenizers", [])]]
        return (
            kinds == [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None), ("Split", r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), ("ByteLevel", None)]
            and (model.get("type"), model.get("end_of_word_suffix")) == ("BPE", "</w>")
            and any(t["content"] == SEPARATOR for t in spec.get("added_tokens", []))
            and all(t["content"].startswith("<") for t in spec["added_tokens"])
        )

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = _PIECES.findall("\n".join(words))
        new = list({p for p in found if p not in self.pieces and p != "\n"})
        for i in range(0, len(new), 1 << 14):
            some = new[i : i + (1 << 14)]
            chars = "\n".join(some).encode().decode("latin-1").translate(_BYTE_CHARS).split("\n")
            got = self.model.encode_batch([" ".join(chars[j : j + 256]) for j in range(0, len(some), 256)], add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in got])
            self.piece_ids.append(ids, np.diff(np.flatnonzero(self.closes[ids]), prepend=-1))
            self.pieces.update(zip(some, range(len(self.pieces), len(self.pieces) + len(some)), strict=True))
        number = np.fromiter((self.pieces.get(p, -1) for p in found), dtype=np.int64, count=len(found))
        piece = number >= 0
        ids, sizes = self.piece_ids.take(number[piece])
        word = np.cumsum(~piece)[piece]
        return ids, np.bincount(word, weights=sizes, minlength=len(words)).astype(np.int64)

    def _other(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.zeros(0, np.uint32)], []
        for i in range(0, len(words), 256):
            some = words[i : i + 256]
            if any("<" in w for w in some):  # may hold special tokens
                for e in self.tokenizer.encode_batch(some, add_special_tokens=False):
                    ids.append(np.array(e.ids, dtype=np.uint32))
                    sizes.append(len(e.ids))
                continue
            got = np.array([self.separator, *self.tokenizer.encode(SEPARATOR.join(some), add_special_tokens=False).ids], dtype=np.uint32)
            between = got == self.separator
            ids.append(got[~between])
            sizes += (np.diff(np.append(np.flatnonzero(between), len(got))) - 1).tolist()
        return np.concatenate(ids), np.array(sizes, dtype=np.int64)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        low = [w.decode() for w in words]
        lowered = "\n".join(low).lower().split("\n")
        plain = np.fromiter((_PLAIN.fullmatch(w) is not None for w in lowered), dtype=bool, count=len(lowered))
        order = np.argsort(~plain, kind="stable")
        n = int(plain.sum())
        for part, learn, texts in ((order[:n], self._plain, lowered), (order[n:], self._other, low)):
            if len(part):
                self.words.add(hashes[part])
                self.ids.append(*learn([texts[i] for i in part.tolist()]))

    def encode(self, data: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
        """One uint32 array per text. Beyond ``CACHE_WORDS`` all words are forgotten before the next call."""
        if self.words.n > CACHE_WORDS:
            self.words, self.ids = _Numbers(), _Lists()
        if len(self.pieces) > CACHE_PIECES:
            self.rest()
        hashes, starts, rows = C.words(data, offs)
        hashes = np.maximum(hashes, np.uint64(1))
        number = self.words.find(hashes)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            a = starts[missing[first]]
            gaps = np.append(np.flatnonzero(C.IS_SPACE[data]), len(data))
            b = np.minimum(gaps[np.searchsorted(gaps, a)], offs[np.searchsorted(offs, a, "right")])
            raw = data.tobytes()
            self._learn(new, [raw[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)])
            number[missing] = self.words.find(hashes[missing])
        ids, sizes = self.ids.take(number)
        ends = np.concatenate(([0], np.cumsum(sizes)))[rows]
        yield from (ids[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))


#: Encoders of this worker process, by path: a worker that is used again keeps its words.
_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    if path not in _ENCODERS:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _ENCODERS[path] = (WordEncoder if WordEncoder.fits(spec) else TextEncoder)(path)
    return _ENCODERS[path]


def _counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, and how often each occurs."""
    x = np.sort(x)
    begin = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)
    return x[begin], np.diff(np.append(begin, len(x)))


def compress(docs: list[np.ndarray], terminals: int, least: int = LEAST) -> bytes:
    """A block of the documents' ids (below ``terminals``) by Re-Pair: the most frequent neighbouring pairs become
    nonterminals, again and again, until no pair occurs ``least`` times or symbols of the width run out.

    A round replaces all pairs within ``RATIO`` of the most frequent one, left to right; of overlapping ones every second.
    After the first round only places next to a new symbol, and those whose pair is still frequent, are looked at: the
    count of any other pair can only fall.
    """
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    seq = np.concatenate([np.zeros(0, np.uint32), *docs]).astype(np.uint32)
    last = np.zeros(len(seq), dtype=bool)  # the last symbol of a document
    last[np.cumsum(lengths)[lengths > 0] - 1] = True
    first = np.cumsum(lengths) - lengths
    width = 2 if terminals <= 60_000 else 4
    room = (1 << 16 if width == 2 else 1 << 21) - terminals
    kind = np.uint32 if width == 2 else np.uint64
    side = kind(8 * width)
    odd, right = (kind(0x9E3779B1), kind(12)) if width == 2 else (kind(0x9E3779B97F4A7C15), kind(44))
    cell_of = lambda pair: (pair * odd >> right).astype(np.int32)
    rules: list[np.ndarray] = []
    total = 0
    at = np.flatnonzero(~last)
    while len(at) and total < room:
        pair = (seq[at].astype(kind) << side) | seq[at + 1]
        cell = cell_of(pair)
        hot = np.bincount(cell, minlength=1 << 20)[cell] >= least  # a cell counts at least what each of its pairs does
        at, pair, cell = at[hot], pair[hot], cell[hot]
        values, number = _counts(pair)
        best = np.flatnonzero(number >= max(least, int(number.max(initial=0)) // RATIO))
        if not len(best):
            break
        best = np.sort(best[np.argsort(-number[best], kind="stable")[: room - total]])
        chosen = values[best]
        by_cell = np.full(1 << 20, -1, dtype=np.int32)
        by_cell[cell_of(chosen)] = np.arange(len(chosen))  # of two in one cell the first waits for the next round
        rule = by_cell[cell]
        hit = (rule >= 0) & (chosen[rule] == pair)
        where, rule = all_of, of = at[hit], rule[hit]
        run = np.concatenate(([True], np.diff(where) != 1))
        begin = np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))
        take = (np.arange(len(where)) - begin) % 2 == 0
        where, rule = where[take], rule[take]
        used = np.bincount(rule, minlength=len(chosen)) >= least  # overlaps may leave a pair too few places: it is dropped
        take = used[rule]
        where, rule = where[take], (np.cumsum(used) - 1)[rule[take]]
        chosen = chosen[used]
        seq[where] = terminals + total + rule
        last[where] = last[where + 1]
        look = np.zeros(len(seq), dtype=bool)
        look[at] = True
        look[all_of[~used[of]]] = False
        look[where] = look[np.maximum(where - 1, 0)] = True
        keep = np.ones(len(seq), dtype=bool)
        keep[where + 1] = False
        gone = np.concatenate(([0], np.cumsum(~keep)))
        first -= gone[first]
        seq, last = seq[keep], last[keep]
        at = np.flatnonzero(look[keep] & ~last)
        rules.append(chosen)
        total += len(chosen)
    pairs = np.concatenate([np.zeros(0, kind), *rules])
    table = np.stack([pairs >> side, pairs & kind((1 << 8 * width) - 1)], axis=1).astype(f"<u{width}")
    size = [1] * terminals
    for a, b in table.tolist():
        size.append(size[a] + size[b])
    begin = np.cumsum(lengths) - lengths
    return b"".join(
        [
            struct.pack("<4s5I", b"RPB2", len(docs), terminals, total, len(seq), width),
            np.stack([first, begin], axis=1).astype("<u8").tobytes(),
            table.tobytes(),
            np.array(size[terminals:], dtype="<u4").tobytes(),
            seq.astype(f"<u{width}").tobytes(),
        ]
    )


class Block:
    """Random access to a block's documents."""

    def __init__(self, raw: bytes) -> None:
        magic, docs, self.terminals, rules, symbols, width = struct.unpack_from("<4s5I", raw)
        if magic != b"RPB2":
            raise ValueError("not a token block")
        at = 24
        self.index = np.frombuffer(raw, "<u8", 2 * docs, at).reshape(docs, 2).astype(np.int64)
        at += 16 * docs
        self.rules = np.frombuffer(raw, f"<u{width}", 2 * rules, at).reshape(rules, 2).astype(np.int64)
        at += 2 * width * rules
        self.size = np.frombuffer(raw, "<u4", rules, at).astype(np.int64)
        self.seq = np.frombuffer(raw, f"<u{width}", symbols, at + 4 * rules)

    def __len__(self) -> int:
        return len(self.index)

    def _expand(self, seq: np.ndarray) -> np.ndarray:
        """Terminal ids of symbols: each pass replaces every nonterminal by its two sides, as many passes as the rules are
        deep."""
        seq = seq.astype(np.int64)
        while len(at := np.flatnonzero(seq >= self.terminals)):
            sides = self.rules[seq[at] - self.terminals]
            out = np.empty(len(seq) + len(at), dtype=np.int64)
            shift = np.zeros(len(seq), dtype=np.int64)
            shift[at] = 1
            place = np.arange(len(seq)) + np.cumsum(shift) - shift
            out[place] = seq
            out[place[at]] = sides[:, 0]
            out[place[at] + 1] = sides[:, 1]
            seq = out
        return seq.astype(np.uint32)

    def decode(self, i: int) -> np.ndarray:
        """Ids of document ``i``."""
        end = self.index[i + 1, 0] if i + 1 < len(self) else len(self.seq)
        return self._expand(self.seq[self.index[i, 0] : end])

    def token(self, i: int, k: int) -> int:
        """Id ``k`` of document ``i``: the expansion lengths lead to it without decoding the rest."""
        end = self.index[i + 1, 0] if i + 1 < len(self) else len(self.seq)
        seq = self.seq[self.index[i, 0] : end].astype(np.int64)
        ends = np.cumsum(self._sizes(seq))
        if not 0 <= k < (ends[-1] if len(ends) else 0):
            raise IndexError(k)
        at = int(np.searchsorted(ends, k, "right"))
        symbol, k = int(seq[at]), k - int(ends[at - 1] if at else 0)
        while symbol >= self.terminals:
            left, right = self.rules[symbol - self.terminals].tolist()
            size = int(self._sizes(np.array([left]))[0])
            symbol, k = (left, k) if k < size else (right, k - size)
        return symbol

    def _sizes(self, seq: np.ndarray) -> np.ndarray:
        return np.concatenate([np.ones(1, np.int64), self.size])[np.maximum(seq - self.terminals + 1, 0)]

    def all_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the block, and the offsets of its documents (one more at the end)."""
        flat, begin = self._expansions()
        seq = self.seq.astype(np.int64)
        rule = seq >= self.terminals
        n = np.ones(len(seq), dtype=np.int64)
        n[rule] = self.size[seq[rule] - self.terminals]
        lo = seq.copy()
        lo[rule] = self.terminals + begin[seq[rule] - self.terminals]
        ids = _runs(np.concatenate([np.arange(self.terminals, dtype=np.uint32), flat]), lo, n)
        return ids, np.concatenate([self.index[:, 1], [len(ids)]])

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """Terminal ids of all nonterminals, one after the other, and where each begins."""
        return self._expand(np.arange(self.terminals, self.terminals + len(self.rules))), np.concatenate(([0], np.cumsum(self.size)))


def _write(path: str):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = encoder(path)
        shard = TaskContext.get().partitionId()
        block = done = held = 0
        ids: list[int | None] = []
        docs: list[np.ndarray] = []
        end = np.array([END_ID], dtype=np.uint32)

        def close() -> pa.RecordBatch:
            nonlocal block, done, held
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([done], pa.int64()), pa.array([held], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([compress(docs, texts.terminals)], pa.binary())],
                names=_BLOCK_SCHEMA.names,
            )
            block, done, held = block + 1, done + held, 0
            ids.clear()
            docs.clear()
            return out

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, _, data, offs in C.text_chunks(batch.column(1), CHUNK_BYTES):
                for i, got in enumerate(texts.encode(data, offs)):
                    if held and held + len(got) + 1 > BLOCK_IDS:
                        yield close()
                    ids.append(keys[first + i])
                    docs.append(np.concatenate([got, end]))
                    held += len(got) + 1
        if docs:
            yield close()
        texts.rest()

    return run


def write_shards(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all documents as token shards (Parquet rows of blocks) in the shared folder; returns them as read back.

    Order: ascending id, null ids first; rows that repeat an id follow by text, and are split over shards by its hash.
    Null and empty texts hold the end id alone. Other columns are ignored. An empty table writes no blocks. Any
    vocabulary file of the tokenizers library will do; lower-casing word vocabularies have a faster way.
    """
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return C.stage(ordered.mapInArrow(C.tidy(_write(tokenizer)), _BLOCK_SCHEMA), "token-shards")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, first, keys, raw in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            ids, offs = Block(raw).all_ids()
            data = ids.astype("<u4").tobytes()
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offs[:-1], offs[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(np.full(len(keys), shard, np.int32)), pa.array(first + offs[:-1], pa.int64()), pa.array(np.diff(offs), pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "shard", "at", "n_tokens", "ids_crc32"],
            )


def shard_index(shards: DataFrame) -> DataFrame:
    """Decode every block: one row per document ``doc_id, start, n_tokens, ids_crc32``. ``start`` counts all ids of all
    documents before it: the sum of the shards before and the place within the shard. That table has one row per shard,
    at most one per ``SHARD_BYTES`` of text or per shuffle partition."""
    totals = shards.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    from pyspark.sql import Window

    before = totals.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    docs = shards.select("shard", "first_id", "doc_ids", "payload").mapInArrow(C.tidy(_digest), "doc_id long, shard int, at long, n_tokens long, ids_crc32 long")
    return docs.join(F.broadcast(before), "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
