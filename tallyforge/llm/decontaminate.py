"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A window of words is embedded by random walks (Chakraborty, Goldenberg, Koucky 2016): step ``j`` writes the word under
the pointer and moves the pointer by a random bit of (walk, j, word). Small edit distance becomes small Hamming
distance of the outputs. Each hash samples a few output positions; windows and items that agree in any of the hashes
are candidates, and a candidate is kept only after an exact edit-distance check of the item against the text around.

Windows begin at every word and are item-sized: items are put in length classes and each class walks over as many
words as its shortest item has. A window can only match if it holds enough words of the class's items, in any order (a
window within ``d`` edits of an item has all but ``d`` of its words); that count comes from one running sum, is exact
(it loses nothing), and spares the walk for nearly all windows of ordinary text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import common as C
from tallyforge.session import ship

#: An item matches where at most this share of its words is inserted, deleted or replaced.
MAX_EDITS = 0.2
#: Walks, hashes sampled from each walk, and positions in a hash. Recall at MAX_EDITS is measured in the tests.
WALKS, HASHES, SAMPLED = 8, 12, 3
#: Words of benchmark items that one pass over the documents takes; a larger benchmark takes several passes.
BLOCK_WORDS = 2_000_000
#: A length class spans items of n to CLASS_RATIO * n words.
CLASS_RATIO = 1.3
#: Words of text windows that one step of the exact check compares.
STEP_WORDS = 1 << 18


class _Class:
    """Items of similar length with the hash tables of their walks."""

    def __init__(self, members: list[int], items: list[np.ndarray], edits: list[int], seed: int) -> None:
        self.members = np.array(members)
        self.span = min(len(items[i]) for i in members)
        self.longest = max(len(items[i]) for i in members)
        # the fewest of a window's first `span` words that are words of an item, if that item is within its edits
        self.least = max(1, self.span - max(edits[i] for i in members))
        self.vocabulary = np.unique(np.concatenate([items[i] for i in members]))
        self.steps = max(1, int(1.8 * self.span))
        rng = np.random.default_rng(seed + self.span)
        self.samples = [[np.sort(rng.choice(self.steps, min(SAMPLED, self.steps), replace=False)) for _ in range(HASHES)] for _ in range(WALKS)]
        self.tables = []
        flat = np.concatenate([items[i] for i in members])
        at = np.concatenate(([0], np.cumsum([len(items[i]) for i in members])))
        for w in range(WALKS):
            keys = self.hashes(flat, at[:-1], at[1:], w)
            self.tables.append([(k[o], o) for k in keys for o in [np.argsort(k, kind="stable")]])

    def hashes(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray, walk: int) -> list[np.ndarray]:
        """The sampled hashes of one walk, for windows of `words` that begin at `begin`; past `end` stands 0."""
        pos = begin.copy()
        wanted = {int(j) for s in self.samples[walk] for j in s}
        out: dict[int, np.ndarray] = {}
        for j in range(max(wanted) + 1):
            inside = pos < end
            word = np.where(inside, words[np.minimum(pos, len(words) - 1)], np.uint64(0))
            if j in wanted:
                out[j] = word
            salt = np.uint64((walk * 1_000_003 + j) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            pos = pos + (((word ^ salt) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(63)).astype(np.int64)
        keys = []
        for sample in self.samples[walk]:
            key = np.zeros(len(begin), dtype=np.uint64)
            for j in sample:
                key = C.mix(key + out[int(j)] + np.uint64(0x632BE59BD9B4E019))
            keys.append(key)
        return keys


class Matcher:
    """Benchmark items ready for search; built on the driver and sent to executors."""

    def __init__(self, ids: list[int], items: list[np.ndarray], max_edits: float = MAX_EDITS) -> None:
        self.ids, self.items = ids, items
        self.edits = [int(max_edits * len(w)) for w in items]
        by_length = sorted(range(len(items)), key=lambda i: len(items[i]))
        self.classes: list[_Class] = []
        group: list[int] = []
        for i in by_length:
            if group and (len(items[i]) > CLASS_RATIO * len(items[group[0]])):
                self.classes.append(_Class(group, items, self.edits, 17))
                group = []
            group.append(i)
        if group:
            self.classes.append(_Class(group, items, self.edits, 17))
        #: per value of the low 16 hash bits, a bit for each class (of the first 62) that has such a word
        self.quick = np.zeros(1 << 16, dtype=np.uint64)
        for k, c in enumerate(self.classes):
            self.quick[(c.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] |= np.uint64(1 << min(k, 62))

    def search(self, words: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, item index, edit distance) for each row and item that match, by the smallest distance."""
        if not len(words):
            return
        flags = self.quick[(words & np.uint64(0xFFFF)).astype(np.int64)]
        row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        row_end = rows[1:][row_of]
        pairs: list[np.ndarray] = []
        for k, c in enumerate(self.classes):
            hit = (flags >> np.uint64(min(k, 62))) & np.uint64(1)
            total = np.concatenate(([0], np.cumsum(hit.astype(np.int32))))
            stop = np.minimum(np.arange(len(words)) + c.span, row_end)
            begin = np.flatnonzero(total[stop] - total[:-1] >= c.least)
            if not len(begin):
                continue
            # exact: the low bits may name words that no item has
            near = np.unique((begin[:, None] + np.arange(c.span)[None, :]).ravel()) if len(begin) * c.span < 4_000_000 else np.arange(len(words))
            near = near[near < len(words)]
            exact = np.zeros(len(words), dtype=np.int32)
            at = np.minimum(np.searchsorted(c.vocabulary, words[near]), len(c.vocabulary) - 1)
            exact[near] = c.vocabulary[at] == words[near]
            total = np.concatenate(([0], np.cumsum(exact)))
            begin = begin[total[stop[begin]] - total[begin] >= c.least]
            if not len(begin):
                continue
            end = row_end[begin]
            for w in range(WALKS):
                for key, (table, order) in zip(c.hashes(words, begin, end, w), c.tables[w], strict=True):
                    lo, hi = np.searchsorted(table, key, "left"), np.searchsorted(table, key, "right")
                    count = hi - lo
                    if count.any():
                        which = np.repeat(np.arange(len(begin)), count)
                        take = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                        pairs.append(np.stack([c.members[order[take]], begin[which]], axis=1))
        if not pairs:
            return
        found = np.unique(np.concatenate(pairs), axis=0)
        best: dict[tuple[int, int], int] = {}
        for item in np.unique(found[:, 0]):
            at = found[found[:, 0] == item, 1]
            d = self._distances(words, at, row_of, rows, int(item))
            for row, dist in zip(row_of[at].tolist(), d.tolist(), strict=True):
                if dist <= self.edits[item] and dist < best.get((row, int(item)), 1 << 30):
                    best[row, int(item)] = dist
        for (row, item), dist in sorted(best.items()):
            yield row, item, dist

    def _distances(self, words: np.ndarray, at: np.ndarray, row_of: np.ndarray, rows: np.ndarray, item: int) -> np.ndarray:
        """Exact smallest word edit distance of the item to any stretch of the text around each place."""
        pattern, slack = self.items[item], self.edits[item] + 1
        n = len(pattern)
        out = np.empty(len(at), dtype=np.int64)
        many = max(1, STEP_WORDS // (n + 2 * slack))
        for a in range(0, len(at), many):
            some = at[a : a + many]
            lo = np.maximum(some - slack, rows[row_of[some]])
            hi = rows[row_of[some] + 1]
            place = lo[:, None] + np.arange(n + 2 * slack)[None, :]
            window = np.where(place < hi[:, None], words[np.minimum(place, len(words) - 1)], np.uint64(0))
            column = np.repeat(np.arange(n + 1, dtype=np.int32)[None, :], len(some), axis=0)
            least = column[:, n].copy()
            steps = np.arange(n + 1, dtype=np.int32)
            for t in range(window.shape[1]):
                new = np.empty_like(column)
                new[:, 0] = 0
                new[:, 1:] = np.minimum(column[:, :-1] + (window[:, t : t + 1] != pattern[None, :]), column[:, 1:] + 1)
                column = np.minimum.accumulate(new - steps, axis=1) + steps  # insertions along the column
                least = np.minimum(least, column[:, n])
            out[a : a + many] = least
        return out


def item_blocks(benchmark: DataFrame, max_edits: float = MAX_EDITS, block_words: int = BLOCK_WORDS, id_col: str = "item_id", text_col: str = "text") -> Iterator[Matcher]:
    """The items in blocks of bounded size, one block at a time on the driver. Items without words are left out."""
    ids, items, held = [], [], 0
    for r in benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("t is not null").distinct().toLocalIterator():
        for _, _, data, offs in C.text_chunks(pa.array([r.t])):
            words, _, _ = C.words(data, offs)
        if len(words):
            if held and held + len(words) > block_words:
                yield Matcher(ids, items, max_edits)
                ids, items, held = [], [], 0
            ids.append(r.i)
            items.append(words)
            held += len(words)
    if items:
        yield Matcher(ids, items, max_edits)


def _search(shared):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = shared.value
        for batch in batches:
            found = []
            for first, _, data, offs in C.text_chunks(batch.column(1)):
                words, _, rows = C.words(data, offs)
                found += [(first + row, matcher.ids[item], dist, len(matcher.items[item])) for row, item, dist in matcher.search(words, rows)]
            if found:
                row, item, dist, n = (list(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(item, pa.int64()), pa.array(dist, pa.int32()), pa.array(n, pa.int32())], ["doc_id", "item_id", "edits", "item_words"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents that hold a benchmark item: ``doc_id, item_id, edits, item_words``, one row per pair, with the smallest
    number of words inserted, deleted or replaced (at most ``int(max_edits * item_words)``).

    Words are split at ASCII white space and A-Z is lowered. Null, empty and wordless texts and items match nothing; items
    of fewer than ``1 / max_edits`` words match exactly only. Repeated document rows give their pairs once; a null id is
    returned as null. Other columns are ignored; empty tables give no rows. The documents are read in place, without a
    shuffle; only found pairs move. Items come in blocks of ``block_words`` words: each is searched for in a pass of its
    own and then released, so neither driver nor workers ever hold more than one.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, edits int, item_words int"
    found = None
    for matcher in item_blocks(benchmark, max_edits, block_words):
        shared = spark.sparkContext.broadcast(matcher)
        part = C.stage(rows.mapInArrow(C.tidy(_search(shared)), schema), "hits")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], schema)
    return found.groupBy("doc_id", "item_id", "item_words").agg(F.min("edits").alias("edits")).select("doc_id", "item_id", "edits", "item_words")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how: object) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; rows without id are kept."""
    bad = contamination(docs, benchmark, **how).where("doc_id is not null").select(F.col("doc_id").alias("_held")).distinct()
    key = docs[how.get("id_col", "doc_id")].cast("long")
    return docs.join(bad, key == bad["_held"], "left_anti")
