"""Ranked lexical search with a K2-treap over the term-document grid.

The grid has a row for each term of the items, a column for each document and an impact in each cell: what one unit of a
term's weight adds to the document's score. A compressed quadtree holds it: one nibble for each inner cell says which of
its quadrants are not empty, the place of a child follows from the nibbles before it, and each cell keeps the greatest
impact below it (rounded up to sixteenths of the scale in inner cells, exact in leaves).

An item is a set of rows. For a range of documents, the weights times the maxima of the cells on the rows' paths bound the
score of every document in it. All paths descend together, the ranges with the highest bounds first; a range whose bound
lies under the item's ``k``-th best score so far is never opened, and a range of one document has its exact score.

On Spark: one pass over the texts writes the postings of the items' terms; document frequencies and lengths are summed
from them; then each task builds the grids of its documents, searches them for all items and hands on ``k`` rows an item.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm import common as C
from tallyforge.session import ship

#: Results for each item; terms of items that one pass looks for; documents of one grid.
TOP, BLOCK_TERMS, GRID_DOCS = 50, 1_000_000, 1 << 13
#: Ranges of an item opened in the first step (doubled in each step up to the last number), and bytes of open paths.
FIRST_STEP, LAST_STEP, OPEN_BYTES = 16, 1024, 64 << 20

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: The same classes as bytes of UTF-8: digits, ASCII letters and every byte of a longer character.
_IN_TERM = np.array([chr(b).isalnum() and b < 128 or b >= 128 for b in range(256)])
_POPS = np.array([bin(i).count("1") for i in range(16)], dtype=np.uint8)


def terms(text: str | None) -> set[str]:
    """Distinct terms of a text; only A-Z are lowered."""
    return set(_TERM.findall((text or "").translate(_LOWER)))


def hashes(words: list[str]) -> np.ndarray:
    """The hashes that ``common.words`` gives these terms."""
    if not words:
        return np.zeros(0, np.uint64)
    raw = " ".join(words).encode()
    return C.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), _IN_TERM)[0]


# --- postings ---------------------------------------------------------------------------------------------------


def _postings(shared):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        quick = np.zeros(1 << 16, dtype=bool)
        quick[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
        for batch in batches:
            for first, end, data, offs in C.text_chunks(batch.column(1)):
                found, _, rows = C.words(data, offs, _IN_TERM)
                near = np.flatnonzero(quick[(found & np.uint64(0xFFFF)).astype(np.int64)])
                at = np.minimum(np.searchsorted(known, found[near]), len(known) - 1)
                hit = known[at] == found[near]
                row = np.searchsorted(rows[1:], near[hit], "right")
                key, tf = np.unique(row * len(known) + at[hit], return_counts=True)
                row = key // len(known)
                bounds = np.searchsorted(row, np.arange(end - first + 1)).astype(np.int32)
                lists = lambda x, bounds=bounds: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(np.diff(rows), pa.int64()), lists(key % len(known)), lists(tf)], ["doc_id", "n", "terms", "tf"])

    return run


# --- the grid ---------------------------------------------------------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Grid:
    """A K2-treap of ``2**height`` rows and columns. Cells of one depth lie in Morton order, so the children of a cell are
    neighbours: the first is at ``first``, the others follow by the set bits of ``bits``."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray, height: int) -> None:
        key = (_spread(rows) << np.uint64(1)) | _spread(cols)
        by = np.argsort(key, kind="stable")
        key, top = key[by], impacts[by].astype(np.int64)
        self.height, self.leaves = height, top.astype(np.int32)
        bits, first, tops = [], [], []
        for _ in range(height):
            begin = np.flatnonzero(np.append(True, key[1:] >> np.uint64(2) != key[:-1] >> np.uint64(2))) if len(key) else np.zeros(0, np.int64)
            bits.append(np.bitwise_or.reduceat((1 << (key & np.uint64(3)).astype(np.int64)).astype(np.uint8), begin) if len(key) else np.zeros(0, np.uint8))
            first.append(begin.astype(np.uint32))
            top = np.maximum.reduceat(top, begin) if len(key) else top
            tops.append(-(-top // 16))
            key = key[begin] >> np.uint64(2)
        self.base = np.concatenate(([0], np.cumsum([len(b) for b in bits[::-1]]))).astype(np.int64)
        self.bits, self.first, self.tops = np.concatenate(bits[::-1]), np.concatenate(first[::-1]), np.concatenate(tops[::-1]).astype(np.uint16)

    def children(self, depth: np.ndarray, cells: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For ranges at their depth, with the cells (-1: empty) of each row's path: those of the left and the right half,
        and the bound of each half, or the score where it is one document."""
        there = cells >= 0
        place = np.where(there, cells, 0) + self.base[depth][:, None]
        bits = np.where(there, self.bits[place], 0)
        first = self.first[place].astype(np.int64)
        low = ((rows >> (self.height - 1 - depth)[:, None]) & 1) * 2
        leaf = depth + 1 == self.height
        for half in (0, 1):
            has = (bits >> (low + half)) & 1 == 1
            child = np.where(has, first + _POPS[bits & ((1 << (low + half)) - 1)], -1)
            value = np.zeros(child.shape, dtype=np.int64)
            inner = has & ~leaf[:, None]
            value[inner] = self.tops[(child + self.base[np.minimum(depth + 1, self.height - 1)][:, None])[inner]].astype(np.int64) * 16
            last = has & leaf[:, None]
            value[last] = self.leaves[child[last]]
            yield child, (value * weights).sum(axis=1)


@dataclass
class Items:
    """Items of about one length: rows and weights of their terms, padded with weight 0, and where each stands."""

    number: np.ndarray
    rows: np.ndarray
    weights: np.ndarray


class Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.item, self.score, self.none, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
        self.least = np.ones(items, dtype=np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, none: np.ndarray, doc: np.ndarray) -> None:
        item, score, none, doc = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.none, none), (self.doc, doc)))
        by = np.lexsort((doc, none, -score, item))
        place = np.arange(len(by)) - np.searchsorted(item[by], item[by])
        self.least[item[by][place == self.k - 1]] = score[by][place == self.k - 1]
        by = by[place < self.k]
        self.item, self.score, self.none, self.doc = item[by], score[by], none[by], doc[by]


def search_grid(grid: Grid, items: Items, best: Best, none: np.ndarray, doc: np.ndarray) -> int:
    """Search the grid's documents for the items, best ranges first; how many documents were scored."""
    n = len(items.number)
    item, depth, col = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    cells = np.where(items.weights > 0, 0, -1).astype(np.int32)
    bound = np.full(n, np.iinfo(np.int64).max)
    step, scored = FIRST_STEP, 0
    while len(item):
        by = np.lexsort((-bound, item))
        place = np.arange(len(by)) - np.searchsorted(item[by], item[by])
        take, rest = by[place < step], by[place >= step]
        step = min(2 * step, LAST_STEP)
        kept = [(item[rest], depth[rest], col[rest], bound[rest], cells[rest])]
        leaf = depth[take] + 1 == grid.height
        for half, (child, value) in enumerate(grid.children(depth[take], cells[take], items.rows[item[take]], items.weights[item[take]])):
            at = col[take] * 2 + half
            good = value >= best.least[items.number[item[take]]]
            done = good & leaf
            if done.any():
                scored += int(done.sum())
                best.add(items.number[item[take]][done], value[done], none[at[done]], doc[at[done]])
            go = good & ~leaf
            kept.append((item[take][go], depth[take][go] + 1, at[go], value[go], child[go].astype(np.int32)))
        item, depth, col, bound, cells = (np.concatenate(x) for x in zip(*kept, strict=True))
        still = bound >= best.least[items.number[item]]
        item, depth, col, bound, cells = item[still], depth[still], col[still], bound[still], cells[still]
    return scored


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """What one unit of a term's weight adds to the score of a document of ``n`` terms that holds it ``tf`` times."""
    m = 50 + (50 * n * docs) // total
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _search(shared, k: int):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, groups, row_of, docs, total = shared.value
        best = Best(len(names), k)
        wait: list[pa.RecordBatch] = []

        def grid() -> None:
            batch = pa.Table.from_batches(wait).combine_chunks()
            wait.clear()
            ids = batch.column("doc_id").combine_chunks()
            none, doc = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
            term, offs = C.list_parts(batch.column("terms").combine_chunks())
            tf, _ = C.list_parts(batch.column("tf").combine_chunks())
            term, tf = term[offs[0] : offs[-1]], tf[offs[0] : offs[-1]].astype(np.int64)
            col = np.repeat(np.arange(len(doc)), np.diff(offs))
            n = batch.column("n").combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
            height = max(1, int(max(len(row_of), len(doc)) - 1).bit_length())
            made = Grid(row_of[term], col, impacts(tf, n[col], docs, total), height)
            for items in groups:
                many = max(1, OPEN_BYTES // (4 * items.rows.shape[1] * len(doc)))
                for a in range(0, len(items.number), many):
                    search_grid(made, Items(items.number[a : a + many], items.rows[a : a + many], items.weights[a : a + many]), best, none, doc)

        held = 0
        for batch in batches:
            for a in range(0, batch.num_rows, GRID_DOCS):
                some = batch.slice(a, GRID_DOCS)
                if held and held + some.num_rows > GRID_DOCS:
                    grid()
                    held = 0
                wait.append(some)
                held += some.num_rows
        if held:
            grid()
        if len(best.item):
            doc = pa.array(best.doc, pa.int64(), mask=best.none)
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in best.item.tolist()], pa.int64()), doc, pa.array(best.score, pa.int64())], ["item_id", "doc_id", "score"])

    return run


def item_blocks(items: DataFrame, block_terms: int, id_col: str, text_col: str) -> Iterator[tuple[list, list[set[str]]]]:
    """Ids and terms of the items in blocks of bounded size, one at a time on the driver."""
    ids, held, size = [], [], 0
    for r in items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).orderBy("i").toLocalIterator():
        new = terms(r.t)
        if ids and ids[-1] == r.i:
            size += len(new - held[-1])
            held[-1] |= new
            continue
        if ids and size + len(new) > block_terms:
            yield ids, held
            ids, held, size = [], [], 0
        ids.append(r.i)
        held.append(new)
        size += len(new)
    if any(held):
        yield ids, held


def _groups(held: list[set[str]], place: dict[str, int], row_of: np.ndarray, weight: np.ndarray) -> list[Items]:
    """Items padded to the next power of two of their number of terms that weigh anything."""
    by: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, words in enumerate(held):
        at = np.array(sorted(place[w] for w in words), dtype=np.int64)
        at = at[weight[at] > 0] if len(at) else at
        if len(at):
            by.setdefault(max(8, 1 << (len(at) - 1).bit_length()), []).append((i, at))
    out = []
    for wide, some in sorted(by.items()):
        rows, weights = np.zeros((len(some), wide), np.int64), np.zeros((len(some), wide), np.int64)
        for j, (_, at) in enumerate(some):
            rows[j, : len(at)], weights[j, : len(at)] = row_of[at], weight[at]
        out.append(Items(np.array([i for i, _ in some]), rows, weights))
    return out


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` documents that score highest for each item: ``item_id, rank, doc_id, score``.

    Terms are runs of digits, ASCII letters (A-Z lowered) and characters beyond ASCII. With N documents that have terms, L
    terms in all, a term's document frequency df and a document's number of terms n: weight ``floor(1000 ln((2N+2) /
    (2df+1)))``, length ``m = 50 + 50nN div L``, score the sum of weight times ``(10**9 tf) div (1000 tf + 20m)`` over the
    item's terms, once each. Documents that score 0 are not returned; equal scores rank by ascending id.

    A null text has no terms. Each document row counts for itself, also when ids repeat; a null id ranks behind all others
    of its score. Rows with one item id (null is one, too) are one item with all their terms; an item without terms has
    no result. Other columns are ignored; empty tables give no rows. Terms are compared by 64-bit hashes.

    Texts are read once for each block of ``block_terms`` item terms, of which the driver and the workers hold one at a
    time; only postings of item terms are written and moved.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = None
    for ids, held in item_blocks(items, block_terms, item_id, item_text):
        words = sorted(set().union(*held))
        keys, at = np.unique(hashes(words), return_inverse=True)
        place = dict(zip(words, at.tolist(), strict=True))
        known = spark.sparkContext.broadcast(keys)
        postings = C.stage(texts.mapInArrow(C.tidy(_postings(known)), "doc_id long, n long, terms array<int>, tf array<int>").where("n > 0"), "postings")
        known.destroy()
        total = postings.agg(F.count("*").alias("docs"), F.sum("n").alias("total")).first()
        if not total.docs:
            continue
        df = np.zeros(len(keys), dtype=np.int64)
        for r in postings.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # at most a row for each item term
            df[r.term] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * total.docs + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)
        row_of = np.empty(len(keys), dtype=np.int64)
        row_of[np.lexsort((np.arange(len(keys)), df))] = np.arange(len(keys))  # terms of like frequency share cells
        shared = spark.sparkContext.broadcast((ids, _groups(held, place, row_of, weight), row_of, total.docs, total.total))
        part = C.stage(postings.where(F.size("terms") > 0).repartition(parts).mapInArrow(C.tidy(_search(shared, k)), "item_id long, doc_id long, score long"), "ranked")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
