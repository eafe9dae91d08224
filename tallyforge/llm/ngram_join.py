"""Exact n-gram Jaccard join with a token-group matrix.

Similar documents are put in groups; each group keeps the union of its tokens (word shingles); a query document counts
its tokens in that union, which bounds its overlap with every member; only groups whose bound reaches the threshold
are opened and their members compared exactly.

How this stays exact and linear-ish on Spark:

* Documents with equal shingle sets are one class; the rest works on one row per class.
* A first round pairs each class with the first class of its min-hash group. Linked ones form the groups
  ("similar documents"), so that a large family of near copies is one group and not all its pairs.
* The matrix rows are (token, group) for prefix tokens only: with ``n`` tokens, the ``n - ceil(0.8 n) + 1`` rarest. Two
  sets with Jaccard >= 0.8 always share one, under any order; the order is by a fixed-size count sketch over all
  documents, so passages that many documents share come last and open nothing. A pair is asked for only if its number
  of shared prefix tokens lets its sizes reach the threshold at all.
* A class is compared only with groups of *another* component found so far, split in blocks of ``BLOCK`` members. Classes
  that are alone so far are grouped by their min-hash, so stragglers of a family are few groups too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import common as C
from tallyforge.llm.graph import components
from tallyforge.session import ship

#: A link has 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Cells of the count sketch that orders tokens; fixed, so its size does not follow the data.
CELLS = 1 << 18
#: Bits of the filter that picks the documents whose sets are compared, as a power of two (8 MB).
BITS = 26
#: Members of one opened group block, and queries of one salted chunk.
BLOCK, CHUNK = 256, 2048


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells = np.zeros(CELLS, dtype=np.int64)
    for batch in batches:
        for _, _, data, offs in C.text_chunks(batch.column(0)):
            hashes, _, rows = C.words(data, offs)
            all_of = np.concatenate([np.zeros(0, np.uint64), *C.shingles(hashes, rows)])
            cells += np.bincount((all_of & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
    at = np.flatnonzero(cells)
    for i in range(0, len(at), 65536):
        yield pa.RecordBatch.from_arrays([pa.array(at[i : i + 65536], pa.int32()), pa.array(cells[at[i : i + 65536]], pa.int64())], ["cell", "n"])


def token_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Ranks (uint16) of the sketch cells by how often their tokens occur in all documents. It comes to the driver as
    at most ``CELLS`` rows, whatever the input."""
    cells = np.zeros(CELLS, dtype=np.int64)
    for r in docs.select(text).mapInArrow(C.tidy(_sketch), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():
        cells[r.cell] = r.n
    return np.minimum(np.round(np.log2(cells + 1.0) * 1500), 65535).astype(np.uint16)


def _sets(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
    for first, _, data, offs in C.text_chunks(batch.column(column)):
        hashes, _, rows = C.words(data, offs)
        for i, s in enumerate(C.shingles(hashes, rows)):
            yield first + i, C.distinct(s)


def _signatures(ranks, percent: int):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = ranks.value
        for batch in batches:
            n, a, b, low, heads = [], [], [], [], []
            for _, s in _sets(batch, 1):
                n.append(len(s))
                a.append(np.bitwise_xor.reduce(C.mix(s)) if len(s) else 0)
                b.append(np.add.reduce(C.mix(s ^ np.uint64(0x5851F42D4C957F2D))) if len(s) else 0)
                low.append(s[0] if len(s) else 0)
                order = np.argsort(rank[(s & np.uint64(CELLS - 1)).astype(np.int64)], kind="stable")
                heads.append(s[order[: _prefix(len(s), percent)]].view(np.int64) if len(s) else np.zeros(0, np.int64))
            long = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), long(a), long(b), long(low), C.list_column(heads, pa.int64())], ["doc_id", "n", "sig1", "sig2", "low", "prefix"])

    return run


def _least_shared(nq: Column, lo: Column, hi: Column, percent: int) -> Column:
    """The fewest prefix tokens that a set of ``nq`` shares with one of ``lo`` to ``hi`` that reaches the threshold: shared
    tokens lie in both prefixes or behind the prefix of one of the two, and their number must reach the overlap that
    the threshold asks of these sizes. Up to ``nq`` that grows with the size. Above it the two ceilings make it waver, so
    at the upper end of a range it is taken below them: no size up to there needs less. For one size it is exact."""

    def at(ns: Column) -> Column:
        overlap = F.ceil(percent * (nq + ns) / (100 + percent) - 1e-9)
        return overlap - F.greatest(F.ceil(percent * nq / 100 - 1e-9), F.ceil(percent * ns / 100 - 1e-9)) + 1

    low = F.greatest(lo, F.ceil(percent * nq / 100 - 1e-9))
    high = F.least(hi, F.floor(100 * nq / percent + 1e-9))
    below = F.floor(percent * (100 * nq - percent * high) / (100 * (100 + percent)) + 1e-9) + 1
    return F.greatest(F.lit(1), F.when((high > nq) & (low < high), F.least(at(low), below)).otherwise(at(low)))


def _place(ids: np.ndarray) -> np.ndarray:
    return (C.mix(ids.view(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)


def _words_of_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = _place(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(at >> 6, pa.int64()), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64), pa.int64())], ["word", "bits"])


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bit for each hashed id, ``2**BITS`` bits whatever the input: a filter that may pass too much, never too little."""
    out = np.zeros(1 << (BITS - 6), dtype=np.int64)
    for r in ids.mapInArrow(C.tidy(_words_of_bits), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        out[r.word] = r.bits
    return out.view(np.uint64)


def _needed_sets(bitmap):  # noqa: ANN001, ANN202
    """Token sets of the documents whose bit is set; others that share a bit come along and are not asked for later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            at = _place(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            batch = batch.filter(pa.array((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1))
            if batch.num_rows:
                sets = [s.view(np.int64) for _, s in _sets(batch, 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), C.list_column(sets, pa.int64())], ["cls", "tokens"])

    return run


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(ids))
    return C.stage(docs.where("doc_id is not null").mapInArrow(C.tidy(_needed_sets(bitmap)), "cls long, tokens array<long>"), "sets")


def _open(percent: int):  # noqa: ANN202
    """Rows sorted by (group, chunk, is_query): the members of a block, then its queries, one after the other."""

    class Block:
        def __init__(self, mixed: bool = False) -> None:
            self.mixed = mixed  # else all members are linked already
            self.ids: list[int] = []
            self.sets: list[np.ndarray] = []
            self.ready = False

        def close(self) -> None:
            self.sizes = np.array([len(s) for s in self.sets])
            flat = np.concatenate(self.sets)
            owner = np.repeat(np.arange(len(self.sets)), self.sizes)
            order = np.argsort(flat, kind="stable")
            self.flat, self.owner = flat[order], owner[order]
            self.union = C.distinct(self.flat)  # the group's token union
            self.place = {c: i for i, c in enumerate(self.ids)}
            self.root = list(range(len(self.ids))) if self.mixed else [0] * len(self.ids)
            self.ready = True

        def find(self, i: int) -> int:
            while self.root[i] != i:
                self.root[i] = self.root[self.root[i]]
                i = self.root[i]
            return i

        def links(self, cls: int, q: np.ndarray) -> list[int]:
            """Members that reach the threshold with the query: one of each set of members not yet known to be linked."""
            if not self.sets:
                return []
            if not self.ready:
                self.close()
            n, at = len(q), np.searchsorted(self.union, q)
            at[at == len(self.union)] = 0
            shared = q[self.union[at] == q]
            if 100 * len(shared) < percent * n:  # the bound: no member can reach the threshold
                return []
            lo, hi = np.searchsorted(self.flat, shared, "left"), np.searchsorted(self.flat, shared, "right")
            count = hi - lo
            take = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
            both = np.bincount(self.owner[take], minlength=len(self.sets))
            out, own = [], self.place.get(cls)
            known = None if own is None else self.find(own)
            for i in np.flatnonzero(100 * both >= percent * (n + self.sizes - both)).tolist():
                root = self.find(i)
                if root != known:
                    out.append(self.ids[i])
                    if known is not None:
                        self.root[root] = known
                    known = root if known is None else known
            return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, Block()
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(5)]
            values, offs = C.list_parts(batch.column(5))
            found = []
            for i, (comp, blk, chunk, query, cls) in enumerate(zip(*cols, strict=True)):
                if (comp, blk, chunk) != key:
                    key, block = (comp, blk, chunk), Block(blk < 0)
                tokens = values[offs[i] : offs[i + 1]]
                if not query:
                    block.ids.append(cls)
                    block.sets.append(tokens.copy())
                else:
                    found += [(cls, to) for to in block.links(cls, tokens)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["q", "s"])

    return run


def _verify(queries: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """queries (comp, blk, q) and members (comp, blk, cls) to links (q, s) that join all whose sets reach the threshold. A
    block with many queries is dealt to several chunks."""
    sizes = queries.groupBy("comp", "blk").agg(F.count("*").alias("nq"))
    chunks = F.ceil(F.col("nq") / CHUNK).cast("int")
    asked = queries.join(sizes, ["comp", "blk"]).select(
        "comp", "blk", F.pmod(F.xxhash64("q"), chunks).cast("int").alias("chunk"), F.lit(1).alias("query"), F.col("q").alias("cls")
    )
    held = members.join(sizes, ["comp", "blk"]).select(
        "comp", "blk", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.lit(0).alias("query"), "cls"
    )
    rows = asked.unionByName(held).join(sets, "cls").select("comp", "blk", "chunk", "query", "cls", "tokens")
    return (
        rows.repartition("comp", "blk", "chunk")
        .sortWithinPartitions("comp", "blk", "chunk", "query")
        .mapInArrow(C.tidy(_open(percent)), "q long, s long")
    )


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Two rows link when their sets of distinct 5-word shingles (A-Z lowered, words split at ASCII white space; with
    fewer than five words the whole sequence as one) have ``100 * intersection >= percent * union``;
    ``component_id`` is the smallest id reachable. Null, empty and wordless texts have size 0 and link with nothing.
    Rows that repeat an id count as one document: each returns its own size and the component of the id. A row
    without id returns null as component and links with nothing. Other columns, whatever their names, are ignored; an
    empty table gives no rows. Shingles are held as 64-bit hashes; class signatures are 128 bits and the size.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranks = spark.sparkContext.broadcast(token_ranks(docs))
    signed = C.stage(docs.mapInArrow(C.tidy(_signatures(ranks, percent)), "doc_id long, n long, sig1 long, sig2 long, low long, prefix array<long>"), "signed")

    live = signed.where("n > 0 and doc_id is not null")
    classes = live.groupBy("sig1", "sig2", "n").agg(F.min("doc_id").alias("cls"))
    placed = C.stage(live.select("doc_id", "sig1", "sig2", "n", "low").join(classes, ["sig1", "sig2", "n"]).select("doc_id", "cls", "n", "low"), "classes")
    same = placed.where("doc_id <> cls").select("doc_id", "cls")  # exact copies; also ties an id's several texts together
    reps = placed.where("doc_id = cls").select("cls", "n", "low")

    # the first round: each class against the first of its min-hash group
    heads = reps.groupBy("low").agg(F.min_by("cls", "cls").alias("head"), F.min_by("n", "cls").alias("head_n"), F.max("cls").alias("last")).where("head < last")
    star = C.stage(
        reps.join(heads, "low")
        .where((F.col("cls") != F.col("head")) & (100 * F.least("n", "head_n") >= percent * F.greatest("n", "head_n")))
        .select("cls", "head")
        .distinct(),
        "heads",
    )

    # the matrix: prefix tokens of more than one document, then of more than one class
    several = F.min("doc_id") < F.max("doc_id")
    tokens = live.select(F.explode("prefix").alias("token"), "doc_id").repartition("token")
    shared = tokens.join(tokens.groupBy("token").agg(several.alias("several")).where("several").select("token"), "token", "left_semi")
    matrix = C.stage(shared.join(placed.select("doc_id", "cls", "n"), "doc_id").select("token", "cls", "n").distinct(), "matrix")
    kept = matrix.groupBy("token").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a < b").select("token")
    matrix = C.stage(matrix.join(kept, "token", "left_semi"), "matrix")

    # heads that share enough prefix tokens with a member to be able to reach the threshold
    mine = star.join(matrix.select("cls", "token", F.col("n").alias("nq")), "cls")
    theirs = matrix.select(F.col("cls").alias("head"), "token", F.col("n").alias("ns"))
    star = C.stage(
        mine.join(theirs, ["head", "token"])
        .groupBy("cls", "head", "nq", "ns")
        .agg(F.count("*").alias("c"))
        .where(F.col("c") >= _least_shared(F.col("nq"), F.col("ns"), F.col("ns"), percent))
        .select("cls", "head")
        .distinct(),
        "heads",
    )
    sets = _sets_of(docs, star.select("cls").union(star.select("head")))
    starred = _verify(
        star.select(F.col("head").alias("comp"), F.lit(0).alias("blk"), F.col("cls").alias("q")),
        star.select(F.col("head").alias("comp"), F.lit(0).alias("blk"), F.col("head").alias("cls")).distinct(),
        sets,
        percent,
    )
    first = C.stage(starred.select(F.col("q").alias("u"), F.col("s").alias("v")).unionByName(same.select(F.col("doc_id").alias("u"), F.col("cls").alias("v"))), "first")
    comps = C.stage(components(first), "components")

    # groups: blocks of a component; classes that are still alone are grouped by their min-hash, in blocks below 0
    where = (
        matrix.select("cls")
        .distinct()
        .join(reps.select("cls", "low").dropDuplicates(["cls"]), "cls")
        .join(comps.withColumnRenamed("node", "cls"), "cls", "left")
        .select("cls", F.coalesce("component", "low").alias("comp"), F.col("component").isNull().alias("mixed"))
    )
    sizes = where.groupBy("comp", "mixed").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / BLOCK)).cast("int")
    group = C.stage(where.join(sizes, ["comp", "mixed"]).select("cls", "comp", F.when(F.col("mixed"), -1 - part).otherwise(part).alias("blk")), "groups")
    cells = C.stage(matrix.join(group, "cls"), "cells")
    right = cells.groupBy("token", "comp", "blk").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    left = cells.select("token", F.col("cls").alias("q"), F.col("n").alias("nq"), F.col("comp").alias("own"), F.col("blk").alias("at"))
    # each pair of groups is asked from one side; a mixed group also asks itself, a component does not
    mine, theirs = F.col("at") < 0, F.col("blk") < 0
    family = (F.col("own") == F.col("comp")) & (mine == theirs)
    turn = F.when(family, theirs & (F.col("at") >= F.col("blk"))).otherwise((mine < theirs) | ((mine == theirs) & (F.col("own") < F.col("comp"))))
    asked = C.stage(
        left.join(right, "token")
        .where(turn & (100 * F.col("hi") >= percent * F.col("nq")) & (100 * F.col("nq") >= percent * F.col("lo")))
        .groupBy("comp", "blk", "q", "nq")
        .agg(F.count("*").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .where(F.col("c") >= _least_shared(F.col("nq"), F.col("lo"), F.col("hi"), percent))
        .select("comp", "blk", "q")
        .distinct(),
        "asked",
    )
    members = C.stage(group.join(asked.select("comp", "blk").distinct(), ["comp", "blk"], "left_semi").select("comp", "blk", "cls"), "members")
    sets = _sets_of(docs, asked.select("q").union(members.select("cls")))
    second = _verify(asked, members, sets, percent)
    final = components(first.unionByName(second.select(F.col("q").alias("u"), F.col("s").alias("v"))))
    return (
        signed.select("doc_id", F.col("n").alias("n_shingles"))
        .join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )
