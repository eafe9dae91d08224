"""Quality classifier: Bradley-Terry pairwise ranking on text features, cut at a score quantile.

From labelled documents preference pairs (good, bad) are drawn; logistic loss on the feature difference gives each
document a score ``w . x`` whose differences are log-odds of being preferred. The cut is a quantile of the training
scores; scores are then shown on a 0 to 1 scale on which the cut lies at ``CUT``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import common as C
from tallyforge.session import ship

#: Labelled rows used for training at most (the smallest by hash of their id), and preference pairs drawn from them.
TRAIN_ROWS, TRAIN_PAIRS = 8000, 20_000
#: Where the cut lies on the scale of returned scores.
CUT = 0.3
L2 = 1e-4

_KINDS = {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "stop": ".,;:",
    "loud": "!?",
    "symbol": "#$%&*+/<=>@[\\]^_`{|}~",
    "bar": "|",
    "line": "\n",
}
#: Frequent short words of English, German, French and Spanish.
_COMMON = (
    "the of and to in is that it was for on are as with be at by this from or an "
    "der die und den das ist im nicht von mit sich auf ein zu für dem des eine "
    "le la les et des en un une est que pour dans qui par sur au avec "
    "el los las del se y una con para su es lo como al esta"
).split()
FEATURES = ["words", "word_length", *_KINDS, "other", "repeated_words", "repeated_lines", "common", "marked_words", "upper_words", "none"]


def _masks() -> list[np.ndarray]:
    out = []
    for chars in _KINDS.values():
        m = np.zeros(256, dtype=np.int64)
        m[[ord(c) for c in chars]] = 1
        out.append(m)
    high = np.zeros(256, dtype=np.int64)
    high[0xC0:] = 1  # lead bytes: characters beyond ASCII
    return [*out, high]


_MASKS = _masks()
_SYMBOL = _MASKS[4] + _MASKS[3]


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _common_hashes() -> np.ndarray:
    text = " ".join(_COMMON)
    return np.unique(C.words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0])


_COMMON_HASHES = _common_hashes()


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of features for each text of a chunk. Only the text counts."""
    hashes, starts, rows = C.words(data, offs)
    size = np.maximum(1, np.diff(offs)).astype(float)
    n = np.diff(rows)
    many = np.maximum(1, n).astype(float)
    space = _per_row(C.IS_SPACE[data].astype(np.int64), offs)
    cols = [np.log1p(n), np.minimum(30, (np.diff(offs) - space) / many)]
    cols += [_per_row(m[data], offs) / size for m in _MASKS]
    again = np.array([(b - a) - len(np.unique(hashes[a:b])) for a, b in zip(rows[:-1], rows[1:], strict=True)])
    cols.append(again / many)
    # lines: a hash of each by its words, summed in order
    ends = np.flatnonzero(data == 10)
    bounds = np.unique(np.concatenate([offs[:-1], ends + 1, [len(data)]]))
    bounds = bounds[bounds < len(data)] if len(data) else bounds[:0]
    line = np.zeros(len(n))
    if len(bounds):
        word_at = np.searchsorted(starts, bounds)
        stop = np.append(word_at[1:], len(hashes))
        place = np.arange(len(hashes)) - np.repeat(word_at, stop - word_at)  # of a word in its line
        chain = np.concatenate((np.zeros(1, np.uint64), np.cumsum(C.mix(hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)))
        key = chain[stop] - chain[word_at]
        owner = np.searchsorted(offs, bounds, "right") - 1
        full = stop > word_at
        for r, a, b in _runs(owner[full]):
            line[r] = 1 - len(np.unique(key[full][a:b])) / (b - a)
    cols.append(line)
    common = np.searchsorted(_COMMON_HASHES, hashes)
    common[common == len(_COMMON_HASHES)] = 0
    cols.append(_per_row((_COMMON_HASHES[common] == hashes).astype(np.int64), rows) / many)
    if len(starts):
        marked = np.add.reduceat(_SYMBOL[data], starts) > 0
        upper = np.add.reduceat(_MASKS[0][data], starts) > 1
    else:
        marked = upper = np.zeros(0, bool)
    cols += [_per_row(marked.astype(np.int64), rows) / many, _per_row(upper.astype(np.int64), rows) / many, (n == 0).astype(float)]
    return np.stack(cols, axis=1)


def _runs(owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cut = np.flatnonzero(np.diff(owner)) + 1
    for a, b in zip(np.concatenate(([0], cut)), np.append(cut, len(owner)), strict=True):
        if b > a:
            yield int(owner[a]), int(a), int(b)


@dataclass
class Ranking:
    """Weights on standardised features (and their squares), the cut and the scale."""

    mean: np.ndarray
    std: np.ndarray
    weights: np.ndarray
    cut: float

    def _wide(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -6, 6)
        return np.concatenate([z, z * z], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._wide(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.raw(x) - self.cut, -30, 30) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = TRAIN_PAIRS, seed: int = 3) -> Ranking:
    """Bradley-Terry weights from feature rows and 0/1 labels, by gradient descent with momentum on drawn pairs. The cut
    is the score quantile, among all quantiles of the training scores, that splits the labels best (the mean of both
    classes' hit rates); it lies midway between two neighbouring scores. With one class only nothing is cut away."""
    mean, std = (x.mean(axis=0), x.std(axis=0) + 1e-9) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    model = Ranking(mean, std, np.zeros(2 * len(FEATURES)), -1.0)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return model
    rng = np.random.default_rng(seed)
    wide = model._wide(x)
    diff = wide[rng.choice(good, pairs)] - wide[rng.choice(bad, pairs)]
    w, step, rate = model.weights, np.zeros_like(model.weights), 0.3
    for _ in range(300):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))  # the chance given to the wrong order
        grad = -(diff * p[:, None]).mean(axis=0) + L2 * w
        step = 0.9 * step - rate * grad
        w = w + step
    model.weights = w
    raw = model.raw(x)
    order = np.argsort(raw, kind="stable")
    hits = np.cumsum(y[order] == 0) / len(bad) + 1 - np.cumsum(y[order] == 1) / len(good)
    best = np.flatnonzero(hits >= hits.max() - 1e-12)
    k = int(best[len(best) // 2])
    model.cut = float((raw[order[k]] + raw[order[min(k + 1, len(order) - 1)]]) / 2)
    return model


def _collect_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offs in C.text_chunks(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), C.list_column(list(features(data, offs)), pa.float64())], ["id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Ranking:
    """Learn from labelled documents whose crc32(id as text) mod 5 is not 0: at most ``rows`` of them, the first by a hash
    of the id, so the sample is the same on every run. A null label is left out; several labels of one id count as
    their mean, rounded (a half is good); of several texts of one id the one with the least features counts."""
    ship(docs.sparkSession)
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.crc32(F.col(id_col).cast("string")) % 5 != 0))
        .groupBy(F.col(id_col).cast("long").alias("_id"))
        .agg((F.avg(F.col(label_col).cast("double")) >= 0.5).cast("int").alias("y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    text = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("t"))
    each = text.join(F.broadcast(known), "_id").select("_id", "t", "y").mapInArrow(C.tidy(_collect_features), "id long, y int, x array<double>")
    got = each.groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x")).collect()  # at most `rows` rows
    x = np.array([r.x for r in got]).reshape(len(got), len(FEATURES))
    y = np.array([r.y for r in got], dtype=int)
    order = np.lexsort((y, *x.T[::-1])) if len(y) else np.zeros(0, int)
    return fit(x[order], y[order])


def _score(model):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offs in C.text_chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.round(model.score(features(data, offs)), 9))], ["doc_id", "score"])

    return run


def scores(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``. Null and empty texts are scored as texts without
    words; equal texts score equally; a null id is scored and not held out. Other columns are ignored."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(C.tidy(_score(model)), "doc_id long, score double").select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def _keep(model, at: int):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.score(features(data, offs)).round(9) >= CUT for _, _, data, offs in C.text_chunks(batch.column(at).cast(pa.string()))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return run


def keep_good(docs: DataFrame, model: Ranking, text_col: str = "text") -> DataFrame:
    """The documents that score at or above the cut, with all their columns."""
    ship(docs.sparkSession)
    return docs.mapInArrow(C.tidy(_keep(model, docs.columns.index(text_col))), docs.schema)
