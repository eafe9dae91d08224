"""Suffix-array dedup, lexical search and whitening against brute force, on tables with awkward rows."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from tallyforge.llm import lexical_search, suffix_dedup, whitening

DOCS = "doc_id long, text string, lang string, blob binary, n long, spans string, part int, terms string, tf int"


def docs(spark, rows, parts=5):
    """Rows with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", b"x", 1, "y", 2, "z", 3) for i, t in rows], DOCS).repartition(parts)


# --- repeats ------------------------------------------------------------------------------------------------------


def brute_repeats(rows, least):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for j in range(len(b) - least + 1):
            w = b[j : j + least]
            if i is not None and (w not in first or first[w] > i):
                first[w] = i
    out = []
    for i, t in rows:
        b = (t or "").encode()
        off = bytearray(len(b))
        for j in range(len(b) - least + 1):
            if i is not None and first[b[j : j + least]] < i:
                off[j : j + least] = b"\1" * least
        kept = bytes(x for x, o in zip(b, off, strict=True) if not o)
        spans = sum(1 for j in range(len(b)) if off[j] and (j == 0 or not off[j - 1]))
        out.append((i, len(b), sum(off), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeating_rows(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passages = [words(rng.randint(8, 40)) for _ in range(10)]
    rows = [(None, "x" * 80), (None, None), (1, None), (2, ""), (3, "x " * 300), (4, "x " * 400), (5, "a" * 500), (6, "a" * 49), (7, "a" * 50), (8, "\0" * 120 + "a"), (9, "\0" * 70)]
    rows += [(5, passages[0] + " z " + passages[1]), (5, passages[0] + " z " + passages[1]), (-3, passages[2]), (2**40, passages[2] * 2)]
    for i in range(160):
        k = rng.random()
        text = words(rng.randint(1, 80))
        if k < 0.15 and i > 20:
            text = rng.choice(rows[13:])[1]
        elif k < 0.6:
            text = text + rng.choice(passages) + words(rng.randint(1, 20)) + rng.choice(passages)[: rng.randint(40, 70)] + words(3)
        rows.append((rng.randint(10, 400) if rng.random() < 0.1 else 1000 + i * 7 % 501, text))
    return rows


@pytest.mark.parametrize("least,hot,pool", [(50, 1 << 14, 8 << 20), (50, 2, 3000), (20, 1 << 14, 3000)])
def test_repeats_match_brute_force(spark, monkeypatch, least, hot, pool):
    monkeypatch.setattr(suffix_dedup, "POOL_BYTES", pool)
    rows = repeating_rows(least + hot)
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(docs(spark, rows), least, hot_runs=hot)).collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows, least)


def test_repeats_return_spans_and_bytes(spark):
    text = "the quick brown fox jumps over the lazy dog and then goes home"
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs(spark, [(1, text), (2, "é " + text + " now"), (3, "other")])).collect()}
    assert [(s.start, s.stop) for s in got[2].spans] == [(3, 3 + len(text))] and bytes(got[2].kept) == "é ".encode() + b" now"
    assert bytes(got[1].kept) == text.encode() and got[3].n_removed == 0
    assert suffix_dedup.remove_repeats(docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs(spark, []), 2)


def test_runs_cover_every_window_once():
    rng = np.random.default_rng(3)
    texts = [b"ab" * 200, b"a" * 300, bytes(rng.integers(97, 100, 700, dtype=np.uint8)), b"short", b"", bytes(rng.integers(0, 256, 400, dtype=np.uint8))]
    for least in (50, 12, 3):
        data, offs = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
        row, start, n, anchor, run = suffix_dedup.runs(data, offs, least)
        places = [(r, s - offs[r] + j) for r, s, k in zip(row.tolist(), start.tolist(), n.tolist(), strict=True) for j in range(k)]
        assert sorted(places) == [(r, j) for r, t in enumerate(texts) for j in range(len(t) - least + 1)]
        # equal windows have the same anchor, wherever they are
        key = {}
        raw = data.tobytes()
        for s, k, a in zip(start.tolist(), n.tolist(), anchor.tolist(), strict=True):
            for j in range(k):
                assert key.setdefault(raw[s + j : s + j + least], a) == a


def test_factors_match_brute_force():
    rng = np.random.default_rng(7)
    data = rng.integers(97, 99, 600, dtype=np.uint8)
    starts = np.arange(590)
    owner = rng.integers(0, 6, 590)
    got = suffix_dedup.factors(data, starts, owner, 8)
    raw = data.tobytes()
    for i in starts.tolist():
        best = max((next((k for k in range(8) if raw[i + k] != raw[j + k]), 8) for j in starts.tolist() if owner[j] < owner[i]), default=0)
        assert got[i] == (best if best >= 8 else 0)


# --- search -------------------------------------------------------------------------------------------------------


def brute_search(rows, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    cut = lambda t: term.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    held = [(i, cut(t)) for i, t in rows]
    held = [(i, w) for i, w in held if w]
    n, total = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    merged = {}
    for i, t in items:
        merged.setdefault(i, set()).update(cut(t))
    out = []
    for item, words in merged.items():
        scores = []
        for i, w in held:
            m = 50 + (50 * len(w) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * w.count(x)) // (1000 * w.count(x) + 20 * m)) for x in words if x in w)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def test_search_matches_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    words = lambda n: rng.choice([" ", "-", "\n_"]).join(rng.choice(vocabulary[: rng.choice([10, 150])]) for _ in range(n))
    rows = [(i, words(rng.randint(1, 60))) for i in range(300)] + [(None, words(20)), (None, None), (7, None), (8, ""), (9, " .,;"), (10, words(5000)), (11, "Ab aB"), (11, "Ab aB")]
    rows += [(400 + i, rows[i % 5][1]) for i in range(120)]  # ties
    items = [(i, words(rng.randint(1, 90))) for i in range(25)] + [(3, "more " + words(3)), (None, words(4)), (30, None), (31, ""), (32, "absent word"), (33, vocabulary[0])]
    bench = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, score long, rank int")
    monkeypatch.setattr(lexical_search, "GRID_DOCS", 64)
    for k, block in ((50, 1_000_000), (3, 300)):
        got = lexical_search.search(docs(spark, rows), bench, k, block_terms=block).collect()
        assert sorted(map(tuple, got), key=str) == brute_search(rows, items, k)
    assert lexical_search.search(docs(spark, []), bench).collect() == []
    assert lexical_search.search(docs(spark, rows), bench.limit(0)).collect() == []


def test_grid_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    cells = np.unique(rng.integers(0, 200 * 1000, 9000))
    rows, cols = cells // 1000, cells % 1000
    values = np.where(cols < 40, 1, 100) + rng.integers(0, 900, len(cells)) * (cols % 97 == 3)
    grid = lexical_search.Grid(rows, cols, values, 10)
    assert len(grid.bits) == grid.base[-1] and lexical_search._POPS[grid.bits].astype(int).sum() == len(grid.bits) - 1 + len(cells)
    dense = np.zeros((1024, 1024), np.int64)
    dense[rows, cols] = values
    some = np.array([[3, 50, 120, 199]])
    weights = np.array([[5, 7, 1, 2]])
    best = lexical_search.Best(1, 20)
    scored = lexical_search.search_grid(grid, lexical_search.Items(np.array([0]), some, weights), best, np.zeros(1024, bool), np.arange(1024))
    exact = (dense[some[0]] * weights.T).sum(axis=0)
    order = sorted((-s, d) for d, s in enumerate(exact.tolist()) if s > 0)[:20]
    assert [(-s, d) for s, d in zip(best.score.tolist(), best.doc.tolist(), strict=True)] == order
    assert scored < (exact > 0).sum()


# --- whitening ----------------------------------------------------------------------------------------------------

SPECTRA = {
    "spread": lambda q: (q * 10.0 ** np.linspace(5, -5, len(q))) @ q.T,
    "clustered": lambda q: (q * np.array([100.0] * 3 + [50.0] * 7 + list(range(30, 0, -1)))) @ q.T,
    "near": lambda q: (q * np.concatenate([100 + 1e-9 * np.arange(12), np.linspace(1, 10, len(q) - 12)])) @ q.T,
    "equal": lambda q: np.eye(len(q)) * 17.0,
    "zero": lambda q: np.zeros((len(q), len(q))),
    "rank 3": lambda q: (q[:, :3] * np.array([9.0, 5, 1])) @ q[:, :3].T,
    "one": lambda q: np.array([[4.0]]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_contour_integration_finds_the_largest(name):
    a = SPECTRA[name](np.linalg.qr(np.random.default_rng(4).standard_normal((40, 40)))[0])
    a = (a + a.T) / 2
    e, v = whitening.largest(a, 8)
    want = np.linalg.eigvalsh(a)[::-1][:8]
    scale = max(abs(want).max(), 1e-300)
    assert np.abs(e - want).max() <= 1e-13 * scale and np.abs(a @ v - v * e).max() <= 1e-13 * scale
    assert np.abs(v.T @ v - np.eye(len(e))).max() < 1e-12


def test_inertia_counts():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 30):
        for _ in range(20):
            m = rng.standard_normal((n, n))
            m, s = m + m.T, rng.standard_normal()
            assert whitening.inertia(m, s) == (np.linalg.eigvalsh(m) > s).sum()
    assert whitening.inertia(np.zeros((3, 3)), 0.0) == 0 and whitening.inertia(np.array([[0.0, 1], [1, 0]]), 0.0) == 1


EMB = "vec_id long, embedding array<float>, label int, deviation string, white int, n long, explained double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3, 0.5) for i, v in rows], EMB)


def test_whitening_matches_numpy(spark):
    rng = np.random.default_rng(9)
    good = [(i if i % 9 else None, [float(np.float32(x)) for x in rng.standard_normal(12) * np.linspace(1, 3, 12) + 5]) for i in range(300)]
    good += [(500, good[0][1]), (500, good[0][1])]
    bad = [(600, None), (601, [None] + [1.0] * 11), (602, [float("nan")] * 12), (603, [float("-inf")] + [0.0] * 11), (604, []), (605, [1.0] * 11), (606, [1e20] + [0.0] * 11)]
    got = whitening.digest(whitening.whiten(vectors(spark, good + bad).repartition(4))).collect()
    x = np.floor(1024 * np.array([v for _, v in good])).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    e, v = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    e, v = e[::-1][:8], v[:, ::-1][:, :8]
    white, deviation = (x - s / n) @ v / np.sqrt(e), ((n * x - s) ** 2).sum(axis=1)
    assert len(got) == 8 * n
    by = {}
    for r in got:
        by.setdefault((r.deviation, round(abs(r.whitened), 6), r.component), []).append(r)
    for k in range(n):
        for j in range(8):
            some = by[(int(deviation[k]), round(abs(white[k, j]), 6), j + 1)]
            assert any(abs(abs(r.whitened) - abs(white[k, j])) < 1e-9 and r.n == n and r.vec_id == good[k][0] for r in some)
    assert {r.component: round(r.explained, 9) for r in got} == {j + 1: round(float(e[j] / np.trace(np.cov(x.T.astype(float), bias=True))), 9) for j in range(8)}
    assert got[0].identity_error < 1e-9


def test_whitening_of_little(spark):
    same = vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert whitening.whiten(same).collect() == [] and whitening.digest(whitening.whiten(vectors(spark, []))).collect() == []
    flat = vectors(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [5.0, 2.0])])
    got = whitening.digest(whitening.whiten(flat)).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 6)) for r in got) == [(1, 1, 1.224745), (2, 1, 0.0), (3, 1, 1.224745)]
    huge = spark.createDataFrame([(1, [4e9, 0.0]), (2, [-4e9, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.deviation for r in whitening.whiten(huge).collect()}[1] is None
