"""Snapshot tables, the write-once seal and set fingerprints."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import sha256
from tallyforge.operators import fingerprints, seal
from tallyforge.operators import selection as S
from tallyforge.sources import files
from tallyforge.sources.snapshots import SnapshotTable


def into(old, new):
    return S.upsert(old, new, ["k"])


def rows(table, version=None):
    return {tuple(r) for r in table.read(version).collect()}


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "d" / "a.json")
    files.create_once(spark, path, "é1")
    with pytest.raises(files.ExistsError):
        files.create_once(spark, path, "2")
    assert files.read_text(spark, path) == "é1" and files.names(spark, str(tmp_path / "d")) == ["a.json"]


def test_batch_rewrites_only_its_buckets(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.merge(spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("v")), ["k"], into, "w", 0)
    batch = spark.createDataFrame([(3, "b"), (900, "n")], "k long, v string")
    assert [table.merge(batch, ["k"], into, "w", i) for i in (1, 1)] == [1, 1]  # handed over again: nothing
    before, after = table.snapshot(0).folders, table.snapshot(1).folders
    assert len({b for b in after if before.get(b) != after[b]}) <= 2
    assert rows(table) == {(i, "b" if i == 3 else "a") for i in range(200)} | {(900, "n")}
    assert rows(table, 0) == {(i, "a") for i in range(200)}
    table.replace(table.read().where("k < 5"), ["k"])
    assert len(rows(table)) == 5 and table.snapshot().batches == {"w": 1}
    table.vacuum(1)
    assert table.versions() == [2] and len(rows(table)) == 5


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.merge(spark.createDataFrame([(1, "a")], "k long, v string"), ["k"], into, "w", 0)
    new = spark.createDataFrame([(1, "b"), (2, "b")], "k long, v string")

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(files, "create_once", die)
        with pytest.raises(KeyboardInterrupt):
            table.merge(new, ["k"], into, "w", 1)
    assert rows(table) == {(1, "a")} and not table.done("w", 1)
    assert len(table.vacuum(2)) == 1  # what the dead writer left
    table.merge(new, ["k"], into, "w", 1)
    assert rows(table) == {(1, "b"), (2, "b")}


def test_of_two_writers_one_wins(spark, tmp_path, monkeypatch):
    table, other = (SnapshotTable(spark, str(tmp_path / "t")) for _ in range(2))
    table.merge(spark.createDataFrame([(1, "a")], "k long, v string"), ["k"], into)
    late = other.snapshot()
    table.merge(spark.createDataFrame([(1, "b")], "k long, v string"), ["k"], into)
    with monkeypatch.context() as m:
        m.setattr(other, "snapshot", lambda version=None: late)  # it has read the version before
        with pytest.raises(files.ExistsError):
            other.merge(spark.createDataFrame([(1, "c")], "k long, v string"), ["k"], into)
    assert rows(table) == {(1, "b")}


def test_empty_batches_and_tables(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    none = spark.createDataFrame([], "k long, v string")
    table.merge(none, ["k"], into, "w", 0)
    assert rows(table) == set() and table.done("w", 0)
    table.merge(spark.createDataFrame([(None, "x")], "k long, v string"), ["k"], DataFrame_union, "w", 1)
    assert rows(table) == {(None, "x")}


def DataFrame_union(old, new):
    return old.unionByName(new)


def people(spark, n):
    return spark.range(n).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("id"))


def test_the_first_seal_stands(spark, tmp_path):
    folder, marker = str(tmp_path / "s"), tmp_path / "04-build-report.json"
    first = {r.fingerprint for r in seal.seal_once(people(spark, 100), folder, "id", "1", curation=str(marker)).collect()}
    assert len(first) == 20
    marker.write_text("{}")
    for again in (seal.seal_once(people(spark, 100), folder, "id", "2", curation=str(marker)), seal.seal_once(people(spark, 3), folder, "id", "1", 0.5)):
        assert {r.fingerprint for r in again.collect()} == first
    m = seal.read_manifest(spark, folder)
    assert (m["population_size"], m["heldout_count"], m["seed"]) == (100, 20, "1")
    want = sorted(hashlib.sha256(f"p{i}".encode()).hexdigest()[:16] for i in range(100))
    assert m["population_fingerprint"] == hashlib.sha256("\n".join(want).encode()).hexdigest()[:16]


def test_seals_that_are_refused(spark, tmp_path):
    marker = tmp_path / "report.json"
    marker.write_text("{}")
    with pytest.raises(seal.SealError, match="curation"):
        seal.seal_once(people(spark, 50), str(tmp_path / "a"), "id", "1", curation=str(marker))
    assert seal.seal_once(people(spark, 50), str(tmp_path / "a"), "id", "1", curation=str(marker), force=True).count() == 10
    for n in (0, 4):
        with pytest.raises(seal.SealError):
            seal.seal_once(people(spark, n), str(tmp_path / f"b{n}"), "id", "1")
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "manifest.json").write_text("{broken")
    with pytest.raises(seal.SealError, match="read"):
        seal.seal_once(people(spark, 50), str(tmp_path / "c"), "id", "1")
    with pytest.raises(seal.SealError, match="no seal"):
        seal.sealed_rows(spark, str(tmp_path / "d"))


def test_a_seal_that_lost_the_race_returns_the_winner(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "s")
    real = files.create_once

    def second(spark, path, text):
        monkeypatch.setattr(files, "create_once", real)
        seal.seal_once(people(spark, 60), folder, "id", "other")
        real(spark, path, text)

    monkeypatch.setattr(files, "create_once", second)
    got = {r.fingerprint for r in seal.seal_once(people(spark, 100), folder, "id", "mine").collect()}
    assert len(got) == 12 and seal.read_manifest(spark, folder)["seed"] == "other"


def trie(values, leaf, digits=None, prefix=""):
    """The fingerprint as it is defined, without Spark."""
    if digits is None:
        digits = 0
        while len(values) > leaf * 16**digits:
            digits += 1
    if len(prefix) == digits:
        return hashlib.sha256("\n".join(sorted(values)).encode()).hexdigest()
    lines = []
    for d in "0123456789abcdef":
        some = [v for v in values if hashlib.sha256(v.encode()).hexdigest().startswith(prefix + d)]
        if some:
            lines.append(f"{d}:{trie(some, leaf, digits, prefix + d)}")
    return hashlib.sha256("\n".join(sorted(lines)).encode()).hexdigest()


@pytest.mark.parametrize("leaf", [4096, 30, 2])
def test_fingerprints_of_large_sets_are_built_in_parts(spark, leaf):
    sets = {"a": [f"v{i}" for i in range(300)], "b": ["x"], None: [f"n{i}" for i in range(40)]}
    df = spark.createDataFrame([(k, v) for k, vs in sets.items() for v in [*vs, *vs[:3]]] + [("b", None)], "g string, v string").repartition(7)
    got = {r.g: (r.fingerprint, r.members) for r in fingerprints.set_fingerprint(df, "v", ["g"], leaf).collect()}
    assert got == {k: (trie(vs, leaf), len(vs)) for k, vs in sets.items()}
    one = fingerprints.set_fingerprint(df.where("g = 'a'").orderBy("v"), "v", leaf=leaf).first()
    assert tuple(one) == (trie(sets["a"], leaf), 300)
    assert tuple(fingerprints.set_fingerprint(df.limit(0), "v").first()) == (hashlib.sha256(b"").hexdigest(), 0)


@pytest.mark.parametrize("run", [1 << 18, 700])
def test_a_sorted_digest_is_one_hash_of_any_number_of_values(spark, run):
    values = [hashlib.sha256(str(i).encode()).hexdigest()[:16] for i in range(5000)] + ["", "\u00e9\u4e2d"]
    df = spark.createDataFrame([(v,) for v in [*values, *values[:9], None]], "v string").repartition(5)
    want = hashlib.sha256("\n".join(sorted(values)).encode()).hexdigest()
    assert tuple(fingerprints.sorted_digest(df, "v", run).first()) == (want, 5002)
    assert tuple(fingerprints.sorted_digest(df.limit(0), "v", run).first()) == (hashlib.sha256(b"").hexdigest(), 0)


@pytest.mark.parametrize("blocks", [sha256._blocks, sha256._blocks_here])
def test_an_interrupted_hash_is_that_of_all_bytes(blocks):
    for size, step in ((0, 1), (55, 20), (56, 56), (64, 64), (1000, 37), (40_003, 9_001)):
        data, state = bytes(i * i % 251 for i in range(size)), sha256.START
        for i in range(0, size, step):
            state = sha256.absorb(state, data[i : i + step], blocks)
        assert sha256.digest(state) == hashlib.sha256(data).hexdigest()


def test_a_population_of_over_4096_members_has_its_flat_fingerprint(spark):
    from tallyforge.operators import joins as J

    values = [hashlib.sha256(str(i).encode()).hexdigest()[:16] for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "fingerprint string")
    got = J.population_drift(df, df).first()
    assert (got.population, got.population_fingerprint) == (5000, hashlib.sha256("\n".join(sorted(values)).encode()).hexdigest()[:16])


def test_the_manifest_of_over_4096_members_has_their_flat_fingerprint(spark, tmp_path):
    seal.seal_once(spark.range(5000), str(tmp_path / "s"), "id", "7")
    prints = sorted(hashlib.sha256(str(i).encode()).hexdigest()[:16] for i in range(5000))
    assert seal.read_manifest(spark, str(tmp_path / "s"))["population_fingerprint"] == hashlib.sha256("\n".join(prints).encode()).hexdigest()[:16]
