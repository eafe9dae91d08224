"""Shared helpers of the training-data operators.

``shared_dir`` finds the folder all executors share, ``stage`` cuts a plan by writing it there, and the
NumPy helpers turn Arrow string columns into word and shingle hashes without a Python object per word.
"""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one NumPy step handles; a longer document is a step of its own.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; in local mode without one, a new folder that is then set."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lost executor then costs no recomputation
    of what came before, and later plans start from files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that hands freed memory back to the system when its task ends: Spark keeps the worker for
    tasks of other operators, and what the allocators hold back would count against the executor all that time."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's own call; elsewhere there is none
        if trim is not None:
            trim(0)

    return task


# --- hashing ---------------------------------------------------------------------------------------------------

_U = np.uint64
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), elementwise."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_table() -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
    t[ord("A") : ord("Z") + 1] = t[ord("a") : ord("z") + 1]  # ASCII letters count in either case
    t[_SPACES] = 0
    return t


_SPACES = [0x20, *range(0x09, 0x0E)]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[_SPACES] = True
_BYTES = _byte_table()
_P = 0xD6E8FEB86659FD93
_P_INV = pow(_P, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + (64 << 10))
        made = []
        for p in (_P, _P_INV):
            out = np.ones(size, dtype=_U)
            done = 1
            while done < size:  # doubling: p^(i+done) = p^i * p^done
                take = min(done, size - done)
                out[done : done + take] = out[:take] * _U(pow(p, done, 1 << 64))
                done += take
            made.append(out)
        if size > CHUNK_BYTES + (64 << 10):
            return made[0], made[1]
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def text_chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a string column in runs of rows: (first row, end row, bytes, offsets from 0) of
    about ``size`` bytes. A null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
        end = min(end, n)
        yield at, end, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def words(data: np.ndarray, offs: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``, or runs of the bytes marked by ``inside``, A-Z lowered: 64-bit hashes, byte starts, and
    per row the index of its first word (one more entry at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    word = ~IS_SPACE[data] if inside is None else inside[data]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    first = offs[:-1][offs[:-1] < n]
    begin[first] = word[first]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.zeros(0, _U), starts, np.zeros(len(offs), np.int64)
    power, inverse = _powers(n)
    values = _BYTES if inside is None else np.where(inside, _BYTES, _U(0))
    summed = np.add.reduceat(values[data] * power[:n], starts)
    return mix(summed * inverse[starts]), starts, np.searchsorted(starts, offs)


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int = 5) -> Iterator[np.ndarray]:
    """Per row the hashes of its k-word shingles in order (repeats kept); with fewer words the whole sequence as one;
    no words, none."""
    n = len(hashes)
    if n >= k:
        acc = np.zeros(n - k + 1, dtype=_U)
        for i in range(k):
            acc = (acc + hashes[i : n - k + 1 + i]) * _U(0x9FB21C651E98DF25)
            acc ^= acc >> _U(29)
        acc = mix(acc)
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        if b - a >= k:
            yield acc[a : b - k + 1]
        elif b > a:
            one = int(b - a)
            for w in hashes[a:b]:
                one = ((one + int(w)) * 0x9FB21C651E98DF25) & _MASK
                one ^= one >> 29
            yield mix(np.array([one], dtype=_U))
        else:
            yield np.zeros(0, _U)


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column of the arrays."""
    offs = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offs[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat, kind))


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without nulls."""
    n = len(column)
    offs = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int32)
    return column.values.to_numpy(zero_copy_only=False), offs

