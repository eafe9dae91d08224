"""Small files in whatever store Spark reads: written once, read back, listed."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class ExistsError(RuntimeError):
    """Another writer has created the file first."""


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; in local mode without one, a new folder that is then set."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def _at(spark: SparkSession, path: str):  # noqa: ANN202
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    p, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file: its bytes in one string."""
    p, fs = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Make a file with this text appear at once, whole, and only if there is none; else ``ExistsError``. It is written under
    another name beside it and renamed, and the rename refuses a target that exists, so of two writers one succeeds and a
    crash leaves no part of it."""
    jvm = spark._jvm
    target, fs = _at(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(target), how)
    except Exception as e:
        fs.delete(beside, False)
        if "FileAlreadyExistsException" in str(e) or fs.exists(target):
            raise ExistsError(path) from e
        raise


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Rows as Parquet files of the shared folder, for plans that read them more than once."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
