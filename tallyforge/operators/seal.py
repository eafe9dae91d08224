"""The write-once seal of a held-out set.

A seal is a folder: the sealed fingerprints as a table, and a manifest that is created atomically and never changed. Who
seals again gets the first seal back, whatever the population, seed or fraction. Once curation has begun there is nothing
left to hold out from, so a first seal is refused then; a manifest that can't be read stops everything, as taking it for absent would let
the next seal replace it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import text as T
from tallyforge.operators import fingerprints
from tallyforge.operators import selection as S
from tallyforge.sources import files


class SealError(ValueError):
    """A seal that is refused or can't be trusted."""


def read_manifest(spark: SparkSession, folder: str) -> dict | None:
    """The manifest of a sealed folder, None if there is none."""
    path = f"{folder.rstrip('/')}/manifest.json"
    if not files.exists(spark, path):
        return None
    try:
        manifest = json.loads(files.read_text(spark, path))
        manifest["rows"]
    except (ValueError, KeyError, TypeError) as e:
        raise SealError(f"the manifest at {path} can't be read") from e
    return manifest


def sealed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprints of a sealed folder."""
    manifest = read_manifest(spark, folder)
    if manifest is None:
        raise SealError(f"no seal at {folder}")
    return spark.read.schema("fingerprint string").parquet(f"{folder.rstrip('/')}/{manifest['rows']}")


def seal_once(population: DataFrame, folder: str, key: str, seed: str, fraction: float = 0.2, least: int = 5, curation: str | None = None, force: bool = False) -> DataFrame:
    """``fingerprint`` of the held-out keys, sealed at the first call and read back at every later one.

    ``curation`` names a file whose existence means that curation has begun; a first seal is refused then unless ``force``.
    A population of fewer than ``least`` distinct keys is refused. Ids are not stored, only hashes. Of two calls at once one
    writes the manifest and both return its rows."""
    spark, folder = population.sparkSession, folder.rstrip("/")
    if read_manifest(spark, folder) is not None:
        return sealed_rows(spark, folder)
    if curation is not None and not force and files.exists(spark, curation):
        raise SealError(f"curation has begun ({curation}): a set drawn now is not held out from anything")
    ids = population.select(F.col(key).cast("string").alias("id")).where("id is not null").distinct()
    try:
        rows = S.seal_heldout(ids, "id", seed, fraction, least).select("fingerprint")
    except ValueError as e:
        raise SealError(str(e)) from e
    name = f"rows-{uuid.uuid4().hex}"
    rows.write.parquet(f"{folder}/{name}")
    of = fingerprints.sorted_digest(ids.select(T.fp16(F.col("id")).alias("f")), "f").first()
    manifest = {
        "sealed": True,
        "hash_algo": "sha256/16",
        "seed": seed,
        "fraction": fraction,
        "population_size": of.members,
        "heldout_count": spark.read.parquet(f"{folder}/{name}").count(),
        "population_fingerprint": of.fingerprint[:16],
        "rows": name,
    }
    try:
        files.create_once(spark, f"{folder}/manifest.json", json.dumps(manifest, indent=2))
    except files.ExistsError:
        files.delete(spark, f"{folder}/{name}")  # another call sealed first
    return sealed_rows(spark, folder)
