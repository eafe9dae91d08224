"""A keyed table as a log of snapshots: versioned folders and a commit file for each version.

Rows lie in buckets by a hash of the key. A version is a small JSON file that names, for each bucket, the folder with its
rows; a writer puts the new rows of the buckets it touches in new folders and then creates the next version's file, which
either appears whole or not at all. So

* a reader always sees one version; a writer that dies before its commit has changed nothing (``vacuum`` clears its folders),
* a batch rewrites the buckets of its own keys only,
* of two writers that start from one version one commits and the other raises ``ExistsError`` and can try again,
* a batch that a stream hands over again (same writer and batch id) is recognised and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyforge.sources import files

#: Buckets of a new table. A batch touches at most as many; choose more for a table of many gigabytes.
BUCKETS = 32


@dataclass
class Snapshot:
    version: int
    schema: StructType
    keys: list[str]
    buckets: int
    folders: dict[int, str]
    batches: dict[str, int]


class SnapshotTable:
    """``path/log/<version>.json`` and ``path/data/<version>-<id>/_bucket=<n>``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # --- reading ---------------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in files.names(self.spark, f"{self.path}/log") if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """A version, by default the last one; None if there is none."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            return None
        at = known[-1] if version is None else version
        d = json.loads(files.read_text(self.spark, f"{self.path}/log/{at:020d}.json"))
        return Snapshot(at, StructType.fromJson(d["schema"]), d["keys"], d["buckets"], {int(k): v for k, v in d["folders"].items()}, d["batches"])

    def _rows(self, snap: Snapshot, only: set[int] | None = None) -> DataFrame:
        at = [f"{self.path}/data/{f}/_bucket={b}" for b, f in sorted(snap.folders.items()) if only is None or b in only]
        if not at:
            return self.spark.createDataFrame([], snap.schema)
        return self.spark.read.schema(snap.schema).parquet(*at)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version. Later commits do not change what this frame reads, until ``vacuum`` drops the version."""
        snap = self.snapshot(version)
        if snap is None:
            raise ValueError(f"no version {'' if version is None else version} at {self.path}")
        return self._rows(snap)

    def _touched(self, batch: DataFrame, keys: list[str], buckets: int) -> set[int]:
        return {r[0] for r in batch.select(self._bucket(keys, buckets)).distinct().collect()}  # at most `buckets` numbers

    def read_for(self, batch: DataFrame, keys: list[str]) -> DataFrame:
        """The rows of the buckets in which the batch's keys lie; none, with the batch's columns, while there is no table."""
        snap = self.snapshot()
        if snap is None:
            return batch.limit(0)
        return self._rows(snap, self._touched(batch, keys, snap.buckets))

    def done(self, writer: str, batch_id: int) -> bool:
        snap = self.snapshot()
        return snap is not None and snap.batches.get(writer, -1) >= batch_id

    # --- writing ---------------------------------------------------------------------------------------------------

    def _bucket(self, keys: list[str], buckets: int):  # noqa: ANN202
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _commit(self, snap: Snapshot) -> int:
        text = json.dumps({"schema": snap.schema.jsonValue(), "keys": snap.keys, "buckets": snap.buckets, "folders": snap.folders, "batches": snap.batches})
        files.create_once(self.spark, f"{self.path}/log/{snap.version:020d}.json", text)
        return snap.version

    def _write(self, rows: DataFrame, keys: list[str], buckets: int, version: int) -> tuple[str, set[int]]:
        """Rows in a new folder, one task and file group for each bucket; the folder and the buckets that got rows."""
        name = f"{version:020d}-{uuid.uuid4().hex}"
        out = rows.withColumn("_bucket", self._bucket(keys, buckets))
        out.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/data/{name}")
        return name, {int(n.split("=")[1]) for n in files.names(self.spark, f"{self.path}/data/{name}") if n.startswith("_bucket=")}

    def replace(self, rows: DataFrame, keys: list[str], buckets: int = BUCKETS) -> int:
        """All rows anew, as the next version; ``rows`` may read the version before."""
        snap = self.snapshot()
        version = 0 if snap is None else snap.version + 1
        name, full = self._write(rows, keys, buckets, version)
        return self._commit(Snapshot(version, rows.schema, keys, buckets, dict.fromkeys(full, name), {} if snap is None else snap.batches))

    def merge(self, batch: DataFrame, keys: list[str], into: Callable[[DataFrame, DataFrame], DataFrame], writer: str | None = None, batch_id: int = -1, buckets: int = BUCKETS, schema: StructType | None = None) -> int:
        """``into(old rows of the batch's buckets, batch)`` gives their new rows. Returns the version; the same batch id of the
        same writer does nothing the second time. A first call makes the table, from an empty one of ``schema`` (by
        default that of the batch). Rows whose bucket the batch doesn't have must not come out of ``into``."""
        snap = self.snapshot()
        if snap is None:
            kind = schema or StructType([*batch.schema.fields])
            snap = Snapshot(-1, kind, keys, buckets, {}, {})
        if writer is not None and snap.batches.get(writer, -1) >= batch_id:
            return snap.version
        if snap.keys != keys:
            raise ValueError(f"the table's key is {snap.keys}")
        touched = self._touched(batch, keys, snap.buckets)
        batches = dict(snap.batches) if writer is None else {**snap.batches, writer: batch_id}
        folders = dict(snap.folders)
        if touched:
            rows = into(self._rows(snap, touched), batch).select(*snap.schema.fieldNames())
            name, full = self._write(rows, keys, snap.buckets, snap.version + 1)
            if full - touched:
                raise ValueError("merged rows left the batch's buckets")
            for b in touched:
                folders.pop(b, None)
            folders.update(dict.fromkeys(full, name))
        return self._commit(Snapshot(snap.version + 1, snap.schema, keys, snap.buckets, folders, batches))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Drop all versions but the last ``keep`` and the folders that none of those names, left by dead writers too. Not
        while another writer is at work. Returns the folders dropped."""
        known = self.versions()
        held = {f for v in known[-keep:] for f in self.snapshot(v).folders.values()}
        for v in known[:-keep]:
            files.delete(self.spark, f"{self.path}/log/{v:020d}.json")
        gone = [n for n in files.names(self.spark, f"{self.path}/data") if n not in held]
        for n in gone:
            files.delete(self.spark, f"{self.path}/data/{n}")
        return gone
