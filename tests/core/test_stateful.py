"""Stateful streams over a folder of heartbeats."""

from datetime import datetime

from pyspark.sql import functions as F

from tallyforge.operators.selection import lease_chain
from tallyforge.streaming import jobs as J
from tallyforge.streaming import stateful as S

SCHEMA = "session_id string, seq long, status string, ts timestamp"


def write(spark, folder, rows):
    at = F.when(F.col("at").isNotNull(), F.timestamp_seconds(1_700_000_000 + F.col("at"))).alias("ts")
    spark.createDataFrame(rows, "session_id string, seq long, status string, at long").select("session_id", "seq", "status", at).coalesce(1).write.mode("append").parquet(str(folder))


class Stream:
    """A job over a folder, each file a batch; it can be stopped and started again from its checkpoint."""

    def __init__(self, spark, tmp_path, make, name):
        # state with a time to live asks for batches without end, so such a query is started for one batch
        self.trigger = {"availableNow": True} if make is S.silent_sessions else {"once": True}
        self.spark, self.at, self.make, self.out = spark, tmp_path, make, tmp_path / f"out-{name}"
        self.folder, self.checkpoint = tmp_path / f"in-{name}", tmp_path / f"c-{name}"
        spark.createDataFrame([], SCHEMA).write.parquet(str(self.folder))

    def run(self, *files):
        """Each file in a query of its own that goes on from the checkpoint and ends when the file is done."""
        for rows in files:
            write(self.spark, self.folder, rows)
            stream = self.make(J.read_log(self.spark, str(self.folder), SCHEMA))
            q = stream.writeStream.format("parquet").option("path", str(self.out)).outputMode("append").option("checkpointLocation", str(self.checkpoint)).trigger(**self.trigger).start()
            ended = q.awaitTermination(60)
            q.stop()
            assert ended
        return {tuple(r) for r in self.spark.read.schema(stream.schema).parquet(str(self.out)).collect()}


def test_silence_is_reported_once_and_watched_again(spark, tmp_path):
    s = Stream(spark, tmp_path, S.silent_sessions, "a")
    got = s.run([("a", 1, "working", 0), ("b", 1, "working", 0), ("c", 1, "working", None)], [("b", 2, "blocked", 1800)], [("b", 3, "blocked", 3600), ("a", 2, "done", 3600)], [("b", 4, "working", 9000)])
    assert {r for r in got if r[0] == "a"} == {("a", "working", 1), ("a", "done", 2)}
    assert not [r for r in got if r[0] == "c"]  # without any time there is nothing to wait for


def test_state_survives_a_restart(spark, tmp_path):
    s = Stream(spark, tmp_path, S.transitions, "t")
    assert s.run([("a", 1, "starting", 0), ("a", 2, "done", 60)]) == set()
    assert s.run([("a", 3, "working", 120), ("b", 1, "paused", 0)]) == {("a", 3, "done", "working")}
    leases = Stream(spark, tmp_path, S.lease_breaks, "l")
    assert leases.run([("a", 1, "working", 0), ("a", 2, "working", 600)]) == set()
    assert leases.run([("a", 3, "working", 3000), ("a", 5, "working", 3100)]) == {("a", 3, "late"), ("a", 5, "sequence")}
    silent = Stream(spark, tmp_path, S.silent_sessions, "s")
    silent.run([("a", 1, "working", 0), ("b", 1, "working", 0)])
    assert ("a", "working", 1) in silent.run([("b", 2, "working", 3000)])


def test_streams_equal_their_batch_twins(spark, tmp_path):
    """Streams in three batches against the batch operators over all rows."""
    kinds = ["starting", "working", "blocked", "done", "paused"]
    rows = [(f"s{i % 5}", i // 5 + 1, kinds[(i * i + i // 3) % 5], None if i % 23 == 5 else (i // 5) * 1500 + (2000 if i % 11 == 0 else 0)) for i in range(120) if i % 31]
    files = [rows[a : a + 40] for a in range(0, 120, 40)]
    at = spark.createDataFrame([(s, q, k, None if t is None else datetime.fromtimestamp(1_700_000_000 + t)) for s, q, k, t in rows], SCHEMA)
    assert Stream(spark, tmp_path, S.transitions, "t").run(*files) == {tuple(r) for r in J.attempt_transitions(at).collect()}
    faults = Stream(spark, tmp_path, S.lease_breaks, "l").run(*files)
    first = {s: min((q, f) for k, q, f in faults if k == s) for s in {r[0] for r in faults}}
    assert first == {r.session_id: (int(r.seq), r.fault) for r in lease_chain(at).collect() if r.fault}
    end = [[("z", 1, "working", 10**6)], [("z", 2, "working", 2 * 10**6)]]
    silent = Stream(spark, tmp_path, S.silent_sessions, "s").run([r for r in rows if r[3] is not None], *end)
    last = {(r.session_id, r.status) for r in J.liveness(at.where("ts is not null").withColumn("event_id", F.col("seq")), "2030-01-01 00:00:00").collect() if r.stale}
    assert {(k, s) for k, s, _ in silent} - {("z", "working")} == last
