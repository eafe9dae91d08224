"""Streaming jobs over append-only logs. Each is a function of a streaming (or static) DataFrame: the static form is the
batch twin that the driver queries run. Event time is ``ts`` with a watermark; state is bounded by it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators import selection as S
from tallyforge.sources.snapshots import SnapshotTable


def read_log(spark, path: str, schema: str) -> DataFrame:  # noqa: ANN001
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def liveness(beats: DataFrame, now: str, minutes: int = 15) -> DataFrame:
    """Latest beat of each session and whether it is stale; a missing time is stale, and stale never changes the status."""
    last = beats.groupBy("session_id").agg(F.max_by(F.struct("status", "ts"), F.struct(F.col("ts").isNotNull(), "ts", "event_id")).alias("b"))
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("b.ts")
    return last.select("session_id", F.col("b.status").alias("status"), (F.col("b.ts").isNull() | (age > 60 * minutes)).alias("stale"))


def liveness_stream(beats: DataFrame, delay: str = "30 minutes", gap: str = "15 minutes") -> DataFrame:
    """Sessions that fell silent: a session window closes once the watermark passes its gap, in append mode."""
    w = F.session_window("ts", gap)
    return beats.withWatermark("ts", delay).groupBy("session_id", w).agg(F.count("*").alias("beats"), F.max("ts").alias("last_ts")).select("session_id", "beats", "last_ts")


TRANSITIONS = {"starting": ["working", "blocked", "done"], "working": ["blocked", "done"], "blocked": ["working", "done"], "done": []}


def attempt_transitions(beats: DataFrame) -> DataFrame:
    """Illegal status changes of a session in sequence; unknown statuses are passed over."""
    known = beats.where(F.col("status").isin(list(TRANSITIONS)))
    legal = F.create_map(*[x for k, v in TRANSITIONS.items() for x in (F.lit(k), F.array(*map(F.lit, [*v, k])))])
    prev = F.lag("status").over(Window.partitionBy("session_id").orderBy("seq"))
    return known.withColumn("prev", prev).where(F.col("prev").isNotNull() & ~F.array_contains(legal[F.col("prev")], F.col("status"))).select("session_id", "seq", "prev", "status")


def dedupe_events(events: DataFrame) -> DataFrame:
    """One row per event id; ``collision`` marks ids that came with different bodies (times aside)."""
    return events.groupBy("event_id").agg(F.min_by("body", F.struct("ts", "body")).alias("body"), (F.countDistinct("body") > 1).alias("collision"))


def dedupe_stream(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Exact repeats dropped within the watermark; equal ids with other bodies pass, and ``collision_sink`` tells them apart."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id", "body"])


def append_new(batch: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``event_id, body, ts`` against the table: rows to append (the first body of each new id), and collisions (the id came
    with another body than the one kept, or with several)."""
    first = batch.groupBy("event_id").agg(F.min_by(F.struct("body", "ts"), F.struct("ts", "body")).alias("f"))
    old = kept.select("event_id", F.col("body").alias("_old")).distinct()
    new = first.join(old.select("event_id"), "event_id", "left_anti").select("event_id", "f.body", "f.ts")
    held = old.unionByName(new.select("event_id", F.col("body").alias("_old")))
    other = batch.select("event_id", "body").distinct().join(held, "event_id").where("body <> _old").select("event_id", "body")
    return new, other


def collision_sink(path: str, collisions: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: add new events to one snapshot table and colliding bodies to another. A batch is held against the
    buckets of its own ids, not the whole history; one that is run again changes nothing. Collisions are committed
    first, so a crash between the two commits repeats the second one only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept, clash = SnapshotTable(spark, path), SnapshotTable(spark, collisions)
        if kept.done("stream", batch_id):
            return
        rows = batch.select("event_id", "body", "ts").persist()
        try:
            new, other = append_new(rows, kept.read_for(rows, ["event_id"]))
            clash.merge(other, ["event_id"], DataFrame.unionByName, "stream", batch_id)
            kept.merge(new, ["event_id"], DataFrame.unionByName, "stream", batch_id)
        finally:
            rows.unpersist()

    return write


def activity_windows(events: DataFrame, width: str, slide: str | None = None, delay: str | None = None) -> DataFrame:
    """Rows and distinct-ish users per tumbling or sliding window."""
    rows = events.withWatermark("ts", delay) if delay else events
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return rows.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def session_windows(events: DataFrame, gap: str, delay: str | None = None) -> DataFrame:
    """Activity sessions of each user with a gap."""
    rows = events.withWatermark("ts", delay) if delay else events
    return rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def night_aggregates(rows: DataFrame, delay: str | None = "1 day", observe: str | None = None) -> DataFrame:
    """Records and errors per night and arm; late rows within the watermark are added, later ones are dropped and counted by
    Spark. With ``observe`` the rows and errors of each batch are counted under that name in the same pass; both numbers
    are read by ``progress_counts``."""
    source = rows.withWatermark("ts", delay) if delay else rows
    if observe is not None:
        source = source.observe(observe, F.count(F.lit(1)).alias("rows"), F.count_if("is_error").alias("errors"), F.count_if(F.col("ts").isNull()).alias("without_time"))
    return source.groupBy(F.window("ts", "1 day").alias("w"), "arm").agg(F.count("*").alias("records"), F.count_if("is_error").alias("errors")).select(F.col("w.start").cast("date").alias("night"), "arm", "records", "errors")


def progress_counts(progress: list, observe: str | None = None) -> dict[str, int]:
    """What the batches of a query have counted, from its ``recentProgress`` or from what a listener kept of it: ``input`` rows,
    ``late`` rows dropped behind the watermark (each once for every stateful operator they reach), and the sums of
    the observed counts."""
    out = {"input": 0, "late": 0}
    for p in progress:
        out["input"] += p.numInputRows
        out["late"] += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        seen = p.observedMetrics.get(observe) if observe else None
        for name, value in (seen.asDict() if seen is not None else {}).items():
            out[name] = out.get(name, 0) + value
    return out


def upsert_sink(path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: merge each batch into a snapshot table; only the buckets of its keys are written anew, and a batch
    that is run again changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rest = [c for c in batch.columns if c not in keys]
        order = F.struct(*(["ts"] if "ts" in rest else []), *[c for c in rest if c != "ts"])
        last = batch.groupBy(*keys).agg(F.max(order).alias("_r")).select(*[F.col(c) if c in keys else F.col(f"_r.{c}") for c in batch.columns]).persist()  # the latest of a key
        try:
            SnapshotTable(batch.sparkSession, path).merge(last, keys, lambda old, new: S.upsert(old, new, keys), "stream", batch_id)
        finally:
            last.unpersist()

    return write


_FINDINGS = "id string, `check` string, status string, batch long"


def finding_sink(path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: add status rows of new findings, and of open ones a check no longer makes, to a snapshot table.
    What a check no longer makes is only known from all its open findings, so these are read; what is written are the
    buckets of changed ones."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = SnapshotTable(spark, path)
        if table.done("stream", batch_id):
            return
        rows = table.read() if table.versions() else spark.createDataFrame([], _FINDINGS)
        old = rows.groupBy("id").agg(F.max_by(F.struct("check", "status"), "batch").alias("x")).select("id", "x.check", "x.status")
        new = batch.select(F.col("id").cast("string").alias("id"), "check").distinct()
        changes = S.transition_findings(old, new, batch.select("check"))
        checks = new.unionByName(old.select("id", "check")).groupBy("id").agg(F.min("check").alias("check"))
        changed = changes.join(checks, "id").select("id", "check", "status", F.lit(batch_id).cast("long").alias("batch")).persist()
        try:
            table.merge(changed, ["id"], DataFrame.unionByName, "stream", batch_id)
        finally:
            changed.unpersist()

    return write
