"""Stateful streams over heartbeats: a few values per session, kept by ``transformWithState`` in the RocksDB state store.

Each job keeps the last beat of a session in a value state and compares the new ones, in order of their sequence, with it.
What happens without a row is driven by timers: event-time timers fire when the watermark passes them, so a session that
falls silent is reported though nothing of it arrives; state that no beat has touched for ``keep_minutes`` is dropped by
the state's own time to live, which Spark counts in processing time. State lives in the query's checkpoint and survives
a restart. The batch twins are ``jobs.liveness``, ``jobs.attempt_transitions`` and ``selection.lease_chain``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyforge.streaming.jobs import TRANSITIONS

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = "status string, seq long, at_ms long"


def use_rocksdb(spark: SparkSession) -> None:
    """``transformWithState`` asks for the RocksDB store; set for the session before a query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def _beats(rows: Iterator[Row]) -> list[tuple[int, str | None, int]]:
    """``seq, status, at_ms`` of new rows in order; a missing time is -1, a row without sequence number is passed over."""
    return sorted(((r.seq, r.status, -1 if r.ts is None else int(r.ts.timestamp() * 1000)) for r in rows if r.seq is not None), key=lambda b: (b[0], b[2], b[1] or ""))


class _LastBeat(StatefulProcessor):
    """Keeps the last beat of a session. ``keep_ms`` is the time to live of its state, None for a state that timers end."""

    def __init__(self, keep_ms: int | None = None) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _STATE, self.keep_ms)

    def before(self) -> tuple[str | None, int, int] | None:
        return tuple(self.last.get()) if self.last.exists() else None

    def close(self) -> None:
        pass


class _Silence(_LastBeat):
    def __init__(self, silence_ms: int) -> None:
        super().__init__()
        self.silence_ms = silence_ms

    def handleInputRows(self, key, rows, timerValues):  # noqa: ANN001, ANN201, N802, N803
        last = self.before()
        for seq, status, at in _beats(rows):
            if last is None or (at, seq) >= (last[2], last[1]):  # the last in time, as in the batch twin
                last = (status, seq, at)
        if last is not None:
            self.last.update(last)
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            if last[2] >= 0:
                self.handle.registerTimer(max(last[2] + self.silence_ms, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: ANN001, ANN201, N802, N803
        last = self.before()
        self.last.clear()
        if last is not None:
            yield Row(session_id=key[0], status=last[0], last_seq=last[1])


class _Transitions(_LastBeat):
    def handleInputRows(self, key, rows, timerValues):  # noqa: ANN001, ANN201, N802, N803
        last, out = self.before(), []
        for seq, status, at in _beats(rows):
            if status not in TRANSITIONS:
                continue
            if last is not None and status != last[0] and status not in TRANSITIONS[last[0]]:
                out.append(Row(session_id=key[0], seq=seq, prev=last[0], status=status))
            last = (status, seq, at)
        if last is not None:
            self.last.update(last)
        return iter(out)


class _Leases(_LastBeat):
    def __init__(self, lease_ms: int, keep_ms: int) -> None:
        super().__init__(keep_ms)
        self.lease_ms = lease_ms

    def handleInputRows(self, key, rows, timerValues):  # noqa: ANN001, ANN201, N802, N803
        last, out = self.before(), []
        for seq, status, at in _beats(rows):
            if at < 0:
                fault = "no_time"
            elif last is not None and seq != last[1] + 1:
                fault = "sequence"
            else:
                fault = "late" if last is not None and last[2] >= 0 and at // 1000 - last[2] // 1000 > self.lease_ms // 1000 else None
            if fault:
                out.append(Row(session_id=key[0], seq=seq, fault=fault))
            last = (status, seq, at)
        if last is not None:
            self.last.update(last)
        return iter(out)


def _run(beats: DataFrame, processor: StatefulProcessor, schema: str, delay: str | None) -> DataFrame:
    use_rocksdb(beats.sparkSession)
    # the driver starts a worker of its own to read the processor; it need not find this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = beats.select("session_id", "seq", "status", "ts")
    if delay is not None:
        rows = rows.withWatermark("ts", delay)
    return rows.groupBy("session_id").transformWithState(processor, schema, "Append", "EventTime" if delay is not None else "ProcessingTime")


def silent_sessions(beats: DataFrame, minutes: int = 15, delay: str = "5 minutes") -> DataFrame:
    """``session_id, status, last_seq``: sessions whose last beat in time is older than ``minutes`` when the watermark passes it.
    The status is that beat's, as staleness never changes it. A session that speaks again is watched again."""
    return _run(beats, _Silence(minutes * 60_000), "session_id string, status string, last_seq long", delay)


def transitions(beats: DataFrame, keep_minutes: int = 1440) -> DataFrame:
    """``session_id, seq, prev, status``: status changes that the state machine does not allow; unknown ones are passed over."""
    return _run(beats, _Transitions(keep_minutes * 60_000), "session_id string, seq long, prev string, status string", None)


def lease_breaks(beats: DataFrame, lease_s: int = 1800, keep_minutes: int = 1440) -> DataFrame:
    """``session_id, seq, fault``: beats without a time, renewals that skip a sequence number, or come after the lease before has
    run out. The first of a session is the fault that ``selection.lease_chain`` names."""
    return _run(beats, _Leases(lease_s * 1000, keep_minutes * 60_000), "session_id string, seq long, fault string", None)
