"""Monitoring as Structured Streaming jobs; the batch twins are in ``operators/monitoring.py``.

All timing is event time, so a replay gives the same output.  Incidents and the lifecycle audit take rows in event order: rows wait in
the state of their key until the watermark has passed them, so neither their order nor the cut into micro-batches matters, and only rows
later than the watermark are dropped.  Their state holds the rows of one lateness per key, open incidents, and detections up to
``retention`` after their end; it needs the RocksDB state store (``STATE_STORE``).  Freshness and the SLA clock hold one row per
watched key and open detection.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import constants as K
from ..operators.monitoring import AGE_LIMITS

SLA = dt.timedelta(minutes=60)


def ingest_heartbeats(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Heartbeats (ts, checked_at, source, status, content_hash, ...) once per key within the watermark (append)."""
    return stream.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["checked_at", "source", "status", "content_hash"])


def write_heartbeats(stream: DataFrame, path: str, checkpoint: str):
    """Append sink, partitioned by month; exactly once through the checkpoint."""
    rows = ingest_heartbeats(stream).withColumn("month", F.left("checked_at", F.lit(7)))
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("month").outputMode("append")


def _ordered(batches: Iterator[pd.DataFrame], *by: str) -> pd.DataFrame:
    """The rows of one key in one micro-batch, in event order."""
    frames = list(batches)
    return pd.concat(frames).sort_values(list(by)) if frames else pd.DataFrame()


FRESHNESS_OUT = "source string, at timestamp, severity int, last_check timestamp"
FRESHNESS_STATE = "last_check timestamp, level int"


def _limits(source: str) -> tuple[int, int] | None:
    for name, limits in AGE_LIMITS.items():
        if source == name or (name == "OFAC" and source.startswith(name)):
            return limits
    return None


def _freshness(key, batches, state: GroupState) -> Iterator[pd.DataFrame]:
    """A check resets the source; a timer raises severity 2, then 3, when no check arrives in time."""
    source = key[0]
    limits = _limits(source)
    if limits is None:
        return
    last, level = state.get if state.exists else (None, 0)
    out = []
    if state.hasTimedOut:
        level += 1
        out.append((source, last + dt.timedelta(minutes=limits[level - 1]), level + 1, last))
    else:
        newest = max(batch["ts"].max() for batch in batches).to_pydatetime()  # no need to hold the batches
        if last is None or newest > last:
            if level:
                out.append((source, newest, 0, newest))
            last, level = newest, 0
    if level < 2:
        due = last + dt.timedelta(minutes=limits[level])
        state.update((last, level))
        stamp = int(due.replace(tzinfo=dt.timezone.utc).timestamp() * 1000) + 1  # strictly older than the limit
        state.setTimeoutTimestamp(max(stamp, state.getCurrentWatermarkMs() + 1))
    else:
        state.update((last, level))
    yield pd.DataFrame(out, columns=["source", "at", "severity", "last_check"])


def freshness_alerts(stream: DataFrame, lateness: str = "5 minutes") -> DataFrame:
    """Severity changes per source (ts, source): 2 beyond the warn age, 3 beyond the critical age, 0 on recovery."""
    return stream.withWatermark("ts", lateness).groupBy("source").applyInPandasWithState(
        _freshness, FRESHNESS_OUT, FRESHNESS_STATE, "append", GroupStateTimeout.EventTimeTimeout)


#: Session settings of the jobs that take rows in event order.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class EventOrder(StatefulProcessor):
    """Hands the rows of a key to ``step`` in the order of ``ts`` and ``order``, once the watermark has passed them.

    A row waits in a map of the key's state under its place; a timer at its time wakes the key.  ``step(key, now, row)`` gives the next
    value of the key's state (None: nothing to keep) and the rows to put out.  A value for which ``ended`` holds is kept for
    ``retention`` after its last row, then dropped."""

    def __init__(self, payload: str, state: str, columns: list[str], step, order: str | None = None, ended=lambda now: False, retention: str = "0 days"):
        self.payload, self.state, self.columns, self.step, self.order, self.ended = payload, state, columns, step, order, ended
        self.retention = pd.Timedelta(retention) // pd.Timedelta(milliseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at long, ord long, copy int", self.payload)
        self.now = handle.getValueState("now", f"{self.state}, at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in self.payload.split(", ")]
        wake = set()
        for batch in rows:
            at = batch["ts"].astype("datetime64[us]").astype("int64")
            order = batch[self.order] if self.order else at * 0
            for place, *payload in zip(zip(at.tolist(), order.tolist()), *(batch[c].tolist() for c in names)):
                copy = 0
                while self.waiting.containsKey((*place, copy)):
                    copy += 1
                self.waiting.updateValue((*place, copy), tuple(payload))
                wake.add(-(-place[0] // 1000))
        for stamp in wake:
            self.handle.registerTimer(stamp)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        due = sorted((tuple(place), tuple(row)) for place, row in self.waiting.iterator() if place[0] <= watermark * 1000)
        held = self.now.get() if self.now.exists() else None
        now, last = (tuple(held)[:-1], held[-1]) if held else (None, None)
        out = []
        for place, row in due:
            now, found = self.step(key[0], now, (pd.Timestamp(place[0], unit="us"), *row))
            last = place[0]
            out += found
            self.waiting.removeKey(place)
        if now is not None and self.ended(now) and last // 1000 + self.retention <= watermark:
            now = None
        if now is None:
            self.now.clear()
        elif due:
            self.now.update((*now, last))
            if self.ended(now):
                self.handle.registerTimer(last // 1000 + self.retention + 1)
        yield pd.DataFrame(out, columns=self.columns)

    def close(self) -> None:
        pass


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


INCIDENT_OUT = "incident_key string, opened_at timestamp, resolved_at timestamp, change string"


def _incident(key: str, now: tuple | None, row: tuple) -> tuple[tuple | None, list[tuple]]:
    at, active = row
    if active and now is None:
        return (at.value // 1000,), [(key, at, pd.NaT, "opened")]
    if not active and now is not None:
        return None, [(key, pd.Timestamp(now[0], unit="us"), at, "resolved")]
    return now, []


def incidents(stream: DataFrame, lateness: str = "5 minutes") -> DataFrame:
    """Open / resolved events of checks (ts, incident_key, active), in event order: one open incident per key; closed keys leave no state."""
    return stream.withWatermark("ts", lateness).groupBy("incident_key").transformWithStateInPandas(
        EventOrder("active boolean", "opened long", _names(INCIDENT_OUT), _incident), INCIDENT_OUT, "Append", "EventTime")


LIFECYCLE_OUT = "detection_id bigint, ts timestamp, previous string, state string, violation string"


def _transition(key: int, now: tuple | None, row: tuple) -> tuple[tuple, list[tuple]]:
    at, state = row
    previous = now[0] if now else ""
    if state not in K.TRANSITIONS:
        violation = "UNKNOWN_STATE"
    elif state in K.TRANSITIONS.get(previous, []):
        return (state,), []
    else:
        violation = "AFTER_TERMINAL" if previous in K.TERMINAL_STATES else "FORBIDDEN_TRANSITION"
    return (state,), [(key, at, previous, state, violation)]


def lifecycle_violations(stream: DataFrame, lateness: str = "5 minutes", retention: str = "30 days") -> DataFrame:
    """Forbidden transitions of a lifecycle log (detection_id, ts, ord, state), in event order.  A detection in a terminal state is
    forgotten ``retention`` after its last row; one that comes back later starts anew."""
    ended = lambda now: now[0] in K.TERMINAL_STATES
    return stream.withWatermark("ts", lateness).groupBy("detection_id").transformWithStateInPandas(
        EventOrder("state string", "state string", _names(LIFECYCLE_OUT), _transition, "ord", ended, retention), LIFECYCLE_OUT, "Append", "EventTime")


SLA_OUT = "detection_id bigint, at timestamp, condition string"
SLA_STATE = "due timestamp, breached boolean"


def _sla(key, batches, state: GroupState) -> Iterator[pd.DataFrame]:
    """DETECTED starts the clock, DIFFED stops it; the timer reports a breach at the due time."""
    due, breached = state.get if state.exists else (None, False)
    out = []
    if state.hasTimedOut:
        out.append((key[0], due, "breached"))
        breached = True
        state.update((due, breached))
    else:
        for row in _ordered(batches, "ts").itertuples():
            at = row.ts.to_pydatetime()
            if row.state == "DETECTED" and due is None:
                due, breached = at + SLA, False
                out.append((key[0], at, "pending"))
            elif row.state == "DIFFED" and due is not None:
                out.append((key[0], at, "recovered" if breached or at >= due else "healthy"))
                due = None
        if due is None:
            if state.exists:
                state.remove()
        else:
            state.update((due, breached))
            if not breached:
                stamp = int(due.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
                state.setTimeoutTimestamp(max(stamp, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame(out, columns=["detection_id", "at", "condition"])


def sla_conditions(stream: DataFrame, lateness: str = "5 minutes") -> DataFrame:
    """SLA condition changes of a lifecycle log (detection_id, ts, state); finished detections leave no state."""
    return stream.withWatermark("ts", lateness).groupBy("detection_id").applyInPandasWithState(
        _sla, SLA_OUT, SLA_STATE, "append", GroupStateTimeout.EventTimeTimeout)
