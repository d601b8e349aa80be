"""Keyed streaming folds on the state store: the same step functions as the batch operators.

Rows later than the watermark are dropped by Spark. State expires on event time, by timers, once the watermark
has passed the moment at which the step itself would start anew, so expiry frees storage and never changes a
result. (A time to live in processing time would expire differently on every replay.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from roadpulse import constants as K
from roadpulse.operators.accident import cooldown_step, streak_step
from roadpulse.operators.edge_state import smooth_step


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Rows of one key that are turned into one output batch.
CHUNK_ROWS = 20_000
# Keys that the edges of a stream are dealt to; fixed, as the stored state lies by them.
EDGE_BUCKETS = 1024
# Before every real time.
NEVER = -(2**62)
ALERT_OUTPUT = "cam bigint, t bigint, event_id bigint, class_name string, conf double, hit boolean, streak bigint, fires boolean"
EDGE_OUTPUT = (
    "edge_id string, t bigint, event_id bigint, prev_speed double, prev_status string, prev_t bigint, ema double,"
    " speed double, status string, clock bigint, cleared boolean"
)


def use_rocksdb(spark: SparkSession) -> None:
    """State of new queries goes to RocksDB, on each executor's disk, with changes uploaded to the checkpoint folder."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _millis(seconds: int) -> int:
    """Event time of a moment in the data. Spark's first watermark is 1970 itself and drops rows not after it, so times count from a second later."""
    return (seconds + 1) * 1000


def _with_watermark(rows: DataFrame, lateness: int) -> DataFrame:
    return rows.withColumn("ts", F.timestamp_seconds(F.col("t") + 1)).withWatermark("ts", f"{lateness} seconds")


def alert_step(state: tuple | None, t: int, hit: bool) -> tuple[tuple, tuple]:
    """State: (hits in a row, time of the last hit, time of the last alert), all nullable."""
    hits, last_hit, last_alert = state or (None, None, None)
    streak_state, (streak,) = streak_step((hits, last_hit) if hits else None, t, hit)
    fires = False
    if streak >= K.ALERT_STREAK:
        (last_alert,), (fires,) = cooldown_step(None if last_alert is None else (last_alert,), t)
    hits, last_hit = streak_state or (None, None)
    return (hits, last_hit, last_alert), (streak, fires)


class AlertProcessor(StatefulProcessor):
    """Streak and alerts of one camera.

    State: (hits in a row, time of the last hit, time of the last alert, pending timer). Rows of a micro-batch are put
    in order as in ``EdgeProcessor``. The timer removes the state once neither streak nor cooldown can matter.
    """

    def __init__(self):
        self.state_schema = StructType.fromDDL("hits bigint, last_hit bigint, last_alert bigint, timer bigint")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("camera", self.state_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [[b[c].to_numpy() for c in ("t", "event_id", "hit", "class_name", "conf")] for b in rows]
        time, tie, hit, name, conf = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((tie, time))
        held = self.state.get()
        state = None if held is None else tuple(held[:3])
        for start in range(0, len(order), CHUNK_ROWS):
            own = order[start : start + CHUNK_ROWS]
            found = []
            for i in own.tolist():
                state, out = alert_step(state, int(time[i]), bool(hit[i]))
                found.append(out)
            yield pd.DataFrame({
                "cam": key[0], "t": time[own], "event_id": tie[own], "class_name": name[own], "conf": conf[own], "hit": hit[own],
                "streak": [f[0] for f in found], "fires": [f[1] for f in found],
            })
        if held is not None:
            self.handle.deleteTimer(held[3])
        timer = _millis(int(time[order[-1]]) + K.ALERT_COOLDOWN)
        self.handle.registerTimer(timer)
        self.state.update((*state, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def accident_alerts(series: DataFrame, lateness: int) -> DataFrame:
    """Streak of every processed frame of a stream and whether it raises an alert; later rows are dropped."""
    use_rocksdb(series.sparkSession)
    rows = _with_watermark(series, lateness).select("ts", "cam", "t", "event_id", "class_name", "conf", "hit")
    return rows.groupBy("cam").transformWithStateInPandas(AlertProcessor(), ALERT_OUTPUT, "Append", "EventTime")


class EdgeProcessor(StatefulProcessor):
    """Smoothed speed, status and freshness of the edges of one bucket.

    State per edge: (speed, status, time of the last write, pending timer). Each key of a stream costs several calls to
    Spark's state server and a pandas frame, far more than folding its rows, so a key holds a bucket of edges and
    their number doesn't tell in calls. Rows of a micro-batch are folded edge by edge in order of time; one
    that is older than the last write still meets the state and leaves its time as it is. Spark can't sort a stream,
    so a bucket's rows of a micro-batch are put in order here: a few numbers a row are held, and the source's rate options
    bound their number. With ``last_only`` all rows of a micro-batch meet the state before it and only an edge's last one counts.

    Each write sets an edge's timer just past the freshness limit in place of the one before. When it is due, or when the next
    write comes later than that, a row with ``cleared`` says that the edge went stale at ``t``. The next timer, at the
    state's expiry, removes the state. Spark holds one timer per bucket, the earliest of its edges'.
    """

    def __init__(self, last_only: bool = False):
        self.last_only = last_only
        self.state_schema = StructType.fromDDL(
            "edge_id array<string>, speed array<double>, status array<string>, t array<bigint>, timer array<bigint>, due bigint"
        )
        self.columns = StructType.fromDDL(EDGE_OUTPUT).fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("edges", self.state_schema)

    def _frame(self, edge: str | list, rows: list[tuple]) -> pd.DataFrame:
        # Made once per key and micro-batch, so column by column, which takes pandas far less time than rows do.
        edges = edge if isinstance(edge, list) else [edge] * len(rows)
        out = dict(zip(self.columns, (edges, *map(list, zip(*rows)))))
        for name in ("event_id", "prev_t"):
            out[name] = pd.array(out[name], "Int64")
        return pd.DataFrame(out, copy=False)

    @staticmethod
    def _cleared(speed: float, status: str, t: int) -> tuple:
        return (t + K.FRESH_SECONDS, None, speed, status, t, None, None, None, t, True)

    def _read(self) -> tuple[dict[str, tuple], int | None]:
        """(state of each edge, the bucket's pending timer)."""
        held = self.state.get()
        return ({}, None) if held is None else ({edge: own for edge, *own in zip(*held[:5])}, held[5])

    def _write(self, states: dict[str, tuple], pending: int | None) -> None:
        due = min((own[3] for own in states.values()), default=None)
        if pending is not None and pending != due:
            self.handle.deleteTimer(pending)
        if due is None:
            self.state.clear()
            return
        if pending != due:
            self.handle.registerTimer(due)
        self.state.update((list(states), *map(list, zip(*states.values())), due))

    def _expire(self, states: dict[str, tuple], watermark: int) -> list[tuple[str, tuple]]:
        """Does what the timers up to ``watermark`` stand for and gives the (edge, cleared row) of those that went stale."""
        gone = []
        for edge, (speed, status, t, timer) in [s for s in states.items() if s[1][3] <= watermark]:
            last = _millis(t + K.EDGE_STATE_TTL)
            if timer < last:
                gone.append((edge, self._cleared(speed, status, t)))
            if watermark < last:
                states[edge] = (speed, status, t, last)
            else:
                del states[edge]
        return gone

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [[b[c].to_numpy() for c in ("edge_id", "t", "event_id", "raw_speed", "free_flow")] for b in rows]
        edge, time, tie, raw, flow = (np.concatenate(c) for c in zip(*parts))
        code, edges = pd.factorize(edge, use_na_sentinel=False)
        edges = [None if pd.isna(e) else e for e in edges]
        states, pending = self._read()
        known = np.array([states[e][2] if e in states else NEVER for e in edges], np.int64)
        clock = np.maximum(time, known[code])
        order = np.lexsort((tie, time, clock, code))
        if self.last_only:
            order = order[np.flatnonzero(np.diff(code[order], append=-1))]
        at, state, told = None, None, False
        for start in range(0, len(order), CHUNK_ROWS):
            own = order[start : start + CHUNK_ROWS]
            names, out = [], []
            for number, now, t, event, speed, free in zip(*(c[own].tolist() for c in (code, clock, time, tie, raw, flow))):
                if number != at:
                    if at is not None:
                        states[edges[at]] = (*state, _millis(state[2] + K.FRESH_SECONDS) + 1)
                    at, held = number, states.get(edges[number])
                    state = None if held is None else tuple(held[:3])
                    # An edge that its timer has already reported isn't reported again.
                    told = held is not None and held[3] >= _millis(held[2] + K.EDGE_STATE_TTL)
                now = int(now)
                if state is not None and now - state[2] > K.FRESH_SECONDS and not told:
                    names.append(edges[at])
                    out.append(self._cleared(*state))
                state, result = smooth_step(state, now, float(speed), float(free))
                told = False
                names.append(edges[at])
                out.append((int(t), int(event), *result, now, False))
            yield self._frame(names, out)
        states[edges[at]] = (*state, _millis(state[2] + K.FRESH_SECONDS) + 1)
        gone = self._expire(states, timerValues.getCurrentWatermarkInMs())
        self._write(states, pending)
        if gone:
            yield self._frame(*map(list, zip(*gone)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        states, _ = self._read()
        gone = self._expire(states, timerValues.getCurrentWatermarkInMs())
        self._write(states, None)  # Spark removes the timer that fired
        if gone:
            yield self._frame(*map(list, zip(*gone)))

    def close(self) -> None:
        pass


def edge_speeds(series: DataFrame, mode: str, lateness: int) -> DataFrame:
    """Speeds and cleared rows of a stream of edge observations; those ``lateness`` seconds behind the newest one are dropped."""
    use_rocksdb(series.sparkSession)
    rows = _with_watermark(series, lateness).select(
        F.pmod(F.hash("edge_id"), F.lit(EDGE_BUCKETS)).alias("bucket"), "ts", "edge_id", "t", "event_id", "raw_speed", "free_flow"
    )
    return rows.groupBy("bucket").transformWithStateInPandas(
        EdgeProcessor(mode == "batch"), EDGE_OUTPUT, "Append", "EventTime"
    )
