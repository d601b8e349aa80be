"""Smoothed speed and status per road edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse.functions.scalars import edge_wire, greenshields_speed, traffic_weight
from roadpulse.operators.metrics import join_thresholds, writable_edges
from roadpulse.operators.ordinal import as_of
from roadpulse.operators.scan import Fold, ordered_scan
from roadpulse.session import HOT_ROWS


# Sorts before every real time.
FIRST = -(2**62)
# Slowdown at which the next status is at least YELLOW or RED, by previous status; GREEN never leads to RED.
YELLOW_FROM = {None: K.YELLOW_ENTER, K.GREEN: K.YELLOW_ENTER, K.YELLOW: K.YELLOW_EXIT, K.RED: K.YELLOW_EXIT}
RED_FROM = {None: K.RED_ENTER, K.GREEN: float("inf"), K.YELLOW: K.RED_ENTER, K.RED: K.RED_EXIT}


def next_status(slowdown: float, previous: str | None) -> str:
    """Status with hysteresis; ``slowdown`` is 1 - smoothed speed / free flow."""
    return K.RED if slowdown >= RED_FROM[previous] else K.YELLOW if slowdown >= YELLOW_FROM[previous] else K.GREEN


def smooth_step(state: tuple | None, t: int, raw_speed: float, free_flow: float) -> tuple[tuple, tuple]:
    """One observation of an edge. State: (stored speed with one decimal, status, time)."""
    live = state is not None and t - state[2] < K.EDGE_STATE_TTL
    previous, status = (state[0], state[1]) if live else (None, None)
    ema = K.EMA_ALPHA * raw_speed + (1 - K.EMA_ALPHA) * previous if live else raw_speed
    status_now = next_status(1 - ema / free_flow, status)
    stored = round(ema * 10) / 10
    return (stored, status_now, t), (previous, status, state[2] if live else None, ema, stored, status_now)


def _edge_entries(t: int, raw_speed: float, free_flow: float, top: float) -> dict:
    # Smoothed speeds never leave the range of the key's raw and stored speeds.
    return {(s / 10, status): (s / 10, status, t) for s in range(int(top * 10) + 2) for status in K.STATUSES}


def _edge_label(state: tuple, t: int) -> tuple | None:
    return (state[0], state[1]) if t - state[2] < K.EDGE_STATE_TTL else None


EDGE_FOLD = Fold(
    inputs=("raw_speed", "free_flow"),
    outputs="prev_speed double, prev_status string, prev_t bigint, ema double, speed double, status string",
    step=smooth_step,
    entry_states=_edge_entries,
    entry_label=_edge_label,
    bound="raw_speed",
)


def _resumed_step(state: tuple | None, t: int, raw_speed: float, free_flow: float, seed: str | None) -> tuple[tuple, tuple]:
    """As ``smooth_step``; a row with ``seed`` is a stored state (its speed in ``raw_speed``), not an observation."""
    return smooth_step(state, t, raw_speed, free_flow) if seed is None else ((raw_speed, seed, t), (None,) * 6)


RESUMED_FOLD = Fold(
    inputs=("raw_speed", "free_flow", "seed"),
    outputs=EDGE_FOLD.outputs,
    step=_resumed_step,
    entry_states=lambda t, raw, free_flow, seed, top: _edge_entries(t, raw, free_flow, top) if seed is None else None,
    entry_label=_edge_label,
    bound="raw_speed",
)


def edge_series(
    observations: DataFrame, camera_edges: DataFrame, free_flow: DataFrame, thresholds: DataFrame
) -> DataFrame:
    """Raw speed of every edge for every processed observation (occ, meu) of a camera.

    An observation that couldn't be measured (null occupancy) gives none. The edge tables are joined with each other first, so the observations meet one small table.
    """
    edges = writable_edges(camera_edges, free_flow)
    weighted = join_thresholds(observations.filter(F.col("occ").isNotNull()), thresholds).withColumn("twf", traffic_weight("occ", "meu", "meu_max"))
    return weighted.join(edges, "cam").withColumn("raw_speed", greenshields_speed("free_flow", "twf"))


def batch_last_writer(series: DataFrame) -> DataFrame:
    """Last observation of an edge within a batch: all of a batch read the same prior state, so only it counts.

    The maximum combines before the shuffle, which also bounds a hot edge to one row per batch.
    """
    rest = [c for c in series.columns if c not in ("edge_id", "batch_id")]
    last = F.max_by(F.struct(*rest), F.struct("t", "event_id"))
    return series.groupBy("edge_id", "batch_id").agg(last.alias("last")).select("edge_id", "batch_id", "last.*")


def speed_and_status(
    series: DataFrame, mode: str = "sequential", hot_rows: int = HOT_ROWS, previous: DataFrame | None = None,
    max_chunks: int | None = None,
) -> DataFrame:
    """Smoothed speed and status after every observation.

    ``sequential`` folds each row; ``batch`` folds the last row of each batch only. ``previous`` holds
    the stored state (edge_id, speed, t, status) of earlier data, from which the fold goes on, also for
    rows that are older than it.
    """
    rows = batch_last_writer(series) if mode == "batch" else series
    needed = ["edge_id", "t", "event_id", "raw_speed", "free_flow"]
    rows = rows.select(*needed, *(["batch_id"] if mode == "batch" else []))
    if previous is None:
        return ordered_scan(rows, "edge_id", "t", "event_id", EDGE_FOLD, hot_rows, max_chunks=max_chunks)
    # A row older than the stored state still meets it, and leaves its time as it is: rows count from that time on.
    known = previous.select("edge_id", F.col("t").alias("stored_t"))
    rows = rows.join(known, "edge_id", "left").withColumn("clock", F.greatest("t", F.coalesce("stored_t", "t"))).drop("stored_t")
    seeds = previous.select(
        "edge_id", F.lit(FIRST).alias("t"), F.lit(-1).cast("bigint").alias("event_id"), F.col("speed").alias("raw_speed"),
        F.col("status").alias("seed"), F.col("t").alias("clock"),
    )
    both = rows.withColumn("seed", F.lit(None).cast("string")).unionByName(seeds, allowMissingColumns=True)
    folded = ordered_scan(both, "edge_id", "clock", ["t", "event_id"], RESUMED_FOLD, hot_rows, max_chunks=max_chunks)
    return folded.filter(F.col("seed").isNull()).drop("seed", "clock")


def carried_state(speeds: DataFrame, previous: DataFrame | None) -> DataFrame:
    """State after ``speeds``, which went on from ``previous``: the last row of each edge, never dated back by a late one."""
    new = latest_state(speeds)
    if previous is None:
        return new
    old = previous.select("edge_id", *[F.col(c).alias(f"old_{c}") for c in ("speed", "t", "event_id", "status")])
    seen = F.col("speed").isNotNull()
    kept = [F.when(seen, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c) for c in ("speed", "event_id", "status")]
    return new.join(old, "edge_id", "full_outer").select("edge_id", kept[0], F.greatest("t", "old_t").alias("t"), *kept[1:])


def latest_state(speeds: DataFrame) -> DataFrame:
    """Newest row per edge: the published table."""
    order = F.struct("t", "event_id")
    last = F.max_by(F.struct("speed", "t", "event_id", "status"), order)
    return speeds.groupBy("edge_id").agg(last.alias("s")).select("edge_id", "s.*")


def expire_state(state: DataFrame, lateness: int = 0) -> DataFrame:
    """State without edges too old to matter to any row at most ``lateness`` seconds behind the newest."""
    newest = state.agg(F.max("t")).first()[0]
    return state if newest is None else state.filter(F.col("t") > newest - lateness - K.EDGE_STATE_TTL)


def prev_state_asof(probes: DataFrame, written: DataFrame) -> DataFrame:
    """State that each probe (edge_id, event_id, t) finds in a history of written states (edge_id, event_id, t, speed, status).

    It is the last one written before, absent before the first write and once expired. A probe without event_id meets
    all that was written up to and at its moment. Nothing is folded: both sides are put in one order.
    """
    last = F.lit(2**62)
    asked = probes.select("edge_id", "event_id", "t", F.coalesce("event_id", last).alias("tie"))
    history = written.select("edge_id", "t", F.col("event_id").alias("tie"), F.col("speed").alias("prev_speed"), F.col("status").alias("prev_status"))
    found = as_of(asked, history, "edge_id", ["prev_speed", "prev_status"], K.EDGE_STATE_TTL)
    return found.drop("tie").withColumnRenamed("found_t", "prev_t")


def status_changes(speeds: DataFrame) -> DataFrame:
    """Observations that changed a live status."""
    return speeds.filter(F.col("prev_status") != F.col("status")).select(
        "edge_id", "event_id", "t", F.col("prev_status").alias("from_status"), F.col("status").alias("to_status")
    )


def edge_speed_wire(state: DataFrame) -> DataFrame:
    return state.select("edge_id", edge_wire("speed", "t", "status").alias("wire"))


def state_at(speeds: DataFrame, as_of: int) -> DataFrame:
    return latest_state(speeds.filter(F.col("t") <= as_of))


def fresh_edges(state: DataFrame, as_of: int) -> DataFrame:
    """Edges whose value is at most the freshness limit old."""
    return state.filter(F.lit(as_of) - F.col("t") <= K.FRESH_SECONDS)


def cleared_edges(active_before: DataFrame, active_now: DataFrame) -> DataFrame:
    """Edges that were active and no longer are."""
    return active_before.select("edge_id").join(active_now.select("edge_id"), "edge_id", "left_anti")


def edge_coverage(state: DataFrame, camera_edges: DataFrame) -> DataFrame:
    """Edges with a live speed among all mapped edges."""
    live = state.select("edge_id", F.lit(True).alias("live"))
    joined = camera_edges.select("edge_id").distinct().join(live, "edge_id", "left")
    return joined.agg(
        F.count("live").alias("n_live"), F.count(F.lit(1)).alias("n_edges"),
        F.try_divide(F.count("live").cast("double"), F.count(F.lit(1)).cast("double")).alias("coverage"),
    )


def freshness_lag(state: DataFrame, as_of: int) -> DataFrame:
    lag = F.lit(as_of) - F.col("t")
    return state.agg(F.min(lag).alias("min_lag"), F.avg(lag).alias("avg_lag"), F.max(lag).alias("max_lag"))
