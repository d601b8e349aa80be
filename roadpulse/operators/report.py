"""Queue and cycle bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse.operators.ordinal import STRETCH, numbered, running_sum
from roadpulse.session import materialize


def has_edges(cameras: DataFrame, camera_edges: DataFrame) -> DataFrame:
    """Edges per camera. Without edges the traffic job counts a camera as done; the accident job skips it."""
    counts = camera_edges.groupBy("cam").agg(F.count(F.lit(1)).alias("n_edges"))
    return cameras.select("cam").join(counts, "cam", "left").fillna(0, ["n_edges"]).withColumn(
        "accident_eligible", F.col("n_edges") > 0
    )


def known_cameras(queued: DataFrame, cameras: DataFrame) -> DataFrame:
    return queued.join(cameras.select("cam"), "cam", "left_semi")


def unknown_cameras(queued: DataFrame, cameras: DataFrame) -> DataFrame:
    return queued.join(cameras.select("cam"), "cam", "left_anti")


def drop_sentinel(queue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(camera ids without end-of-cycle markers, per batch the ids taken and whether a marker was seen)."""
    marker = F.col("item") == K.CYCLE_SENTINEL
    batches = queue.groupBy("batch_id").agg(F.count_if(~marker).alias("n_ids"), F.bool_or(marker).alias("sentinel"))
    return queue.filter(~marker), batches


def _judged(
    attempts: DataFrame, cameras: DataFrame, failing: DataFrame, failed_batches: DataFrame | None, unmeasured: DataFrame | None
) -> DataFrame:
    """``attempts`` with ``ok``; see ``cycle_stats``."""
    marked = attempts.join(cameras.select("cam", F.lit(True).alias("in_config")), "cam", "left")
    marked = marked.join(failing.select("cam", F.lit(True).alias("breaks")), "cam", "left")
    ok = F.coalesce("in_config", F.lit(False)) & F.col("fetched") & F.col("breaks").isNull()
    for table, key in ((failed_batches, "batch_id"), (unmeasured, "event_id")):
        if table is not None:
            marked = marked.join(table.select(key, F.lit(True).alias(f"{key}_failed")).distinct(), key, "left")
            ok = ok & F.col(f"{key}_failed").isNull()
    return marked.withColumn("ok", ok)


def cycle_stats(
    attempts: DataFrame, cameras: DataFrame, failing: DataFrame, failed_batches: DataFrame | None = None,
    unmeasured: DataFrame | None = None,
) -> DataFrame:
    """Done, failed and total cameras per cycle, and its length in seconds; a cycle is one ``batch_id``.

    A camera without edges counts as done. Unknown cameras, failed images and cameras that cannot be
    computed (``failing``) count as failed, and so do all cameras of ``failed_batches`` (batch_id), whose
    inference failed as a whole, and the attempts ``unmeasured`` (event_id), whose image doesn't fit its mask.
    """
    return _judged(attempts, cameras, failing, failed_batches, unmeasured).groupBy(F.col("batch_id").alias("cycle_id")).agg(
        F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("fail"), F.count(F.lit(1)).alias("total"),
        (F.max("t") - F.min("t")).alias("elapsed"),
    )


def mark_cycles(queue: DataFrame, order: list[str], batch_size: int = K.QUEUE_BATCH, stretch: int = STRETCH) -> tuple[DataFrame, DataFrame]:
    """(``queue`` without markers but with ``batch_id`` and ``cycle_id``, the batches).

    ``queue`` holds items and end-of-cycle markers in a total order. Batches take the next ``batch_size`` of either. A
    cycle ends with the batch that holds a marker, so ids behind the marker in that batch still belong to it, and two
    markers in one batch end one cycle. Batches are (batch_id, cycle_id, ended, end_t), ``end_t`` their last ``t``.
    """
    placed = numbered(queue, order, "position").withColumn("batch_id", F.expr(f"position div {batch_size}L"))
    marker = F.col("item") == K.CYCLE_SENTINEL
    batches = placed.groupBy("batch_id").agg(F.max(marker.cast("int")).alias("ended"), F.max("t").alias("end_t"))
    batches = materialize(running_sum(materialize(batches), "batch_id", "ended", "cycle_id", stretch))
    return placed.filter(~marker).drop("position").join(batches.select("batch_id", "cycle_id"), "batch_id"), batches


def marked_cycle_stats(
    queue: DataFrame, order: list[str], cameras: DataFrame, failing: DataFrame, batch_size: int = K.QUEUE_BATCH, stretch: int = STRETCH,
) -> DataFrame:
    """Done, failed and total cameras, batches and seconds of every cycle, as far as markers have ended it.

    Counts add up over a cycle's batches. It lasts from the end of the cycle before, the first one from its own first
    row. The last cycle may be without a marker: ``ended`` is false, as nothing has reported it yet.
    """
    attempts, batches = mark_cycles(queue, order, batch_size, stretch)
    counted = _judged(attempts, cameras, failing, None, None).groupBy("cycle_id").agg(
        F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("fail"), F.count(F.lit(1)).alias("total"),
    )
    cycles = batches.groupBy("cycle_id").agg(F.count(F.lit(1)).alias("batches"), (F.max("ended") == 1).alias("ended"), F.max("end_t").alias("end_t"))
    start = cycles.select((F.col("cycle_id") + 1).alias("cycle_id"), F.col("end_t").alias("start_t"))
    joined = cycles.join(counted, "cycle_id", "left").join(start, "cycle_id", "left")
    elapsed = F.col("end_t") - F.coalesce("start_t", queue.agg(F.min("t")).scalar())
    none = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("ok", "fail", "total")]
    return joined.select("cycle_id", *none, "batches", "ended", elapsed.alias("elapsed"))


def cycle_window(frames: DataFrame, seconds: int = K.CYCLE_SECONDS) -> DataFrame:
    """Frames and cameras per tumbling cycle; works on batch and streaming input with a ``ts`` column."""
    window = F.window("ts", f"{seconds} seconds")
    return frames.groupBy(window.alias("w")).agg(
        F.count(F.lit(1)).alias("n_frames"), F.min("cam").alias("min_cam"), F.max("cam").alias("max_cam")
    ).select(F.unix_seconds("w.start").alias("window_start"), "n_frames", "min_cam", "max_cam")


def admission_control(cycles: DataFrame, cameras: int) -> DataFrame:
    """Cycles that may start: the backlog is at most half of all cameras."""
    return cycles.withColumn("admitted", F.col("backlog") <= cameras * K.BACKLOG_RATIO)
