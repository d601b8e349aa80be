"""Accident alerts: best incident per frame, consecutive-hit streak, cooldown, alert records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse.functions.scalars import round_even
from roadpulse.operators.boxes import incident_filter
from roadpulse.operators.scan import Fold, ordered_scan
from roadpulse.session import HOT_ROWS

# A camera's rows are brought together by spans of this length.
STREAK_CHUNK_SECONDS = 86_400


def incident_best(boxes: DataFrame, frame_key: list[str], order: str) -> DataFrame:
    """Number of incident boxes per frame and the most confident one with its box, the first on a tie."""
    kept = incident_filter(boxes).withColumn("bbox", F.array("x1", "y1", "x2", "y2"))
    best = F.max_by(F.struct("class_name", "conf", "bbox"), F.struct(F.col("conf"), (-F.col(order)).alias("o")))
    counted = kept.groupBy(*frame_key).agg(F.count(F.lit(1)).alias("num_detections"), best.alias("b"))
    return counted.select(*frame_key, "num_detections", "b.class_name", "b.conf", "b.bbox")


def detect_report(frames: DataFrame, boxes: DataFrame, confidence: float = K.REPORT_CONFIDENCE) -> DataFrame:
    """One row per image, with or without incidents: its best box, and all of its boxes in order.

    The list is bounded by the boxes of one image.
    """
    kept = boxes.filter(F.col("conf") >= confidence)
    best = incident_best(kept, ["frame_id"], "box")
    entry = F.struct("box", "class_name", "conf", "bbox")
    listed = detect_report_boxes(boxes, confidence).groupBy("frame_id").agg(F.array_sort(F.collect_list(entry)).alias("detections"))
    count = F.coalesce("num_detections", F.lit(0))
    none = F.array().cast(listed.schema["detections"].dataType)
    return frames.join(best, "frame_id", "left").join(listed, "frame_id", "left").select(
        "frame_id", (count > 0).alias("accident_detected"), count.alias("num_detections"),
        F.col("img_w").alias("width"), F.col("img_h").alias("height"),
        F.lit(confidence).alias("confidence_threshold"), "class_name", "conf", "bbox",
        F.coalesce("detections", none).alias("detections"),
    )


def detect_report_boxes(boxes: DataFrame, confidence: float = K.REPORT_CONFIDENCE) -> DataFrame:
    """The incident boxes behind ``detect_report``, one per row so that no frame is gathered whole."""
    kept = incident_filter(boxes.filter(F.col("conf") >= confidence))
    return kept.select("frame_id", "box", "class_name", "conf", F.array("x1", "y1", "x2", "y2").alias("bbox"))


def incident_series(frames: DataFrame, camera_edges: DataFrame, confidence: float = K.ACCIDENT_CONFIDENCE) -> DataFrame:
    """Processed frames of cameras that have edges, flagged as hit or normal.

    Frames that could not be fetched (no class) take no part and leave the streak as it is.
    """
    hit = F.col("class_name").isin(*K.INCIDENT_CLASSES) & (F.col("conf") >= confidence)
    eligible = camera_edges.select("cam").distinct()
    return frames.filter(F.col("class_name").isNotNull()).join(eligible, "cam", "left_semi").withColumn("hit", hit)


def streak_step(state: tuple | None, t: int, hit: bool) -> tuple[tuple | None, tuple]:
    """Streaks row by row, for streams. State: (hits so far, time of the last hit)."""
    if not hit:
        return None, (0,)
    live = state is not None and t - state[1] < K.STREAK_TTL
    now = (state[0] + 1, t) if live else (1, t)
    return now, (now[0],)


def cooldown_step(state: tuple | None, t: int) -> tuple[tuple, tuple]:
    """State: (time of the last alert,)."""
    fires = state is None or t - state[0] >= K.ALERT_COOLDOWN
    return ((t,) if fires else state), (fires,)


COOLDOWN_FOLD = Fold(
    inputs=(),
    outputs="fires boolean",
    step=cooldown_step,
    entry_states=lambda t: {age: (t - age,) for age in range(K.ALERT_COOLDOWN)},
    entry_label=lambda state, t: t - state[0] if t - state[0] < K.ALERT_COOLDOWN else None,
)


def incident_streak(series: DataFrame, chunk_seconds: int = STREAK_CHUNK_SECONDS) -> DataFrame:
    """Consecutive hits per camera; a normal frame or a gap since the last hit starts over.

    Streaks are islands of hits. They are counted within chunks of a camera's time, so that a hot camera is
    spread over tasks; how far a chunk's first island is already is worked out on one row per chunk.
    """
    chunked = series.withColumn("chunk", F.expr(f"t div {chunk_seconds}L"))
    order = W.partitionBy("cam", "chunk").orderBy("t", "event_id")
    goes_on = F.col("hit") & F.lag("hit").over(order) & (F.col("t") - F.lag("t").over(order) < K.STREAK_TTL)
    marked = chunked.withColumn("island", F.sum(F.when(goes_on, 0).otherwise(1)).over(order))
    island = W.partitionBy("cam", "chunk", "island").orderBy("t", "event_id")
    counted = marked.withColumn("own", F.when(F.col("hit"), F.row_number().over(island)).otherwise(0))

    first, last = F.struct("t", "event_id"), F.struct("t", "event_id")
    chunks = counted.groupBy("cam", "chunk").agg(
        F.min("t").alias("first_t"), F.min_by("hit", first).alias("first_hit"), F.max("t").alias("last_t"),
        F.max_by("own", last).alias("exit"), (F.max("island") == 1).alias("single"),
    )
    line = W.partitionBy("cam").orderBy("chunk")
    entered = F.col("first_hit") & (F.lag("exit").over(line) > 0) & (F.col("first_t") - F.lag("last_t").over(line) < K.STREAK_TTL)
    chunks = chunks.withColumn("entered", F.coalesce(entered, F.lit(False)))
    # Chunks that are one island from end to end add up; any other one starts the sum anew.
    anew = ~(F.col("single") & F.col("entered"))
    before = line.rowsBetween(W.unboundedPreceding, -1)
    chunks = chunks.withColumn("sum", F.coalesce(F.sum("exit").over(before), F.lit(0)))
    base = F.last(F.when(anew, F.col("sum")), ignorenulls=True).over(before)
    carried = chunks.select("cam", "chunk", F.when(F.col("entered"), F.col("sum") - base).otherwise(0).alias("carry"))
    joined = counted.join(carried, ["cam", "chunk"])
    streak = F.col("own") + F.when(F.col("hit") & (F.col("island") == 1), F.col("carry")).otherwise(0)
    return joined.select(*series.columns, streak.cast("bigint").alias("streak"))


def alert_cooldown(streaks: DataFrame, hot_rows: int = HOT_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Hits that raise an alert: long enough streak and no alert of the camera within the cooldown.

    ``counted`` may name the series that ``streaks`` was made from, so that hot cameras are found without making it.
    """
    candidates = streaks.filter(F.col("streak") >= K.ALERT_STREAK)
    fired = ordered_scan(candidates, "cam", "t", "event_id", COOLDOWN_FOLD, hot_rows, counted)
    return fired.filter("fires").drop("fires")


def alert_edges(camera_edges: DataFrame) -> DataFrame:
    """Edge ids of a camera as numbers, in zone order."""
    zones = F.array_sort(F.collect_list(F.struct("ord", F.col("edge_id").cast("bigint").alias("e"))))
    mapped = camera_edges.filter(F.col("edge_id").isNotNull())
    return mapped.groupBy("cam").agg(zones.alias("z")).select("cam", F.col("z.e").alias("edge_ids"))


def join_location(alerts: DataFrame, cameras: DataFrame) -> DataFrame:
    """Place name of the camera: its id when unknown, empty when it has no description."""
    places = cameras.select("cam", F.coalesce("description", F.lit("")).alias("place"))
    location = F.coalesce("place", F.col("cam").cast("string"))
    return alerts.join(places, "cam", "left").withColumn("location", location).drop("place")


def alert_records(alerts: DataFrame, camera_edges: DataFrame, cameras: DataFrame) -> DataFrame:
    """Alerts with edges and location, in the published column layout."""
    full = join_location(alerts.join(alert_edges(camera_edges), "cam"), cameras)
    return full.select(
        F.col("cam").cast("string").alias("camId"), F.col("edge_ids").alias("edgeIds"),
        F.col("class_name").alias("className"), round_even("conf", 3).alias("confidence"),
        F.col("t").alias("ts"), "location",
    )


def suspect_catalog(series: DataFrame) -> DataFrame:
    """File name for every hit, whatever its streak."""
    name = F.format_string("%s_%d_%s_%.2f.jpg", F.col("cam").cast("string"), "t", "class_name", "conf")
    return series.filter("hit").select("cam", "event_id", "t", name.alias("file_name"))
