"""Composed jobs: calibration, frame metrics, edge speeds, accident alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse.functions.scalars import greenshields_speed, traffic_weight
from roadpulse.operators import accident, painted, raster
from roadpulse.operators.metrics import join_thresholds, meu_per_frame
from roadpulse.session import HOT_ROWS, broadcast_if_small, hot_keys, materialize


@dataclass(frozen=True)
class RoadMask:
    """Road runs and the cameras they cover; a covered camera may have no road at all."""

    runs: DataFrame
    cameras: DataFrame


def calibrate_mask(frames: DataFrame, detections: DataFrame) -> RoadMask:
    """Road masks learnt from accumulated boxes, stored for the jobs that use them."""
    runs = raster.road_mask_calibrated(raster.heatmap(detections), frames)
    return RoadMask(materialize(runs), materialize(frames.select(*raster.CAMERA).distinct()))


def frame_metrics(frames: DataFrame, detections: DataFrame, mask: RoadMask, coefficients: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Load and road occupancy of every frame.

    Frames are painted, which shuffles boxes once. Those with over ``hot_rows`` boxes, and all of them when the masks
    are too many to send to every task, are measured by pixel words, which combine before the shuffle.
    """
    roads = painted.collect_roads(mask.runs, mask.cameras)
    hot = None if roads is None else hot_keys(detections, "frame_id", hot_rows)
    if roads is not None and hot is None:
        return painted.painted_metrics(frames, detections, roads, coefficients).withColumnRenamed("occupancy", "occ")
    if roads is None:
        return _by_words(frames, detections, mask, coefficients)
    ids = broadcast_if_small(hot.select("frame_id"))
    part = lambda df, how: df.join(ids, "frame_id", how)
    ordinary = painted.painted_metrics(part(frames, "left_anti"), part(detections, "left_anti"), roads, coefficients)
    crowded = _by_words(part(frames, "left_semi"), part(detections, "left_semi"), mask, coefficients)
    return ordinary.withColumnRenamed("occupancy", "occ").select(*crowded.columns).unionByName(crowded)


def road_occupancy(frames: DataFrame, detections: DataFrame, mask: RoadMask) -> DataFrame:
    """``frames`` with the percent of road pixels that are covered; measured as in ``frame_metrics``."""
    none = frames.sparkSession.createDataFrame([], "cls int, coef decimal(10,3)")
    return frame_metrics(frames, detections, mask, none).withColumnRenamed("occ", "occupancy").drop("meu")


def _by_words(frames: DataFrame, detections: DataFrame, mask: RoadMask, coefficients: DataFrame) -> DataFrame:
    loads = meu_per_frame(frames, detections, coefficients)
    return raster.occupancy_precise(loads, detections, mask.runs, mask.cameras).withColumnRenamed("occupancy", "occ")


def frame_speeds(
    frames: DataFrame, detections: DataFrame, mask: RoadMask, coefficients: DataFrame, thresholds: DataFrame,
    free_flow: float = K.FREE_FLOW_DEFAULT_KMH,
) -> DataFrame:
    """Occupancy, load, density and unsmoothed speed of every frame."""
    rows = join_thresholds(frame_metrics(frames, detections, mask, coefficients), thresholds)
    rows = rows.withColumn("twf", traffic_weight("occ", "meu", "meu_max"))
    return rows.withColumn("raw_speed", greenshields_speed(F.lit(free_flow), "twf"))


def accident_alerts(frames: DataFrame, camera_edges: DataFrame, cameras: DataFrame, confidence: float) -> DataFrame:
    """Published alert records from a series of frames with their best detection."""
    series = accident.incident_series(frames, camera_edges, confidence)
    alerts = accident.alert_cooldown(accident.incident_streak(series), counted=series)
    return accident.alert_records(alerts, camera_edges, cameras)
