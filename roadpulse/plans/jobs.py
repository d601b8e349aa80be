"""Batch jobs from input tables to published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.scalars import round_even
from roadpulse.operators import calibration, edge_state, geometry, raster
from roadpulse.operators.metrics import meu_per_frame
from roadpulse.plans.traffic import RoadMask, frame_metrics
from roadpulse.session import materialize
from roadpulse.sources import cameras as cam_src
from roadpulse.sources import sinks

LIMITS = "cam bigint, meu_max double, or_max double, hci_max double"


def _stored(spark: SparkSession, path: str, before: int) -> DataFrame | None:
    version = sinks.latest_version(spark, path, before)
    return None if version is None else sinks.read_version(spark, path, version)


def calibration_job(
    frames: DataFrame, detections: DataFrame, coefficients: DataFrame, mask_path: str, limits_path: str, version: int
) -> DataFrame:
    """Learns road masks and load limits, publishes both and reports cameras with too few frames.

    The heatmap adds up over all versions; frame counts and largest loads are those of this run alone.
    """
    spark = frames.sparkSession
    stats = materialize(calibration.calibration_stats(meu_per_frame(frames, detections, coefficients)))
    cameras = frames.select(*raster.CAMERA).distinct()
    return _publish_calibration(spark, raster.heatmap(detections), stats, cameras, mask_path, limits_path, version)


def _publish_calibration(
    spark: SparkSession, heat: DataFrame, stats: DataFrame, cameras: DataFrame, mask_path: str, limits_path: str, version: int
) -> DataFrame:
    stored = _stored(spark, f"{mask_path}/heatmap", version)
    sinks.publish_version(heat if stored is None else raster.heatmap_merge(stored, heat), f"{mask_path}/heatmap", version)
    runs = raster.road_mask_of_counts(sinks.read_version(spark, f"{mask_path}/heatmap", version), stats.select("cam", "frames"))
    sinks.publish_version(runs, f"{mask_path}/runs", version)
    sinks.publish_version(cameras, f"{mask_path}/cameras", version)
    existing = _stored(spark, limits_path, version)
    existing = spark.createDataFrame([], LIMITS) if existing is None else existing
    sinks.publish_version(calibration.merge_thresholds(existing, stats), limits_path, version)
    return calibration.low_frame_preview(calibration.low_frame_cameras(stats))


def finish_calibration(spark: SparkSession, gathered: str, run: str, mask_path: str, limits_path: str, version: int) -> DataFrame:
    """Masks and limits from what ``stream_calibration`` has gathered in ``run``, and the report on cameras with few frames.

    The run's heat is added to that of the versions before; its frame counts and largest loads are its own, so the next
    run starts them anew. A repeated version adds nothing twice.
    """
    part = lambda name: spark.read.parquet(f"{gathered}/{name}/app={run}").drop("batch")
    heat = raster.heatmap_sum(part("heat"))
    stats = part("stats").groupBy(*raster.CAMERA).agg(F.sum("frames").alias("frames"), F.max("meu_max").alias("meu_max"))
    stats = materialize(stats)
    of_camera = stats.groupBy("cam").agg(F.sum("frames").alias("frames"), round_even(F.max("meu_max"), 2).alias("meu_max"))
    return _publish_calibration(spark, heat, materialize(of_camera), stats.select(*raster.CAMERA), mask_path, limits_path, version)


def load_mask(spark: SparkSession, mask_path: str) -> RoadMask:
    version = sinks.latest_version(spark, f"{mask_path}/cameras")
    return RoadMask(*(sinks.read_version(spark, f"{mask_path}/{part}", version) for part in ("runs", "cameras")))


def traffic_job(
    frames: DataFrame, detections: DataFrame, mask: RoadMask, coefficients: DataFrame, camera_edges: DataFrame,
    free_flow: DataFrame, thresholds: DataFrame, out: str, state_path: str, version: int, mode: str = "sequential",
    lateness: int | None = None,
) -> None:
    """Boxes to smoothed speed and status per edge, going on from the state before ``version``.

    ``frames`` carry their time ``t`` (and ``batch_id`` in batch mode). Results lie in
    ``out``/version=N, the state is published at ``state_path``; a repeated version gives the same. Late
    rows meet the stored state too; edges leave it only when ``lateness`` bounds how late rows can be.
    """
    spark = frames.sparkSession
    observed = frame_metrics(frames, detections, mask, coefficients).withColumnRenamed("frame_id", "event_id")
    series = edge_state.edge_series(observed, camera_edges, free_flow, thresholds)
    previous = _stored(spark, state_path, version)
    sinks.write_part(edge_state.speed_and_status(series, mode, previous=previous), out, version)
    state = edge_state.carried_state(spark.read.parquet(f"{out}/version={version}"), previous)
    sinks.publish_version(state if lateness is None else edge_state.expire_state(state, lateness), state_path, version)


def geometry_job(spark: SparkSession, cameras_path: str, out: str, multi_line: bool = False) -> DataFrame:
    """Writes the geometry of every mapped edge and reports the quality counters."""
    cameras = cam_src.read_cameras(spark, cameras_path, multi_line)
    zones = cam_src.camera_zones(cameras).withColumn("ord", F.struct("ordinal", "ord"))
    sinks.write_geometry(geometry.edge_geometry(zones), out)
    return geometry.geometry_stats(zones).withColumn("cameras", F.lit(cameras.count()).cast("bigint"))
