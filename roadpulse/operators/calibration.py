"""Calibration: load limits and frame counts per camera."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse.functions.scalars import round_even
from roadpulse.session import materialize


def calibration_stats(frame_loads: DataFrame) -> DataFrame:
    """Processed frames and largest load per camera, from one row per frame (cam, meu)."""
    return frame_loads.groupBy("cam").agg(F.count(F.lit(1)).alias("frames"), round_even(F.max("meu"), 2).alias("meu_max"))


def merge_thresholds(existing: DataFrame, stats: DataFrame) -> DataFrame:
    """New load limits over the stored ones; other limits and cameras not seen are kept."""
    new = stats.select("cam", F.col("meu_max").alias("new_max"))
    merged = existing.join(new, "cam", "full_outer")
    return merged.select("cam", F.coalesce("new_max", "meu_max").alias("meu_max"), "or_max", "hci_max")


def low_frame_cameras(stats: DataFrame, minimum: int = K.MIN_RELIABLE_FRAMES) -> DataFrame:
    return stats.filter(F.col("frames") < minimum).select(F.col("cam").cast("string").alias("cam_id"), "frames")


def low_frame_preview(low: DataFrame, shown: int = K.PREVIEW_CAMERAS) -> DataFrame:
    """One report line: number of such cameras and the first ids in text order."""
    low = materialize(low.select("cam_id"))
    first = low.orderBy("cam_id").limit(shown)
    total = low.agg(F.count(F.lit(1))).scalar()
    ids = F.array_join(F.array_sort(F.collect_list("cam_id")), ", ")
    listed = first.agg(ids.alias("ids"))
    return listed.select(total.alias("n_low"), F.concat("ids", F.when(total > shown, "...").otherwise("")).alias("preview"))
