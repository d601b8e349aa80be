"""Occupancy and load of frames that come with their boxes in one row, without any shuffle of boxes.

A frame's boxes are painted into its own image, so nothing is grouped and the work is the same in a batch and on a
stream. Results equal those of the batch operators to the last bit: both are counts of pixels and sums of decimals.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.painted import collect_roads
from roadpulse.operators.raster import CAMERA
from roadpulse.plans.traffic import RoadMask

# Masks that a task keeps decoded.
KEPT_MASKS = 256


def mask_per_camera(mask: RoadMask) -> DataFrame:
    """(cam, masks): every covered camera's image shapes with their road runs, which may be none."""
    runs = mask.runs.groupBy(*CAMERA).agg(F.collect_list(F.struct("y", "xs", "xe")).alias("runs"))
    shapes = mask.cameras.select(*CAMERA).distinct().join(runs, CAMERA, "left")
    empty = F.array().cast(runs.schema["runs"].dataType)
    return shapes.groupBy("cam").agg(F.collect_list(F.struct("img_h", "img_w", F.coalesce("runs", empty).alias("runs"))).alias("masks"))


def _pixels(sides: np.ndarray, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first and last pixel edges of all boxes of a batch, which of them cover any pixel); ``h`` and ``w`` are their images'."""
    edges = np.clip(np.rint(sides), 0, np.column_stack((w, h, w, h)) - 1).astype(np.int64)
    return edges, (edges[:, 2] > edges[:, 0]) & (edges[:, 3] > edges[:, 1])


def _paint(h: int, w: int, edges: list[list[int]]) -> np.ndarray:
    image = np.zeros((h, w), bool)
    for x1, y1, x2, y2 in edges:
        image[y1:y2, x1:x2] = True
    return image


def _road(h: int, w: int, runs: Iterable[tuple[int, int, int]]) -> np.ndarray:
    road = np.zeros((h, w), bool)
    for y, xs, xe in runs:
        road[y, xs:xe] = True
    return road


def occupancy(frames: DataFrame, mask: RoadMask) -> DataFrame:
    """``frames`` (schemas.FRAME) with ``occ`` in place of ``boxes``: percent of road pixels covered.

    Cameras that the mask doesn't know are measured against the whole image, a frame of another shape than its
    camera's masks can't be measured and has a null, and a frame without boxes or road gives 0. Masks that are counted
    small go to every task once; others come with each frame.
    """
    sent = collect_roads(mask.runs, mask.cameras)
    if sent is None:
        own = F.filter("masks", lambda m: (m["img_h"] == F.col("img_h")) & (m["img_w"] == F.col("img_w")))
        rows = frames.join(mask_per_camera(mask), "cam", "left")
        rows = rows.withColumn("has_mask", F.col("masks").isNotNull()).withColumn("runs", F.get(own, F.lit(0))["runs"]).drop("masks")
        rows = rows.select(*frames.columns, "has_mask", "runs")
    else:
        rows = frames
    kept = [c for c in frames.columns if c != "boxes"]
    kinds = dict(frames.dtypes)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roads: dict[tuple, tuple[np.ndarray, int]] = {}
        for batch in batches:
            flat = batch.column("boxes").flatten()
            sides = np.column_stack([flat.field(c).to_numpy(zero_copy_only=False) for c in ("x1", "y1", "x2", "y2")]).astype(float)
            ends = np.concatenate(([0], np.cumsum(np.nan_to_num(batch.column("boxes").value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))))
            tall, wide = (np.repeat(np.nan_to_num(batch.column(c).to_numpy(zero_copy_only=False)).astype(np.int64), np.diff(ends)) for c in ("img_h", "img_w"))
            edges, covers = _pixels(sides[: ends[-1]], tall, wide)
            found = []
            places = zip(*(batch.column(c).to_pylist() for c in CAMERA))
            masked = batch.column("has_mask").to_pylist() if sent is None else None
            for i, (cam, h, w) in enumerate(places):
                if sent is None:
                    has_mask, fits = masked[i], batch.column("runs")[i].is_valid
                else:
                    has_mask, fits = cam in sent.cameras, (cam, h, w) in sent.runs
                if has_mask and not fits:
                    found.append(None)
                    continue
                own = slice(ends[i], ends[i + 1])
                if own.start == own.stop or h <= 0 or w <= 0:
                    found.append(0.0)
                    continue
                image = _paint(h, w, edges[own][covers[own]].tolist())
                if not has_mask:
                    found.append(float(np.count_nonzero(image)) / float(h * w) * 100)
                    continue
                if (cam, h, w) not in roads:
                    if len(roads) >= KEPT_MASKS:
                        roads.clear()
                    runs = [(r["y"], r["xs"], r["xe"]) for r in batch.column("runs")[i].as_py()] if sent is None else sent.runs[cam, h, w].tolist()
                    road = _road(h, w, runs)
                    roads[cam, h, w] = road, int(road.sum())
                road, area = roads[cam, h, w]
                found.append(float(np.count_nonzero(image & road)) / float(area) * 100 if area else 0.0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found, pa.float64())], names=[*kept, "occ"])

    schema = ", ".join([f"{c} {kinds[c]}" for c in kept] + ["occ double"])
    return rows.mapInArrow(measure, schema)


def load(coefficients: DataFrame) -> Column:
    """Column: sum of unit weights of ``boxes``; summed as decimals, so their order does not matter."""
    weights = {r["cls"]: r["coef"] for r in coefficients.select("cls", F.col("coef").cast("decimal(10,3)").alias("coef")).collect()}  # one row per vehicle class
    total = F.lit(0).cast("decimal(20,3)")
    weight = F.create_map(*[F.lit(v) for pair in weights.items() for v in pair]) if weights else F.create_map().cast("map<int,decimal(10,3)>")
    of_box = lambda b: F.coalesce(F.try_element_at(weight, b["cls"]), F.lit(0).cast("decimal(10,3)"))
    return F.aggregate("boxes", total, lambda sum_, b: (sum_ + of_box(b)).cast("decimal(20,3)")).cast("double")


def measured(frames: DataFrame, mask: RoadMask, coefficients: DataFrame) -> DataFrame:
    """``frames`` with ``meu`` and ``occ`` in place of ``boxes``; a frame whose ``boxes`` are null has none."""
    rows = frames.withColumn("boxes", boxes_or_none(frames)).withColumn("meu", load(coefficients))
    return occupancy(rows, mask)


def boxes_or_none(frames: DataFrame) -> Column:
    return F.coalesce("boxes", F.array().cast(frames.schema["boxes"].dataType))
