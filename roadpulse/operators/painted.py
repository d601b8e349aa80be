"""Load and road occupancy of frames, painted: boxes and frames are shuffled once, by frame, and walked in order.

A task holds the boxes of one frame and the part of its image that they touch; frames with more boxes than a task should
hold go to ``raster.occupancy_precise``, which splits them. Results equal those of ``raster`` and ``metrics`` to the last bit: counts of pixels and sums of decimals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.raster import CAMERA
from roadpulse.session import is_small

# Mask runs that are sent to every task, some 40 bytes each; cameras of a city have fewer.
MASK_RUNS = 1_000_000
SIDES = ("x1", "y1", "x2", "y2")


@dataclass
class Roads:
    """Road runs of every covered image shape, painted when first asked for."""

    runs: dict[tuple[int, int, int], np.ndarray]
    cameras: set[int]
    painted: dict[tuple[int, int, int], tuple[np.ndarray, int]] = field(default_factory=dict)

    def of(self, cam: int, h: int, w: int) -> tuple[np.ndarray | None, int] | None:
        """(road pixels, their number); no pixels for a camera without mask, None for a shape its masks don't have."""
        if cam not in self.cameras:
            return None, h * w
        if (cam, h, w) not in self.runs:
            return None
        if (cam, h, w) not in self.painted:
            road = np.zeros((h, w), bool)
            for y, xs, xe in self.runs[cam, h, w].tolist():
                road[y, xs:xe] = True
            self.painted[cam, h, w] = road, int(road.sum())
        return self.painted[cam, h, w]


def collect_roads(runs: DataFrame, cameras: DataFrame) -> Roads | None:
    """The masks for the driver, when counted to be at most ``MASK_RUNS``; both are stored tables."""
    if not is_small(runs, MASK_RUNS) or not is_small(cameras, MASK_RUNS):
        return None
    held = {tuple(r): np.zeros((0, 3), np.int64) for r in cameras.select(*CAMERA).distinct().collect()}
    table = runs.select(*CAMERA, "y", "xs", "xe").toPandas()
    for key, own in table.groupby(CAMERA):
        if key in held:
            held[key] = own[["y", "xs", "xe"]].to_numpy(np.int64)
    return Roads(held, {cam for cam, _, _ in held})


def covered(image: tuple[int, int, int], boxes: np.ndarray, roads: Roads) -> float | None:
    """Percent of an image's road pixels under ``boxes``; None for an image that doesn't fit its camera's masks."""
    found = roads.of(*image)
    if found is None:
        return None
    (road, area), (_, h, w) = found, image
    if not len(boxes) or not area or h <= 0 or w <= 0:
        return 0.0
    edges = np.clip(np.rint(boxes), 0, (w - 1, h - 1, w - 1, h - 1)).astype(np.int64)
    edges = edges[(edges[:, 2] > edges[:, 0]) & (edges[:, 3] > edges[:, 1])]
    if not len(edges):
        return 0.0
    (left, top), (right, bottom) = edges[:, :2].min(axis=0).tolist(), edges[:, 2:].max(axis=0).tolist()
    part = np.zeros((bottom - top, right - left), bool)
    for x1, y1, x2, y2 in (edges - (left, top, left, top)).tolist():
        part[y1:y2, x1:x2] = True
    hit = np.count_nonzero(part if road is None else part & road[top:bottom, left:right])
    return float(hit) / float(area) * 100


def painted_metrics(frames: DataFrame, detections: DataFrame, roads: Roads, coefficients: DataFrame) -> DataFrame:
    """``frames`` with ``meu`` and ``occupancy``. Boxes of no frame are left out; a frame without boxes has zeros."""
    weights = {r["cls"]: int(r["units"]) for r in coefficients.select("cls", (F.col("coef").cast("decimal(10,3)") * 1000).cast("bigint").alias("units")).collect()}  # a row per vehicle class
    names = frames.columns
    own = frames.select(*names, F.lit(0).alias("kind"))
    boxes = detections.select("frame_id", "cls", *[F.col(c).cast("double").alias(c) for c in SIDES], F.lit(1).alias("kind"))
    rows = own.unionByName(boxes, allowMissingColumns=True).repartition("frame_id").sortWithinPartitions("frame_id", "kind")

    def paint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []  # the last frame's row and its boxes so far
        for batch in batches:
            ids = batch.column("frame_id").to_numpy(zero_copy_only=False)
            if kept and ids[0] == kept[-1].column("frame_id")[-1].as_py():
                cut = int(np.searchsorted(ids, ids[0], "right"))
                kept.append(batch.slice(0, cut))
                batch, ids = batch.slice(cut), ids[cut:]
                if not len(ids):
                    continue
            if kept:
                yield from done(kept)
            last = int(np.searchsorted(ids, ids[-1], "left"))
            kept = [batch.slice(last)]
            if last:
                yield from done([batch.slice(0, last)])
        if kept:
            yield from done(kept)

    def done(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(parts).combine_chunks()
        kind = whole.column("kind").to_numpy()
        ids = whole.column("frame_id").to_numpy()
        frame_rows, box_rows = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
        if not len(frame_rows):
            return
        held = whole.take(pa.array(frame_rows))
        cls = whole.column("cls").take(pa.array(box_rows)).to_pylist()
        units = np.fromiter((weights.get(c, 0) for c in cls), np.int64, len(cls))
        sides = [whole.column(c).take(pa.array(box_rows)) for c in SIDES]
        there = ~np.any([np.asarray(s.is_null()) for s in sides], axis=0) if len(box_rows) else np.zeros(0, bool)
        # Spark's least and greatest take NaN for the largest number.
        values = np.column_stack([np.nan_to_num(s.to_numpy(), nan=np.inf, posinf=np.inf, neginf=-np.inf) for s in sides]) if len(box_rows) else np.zeros((0, 4))
        box_ids, total = ids[box_rows], np.concatenate(([0], np.cumsum(units)))
        first, end = np.searchsorted(box_ids, ids[frame_rows], "left"), np.searchsorted(box_ids, ids[frame_rows], "right")
        images = zip(*(held.column(c).to_pylist() for c in CAMERA))
        occupancy = [covered(image, values[a:b][there[a:b]], roads) for image, a, b in zip(images, first.tolist(), end.tolist())]
        meu = (total[end] - total[first]) / 1000.0
        out = held.select(names).append_column("meu", pa.array(meu)).append_column("occupancy", pa.array(occupancy, pa.float64()))
        yield from out.combine_chunks().to_batches()

    kinds = dict(frames.dtypes)
    return rows.mapInArrow(paint, ", ".join([f"`{c}` {kinds[c]}" for c in names] + ["meu double", "occupancy double"]))
