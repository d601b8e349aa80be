"""Pixel sets without pixel rows.

A set of pixels in a frame or a mask is stored as 64-pixel words: one row (y, word) holds the bits of
pixels 64*word .. 64*word+63 of image row y. Union is ``bit_or``, intersection a bitwise and on an
equi-join, area a bit count; all are built-in aggregates that combine before any shuffle.

Heatmaps are sums of box indicators, kept as runs (y, xs, xe, hits). Each box contributes four corner
differences, so the large input collapses to at most one row per pixel of a camera before the shuffle,
and two running sums bounded by the image size restore the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse.functions.scalars import col
from roadpulse.operators.boxes import clip_boxes_px
from roadpulse.session import HOT_ROWS, broadcast_if_small, is_small, split_hot, tasks_for

CAMERA = ["cam", "img_h", "img_w"]
# Image rows of road masks that are broadcast: some 2,000 cameras of 500 rows, about 100 bytes each.
MASK_BROADCAST_ROWS = 1_000_000
# Boxes that one task covers; sorting them, their bands and their words take about 2 kB a box.
TASK_BOXES = 200_000


def _word_bits(xs: Column, xe: Column, word: Column) -> Column:
    """Bits of the half-open range xs .. xe that fall into one word."""
    low = F.greatest(xs - word * 64, F.lit(0))
    unused = 64 - F.least(xe - word * 64, F.lit(64))
    from_low = F.call_function("shiftleft", F.lit(-1).cast("bigint"), low.cast("int"))
    to_high = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), unused.cast("int"))
    return from_low.bitwiseAND(to_high)


def _explode_words(ranges: DataFrame, keep: list[str], xs: str, xe: str) -> DataFrame:
    """Rows (keep, word, bits) of x ranges."""
    last = F.shiftright(F.col(xe) - 1, 6)
    words = ranges.withColumn("word", F.explode(F.sequence(F.shiftright(F.col(xs), 6), last)))
    return words.select(*keep, "word", _word_bits(F.col(xs), F.col(xe), F.col("word")).alias("bits"))


def _cover(boxes: DataFrame, keep: list[str]) -> DataFrame:
    """Words covered by boxes: the bits are made once per box and repeated down its rows."""
    words = _explode_words(boxes, [*keep, "y1", "y2"], "x1", "x2")
    rows = words.select(*keep, F.explode(F.sequence(F.col("y1"), F.col("y2") - 1)).alias("y"), "word", "bits")
    return rows.groupBy(*keep, "y", "word").agg(F.bit_or("bits").alias("bits"))


def _cover_bands(boxes: DataFrame, keep: list[str]) -> DataFrame:
    """As ``_cover``, for boxes that lie together by frame.

    The upper and lower edges of a frame's boxes cut it into bands inside which coverage does not change
    from row to row. The union is taken per band, and only its result is repeated down the rows. A frame
    has at most one edge per image row, so this never makes more rows than ``_cover``.
    """
    frame = W.partitionBy("frame_id")
    edges = F.array_sort(F.array_union(F.collect_set("y1").over(frame), F.collect_set("y2").over(frame)))
    cuts = F.filter("edges", lambda e: (e >= F.col("y1")) & (e <= F.col("y2")))
    cut = boxes.withColumn("edges", edges).withColumn("cuts", cuts)
    count = F.size("cuts") - 1
    bands = F.arrays_zip(F.slice("cuts", 1, count).alias("y"), F.slice("cuts", 2, count).alias("y_end"))
    ranges = cut.select(*keep, "x1", "x2", F.inline(bands))
    words = _explode_words(ranges, [*keep, "y", "y_end"], "x1", "x2")
    union = words.groupBy(*keep, "y", "y_end", "word").agg(F.bit_or("bits").alias("bits"))
    return union.select(*keep, F.explode(F.sequence(F.col("y"), F.col("y_end") - 1)).alias("y"), "word", "bits")


def vehicle_words(detections: DataFrame, hot_rows: int = HOT_ROWS, bucketed: bool = False) -> DataFrame:
    """Pixels covered by at least one box, per frame, as words.

    Boxes of ordinary frames are first brought together by frame, so that only boxes (not their far
    larger pixel rows) are shuffled and all later grouping by frame stays local; the number of tasks follows that of the
    boxes, so that a task's memory does not grow with them. Frames with more than
    ``hot_rows`` boxes are covered where their boxes lie; their words combine before the shuffle and
    number at most one per word of the image and task. A table ``bucketed`` by frame_id needs no shuffle
    at all.
    """
    keep = ["frame_id", *CAMERA]
    boxes = clip_boxes_px(detections).select(*keep, "x1", "y1", "x2", "y2")
    ordinary, hot, _ = split_hot(boxes, "frame_id", hot_rows, counted=detections)
    if not bucketed:
        ordinary = ordinary.repartition(tasks_for(detections, TASK_BOXES), "frame_id")
    cover = _cover_bands(ordinary, keep)
    return cover if hot is None else cover.unionByName(_cover(hot, keep))


# ---- heatmaps ----
def _running(df: DataFrame, along: str, group: list[str], value: str) -> DataFrame:
    """Running sum of differences; ``until`` is the next position in the group."""
    order = W.partitionBy(*group).orderBy(along)
    return df.withColumns({"level": F.sum(value).over(order), "until": F.lead(along).over(order)})


def _row_runs(differences: DataFrame) -> DataFrame:
    """Runs of equal positive hits from per-row differences (y, x, d), one row per position."""
    runs = _running(differences, "x", [*CAMERA, "y"], "d").filter(F.col("level") > 0)
    return runs.select(*CAMERA, "y", F.col("x").alias("xs"), F.col("until").alias("xe"), F.col("level").alias("hits"))


def heatmap(detections: DataFrame) -> DataFrame:
    """How many boxes cover each pixel of each camera, as runs (y, xs, xe, hits)."""
    corner = lambda y, x, d: F.struct(F.col(y).alias("y"), F.col(x).alias("x"), F.lit(d).alias("d"))
    corners = F.array(corner("y1", "x1", 1), corner("y1", "x2", -1), corner("y2", "x1", -1), corner("y2", "x2", 1))
    differences = (
        clip_boxes_px(detections).select(*CAMERA, F.inline(corners))
        .groupBy(*CAMERA, "y", "x").agg(F.sum("d").alias("d")).filter(F.col("d") != 0)
    )
    columns = _running(differences, "y", [*CAMERA, "x"], "d").filter(F.col("level") != 0)
    rows = columns.select(
        *CAMERA, F.explode(F.sequence(F.col("y"), F.col("until") - 1)).alias("y"), "x", F.col("level").alias("d")
    )
    return _row_runs(rows)


def heatmap_merge(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Sum of two heatmaps."""
    return heatmap_sum(stored.unionByName(new))


def heatmap_sum(both: DataFrame) -> DataFrame:
    """Sum of any number of heatmaps, all in one table."""
    step = lambda x, sign: F.struct(F.col(x).alias("x"), (sign * F.col("hits")).alias("d"))
    differences = (
        both.select(*CAMERA, "y", F.inline(F.array(step("xs", 1), step("xe", -1))))
        .groupBy(*CAMERA, "y", "x").agg(F.sum("d").alias("d")).filter(F.col("d") != 0)
    )
    return _row_runs(differences)


def heatmap_normalized(runs: DataFrame) -> DataFrame:
    """Hits scaled to 0..255 per camera; pixels never hit count towards the minimum."""
    area = F.col("img_h") * F.col("img_w")
    span = F.col("xe") - F.col("xs")
    limits = runs.groupBy(*CAMERA).agg(
        F.max("hits").alias("max_hits"), F.min("hits").alias("min_run"), F.sum(span).alias("covered")
    )
    limits = limits.withColumn("min_hits", F.when(F.col("covered") < area, F.lit(0)).otherwise(F.col("min_run")))
    scale = F.coalesce(F.try_divide(F.lit(255.0), (F.col("max_hits") - F.col("min_hits")).cast("double")), F.lit(0.0))
    level = F.rint(F.col("hits") * scale + (F.lit(0.0) - F.col("min_hits") * scale)).cast("int")
    return runs.join(limits, CAMERA).select(*runs.columns, level.alias("level"), "max_hits")


# ---- road masks ----
def road_mask(runs: DataFrame, threshold: Column | int = K.ROAD_HITS_DEFAULT) -> DataFrame:
    """Pixels hit at least ``threshold`` times, as maximal runs (y, xs, xe)."""
    kept = runs.filter(F.col("hits") >= col(threshold)).select(*CAMERA, "y", "xs", "xe")
    order = W.partitionBy(*CAMERA, "y").orderBy("xs")
    starts = kept.withColumn("starts", F.coalesce(F.col("xs") > F.lag("xe").over(order), F.lit(True)).cast("int"))
    islands = starts.withColumn("island", F.sum("starts").over(order))
    return (
        islands.groupBy(*CAMERA, "y", "island").agg(F.min("xs").alias("xs"), F.max("xe").alias("xe")).drop("island")
    )


def road_mask_calibrated(runs: DataFrame, frames: DataFrame) -> DataFrame:
    """Road mask whose threshold is a share of the frames processed for the camera."""
    return road_mask_of_counts(runs, frames.groupBy("cam").agg(F.count(F.lit(1)).alias("frames")))


def road_mask_of_counts(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """As ``road_mask_calibrated``, from the number of ``frames`` of each camera."""
    needed = F.greatest(F.lit(1.0), F.rint(F.col("frames") * K.ROAD_FRAME_RATIO))
    limits = counts.select("cam", needed.alias("needed"))
    return road_mask(runs.join(limits, "cam"), F.col("needed"))


def full_rows(cameras: DataFrame) -> DataFrame:
    """Every pixel of an image (cam, img_h, img_w) as runs."""
    return cameras.select(
        *CAMERA, F.explode(F.sequence(F.lit(0), F.col("img_h") - 1)).alias("y"), F.lit(0).alias("xs"), F.col("img_w").alias("xe")
    )


def mask_default(mask: DataFrame, cameras: DataFrame) -> DataFrame:
    """Masks of all cameras; the whole image is road where a camera has no mask."""
    missing = cameras.select(*CAMERA).join(mask.select(*CAMERA).distinct(), CAMERA, "left_anti")
    return mask.unionByName(full_rows(missing))


def mask_rows(mask: DataFrame) -> DataFrame:
    """Road pixels per image row, as a map from word number to bits.

    One row per image row keeps the table small enough to broadcast for a city's cameras; the map has
    one entry per 64 pixels of width.
    """
    words = _explode_words(mask, [*CAMERA, "y"], "xs", "xe").groupBy(*CAMERA, "y", "word").agg(F.bit_or("bits").alias("bits"))
    entries = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    return words.groupBy(*CAMERA, "y").agg(entries.alias("road"))


def _on_road(words: DataFrame, mask: DataFrame) -> DataFrame:
    """``words`` with the bits of its pixels that are road."""
    rows = broadcast_if_small(mask_rows(mask), MASK_BROADCAST_ROWS)
    road = F.coalesce(F.try_element_at("road", F.col("word")), F.lit(0).cast("bigint"))
    joined = words.join(rows, [*CAMERA, "y"], "left")
    return joined.withColumn("on_road", F.col("bits").bitwiseAND(road)).drop("road")


def road_area(mask: DataFrame, cameras: DataFrame) -> DataFrame:
    """Road pixels of every camera in ``cameras``, zero for a camera whose mask is empty."""
    areas = mask.groupBy(*CAMERA).agg(F.sum(F.col("xe") - F.col("xs")).alias("road_px"))
    return cameras.select(*CAMERA).join(areas, CAMERA, "left").fillna(0, ["road_px"])


def road_ratio(mask: DataFrame, cameras: DataFrame) -> DataFrame:
    """Share of the image that is road, in percent."""
    ratio = F.try_divide(F.col("road_px").cast("double"), (F.col("img_h") * F.col("img_w")).cast("double")) * 100
    return road_area(mask, cameras).select("cam", ratio.alias("road_ratio"))


def mask_and(words: DataFrame, mask: DataFrame) -> DataFrame:
    """Vehicle words cut down to the road; ``mask`` is in run form."""
    cut = _on_road(words, mask).filter(F.col("on_road") != 0)
    return cut.select("frame_id", *CAMERA, "y", "word", F.col("on_road").alias("bits"))


def occupancy_precise(
    frames: DataFrame, detections: DataFrame, mask: DataFrame, masked: DataFrame, hot_rows: int = HOT_ROWS,
    bucketed: bool = False,
) -> DataFrame:
    """Percent of road pixels covered by vehicles, per frame.

    ``masked`` lists the cameras that have a mask (it may be empty: then nothing is road); frames of
    other cameras are measured against the whole image. A frame of another shape than its camera's mask
    can't be measured and has a null occupancy. Frames without boxes give 0. Both mask
    tables should be stored tables, because their size decides how they are joined. ``bucketed`` says
    that ``detections`` is a table bucketed by frame_id; bucket ``frames`` alike to join without a shuffle.
    """
    covered = _on_road(vehicle_words(detections, hot_rows, bucketed), mask).groupBy("frame_id").agg(
        F.sum(F.bit_count("bits")).alias("all_px"), F.sum(F.bit_count("on_road")).alias("on_road_px")
    )
    areas = road_area(mask, masked)
    areas = F.broadcast(areas) if is_small(masked) else areas
    has_mask = masked.select("cam", F.lit(True).alias("has_mask")).distinct()
    has_mask = F.broadcast(has_mask) if is_small(masked) else has_mask
    joined = frames.join(covered, "frame_id", "left").join(areas, CAMERA, "left").join(has_mask, "cam", "left")
    hit = F.when(F.col("road_px").isNull(), F.col("all_px")).otherwise(F.col("on_road_px")).cast("double")
    area = F.coalesce(F.col("road_px"), F.col("img_h") * F.col("img_w")).cast("double")
    occupancy = F.coalesce(F.try_divide(hit, area) * 100, F.lit(0.0))
    fits = F.col("road_px").isNotNull() | F.col("has_mask").isNull()
    return joined.select(*frames.columns, F.when(fits, occupancy).alias("occupancy"))
