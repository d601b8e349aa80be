"""Word and run rasters against dense arrays."""

import random

import numpy as np
import pytest
from helpers import rows_of

from roadpulse.operators import raster
from roadpulse.session import materialize
from roadpulse.sources import sinks

H, W = 30, 150
BOX = "frame_id bigint, cam bigint, img_h int, img_w int, x1 double, y1 double, x2 double, y2 double"
FRAME = "frame_id bigint, cam bigint, img_h int, img_w int"


def grid(value, size):
    return int(max(0, min(np.rint(value), size - 1)))


@pytest.fixture(scope="module")
def boxes():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        frame = 0 if i % 3 == 0 else int(rng.integers(1, 40))  # frame 0 holds a third of all boxes
        x, y = rng.integers(-40, 2 * W) / 2, rng.integers(-20, 2 * H) / 2
        rows.append((frame, frame % 3, H, W, float(x), float(y), float(x + rng.integers(0, 120) / 2), float(y + rng.integers(0, 24) / 2)))
    return rows


def dense(boxes, key):
    """Box counts per pixel, by frame (key 0) or camera (key 1)."""
    out = {}
    for row in boxes:
        hits = out.setdefault(row[key], np.zeros((H, W), int))
        x1, y1, x2, y2 = grid(row[4], W), grid(row[5], H), grid(row[6], W), grid(row[7], H)
        if x2 > x1 and y2 > y1:
            hits[y1:y2, x1:x2] += 1
    return out


def to_dense(runs, value=None):
    out = {}
    for r in runs.collect():
        image = out.setdefault(r.cam, np.zeros((H, W), int))
        assert not image[r.y, r.xs : r.xe].any(), "runs overlap"
        image[r.y, r.xs : r.xe] = 1 if value is None else r[value]
    return out


def test_heatmap_and_merge(spark, boxes):
    df = spark.createDataFrame(boxes, BOX)
    want = dense(boxes, 1)
    got = to_dense(raster.heatmap(df), "hits")
    assert all((got[c] == want[c]).all() for c in want)
    parts = [raster.heatmap(df.filter(f"frame_id % 3 = {i}")) for i in range(2)]
    merged = to_dense(raster.heatmap_merge(*parts), "hits")
    want = dense([b for b in boxes if b[0] % 3 < 2], 1)
    assert all((merged[c] == want[c]).all() for c in merged)


def test_normalized_heatmap_counts_the_minimum_over_all_pixels(spark):
    full = spark.createDataFrame([(1, y, 0, 4, 3) for y in range(2)], "cam bigint, y int, xs int, xe int, hits bigint")
    covered = full.selectExpr("cam", "2 img_h", "4 img_w", "y", "xs", "xe", "hits + y hits")
    assert sorted(r.level for r in raster.heatmap_normalized(covered).collect()) == [0, 255]
    partly = covered.filter("y = 1")
    assert [r.level for r in raster.heatmap_normalized(partly).collect()] == [255]
    flat = full.selectExpr("cam", "2 img_h", "4 img_w", "y", "xs", "xe", "hits")
    assert [r.level for r in raster.heatmap_normalized(flat).collect()] == [0, 0]


@pytest.mark.parametrize("hot_rows", [10**6, 50])
def test_occupancy_equals_dense_pixels(spark, boxes, hot_rows):
    df = spark.createDataFrame(boxes, BOX)
    frames = spark.createDataFrame([(i, i % 3, H, W) for i in range(45)], FRAME)  # 40..44 have no boxes
    heat = raster.heatmap(df)
    masked = frames.select(*raster.CAMERA).distinct().filter("cam <> 2")  # camera 2 has no mask
    mask = raster.road_mask(heat.filter("cam <> 2"), 4)
    got = {r.frame_id: r.occupancy for r in raster.occupancy_precise(frames, df, mask, masked, hot_rows).collect()}
    hits, cover = dense(boxes, 1), dense(boxes, 0)
    assert len(got) == 45
    for frame in range(45):
        road = np.ones((H, W), bool) if frame % 3 == 2 else hits[frame % 3] >= 4
        vehicles = cover.get(frame, np.zeros((H, W), int)) > 0
        assert got[frame] == pytest.approx((vehicles & road).sum() / road.sum() * 100, abs=1e-12)
        assert 0 <= got[frame] <= 100


def test_bucketed_tables_need_no_shuffle(spark, boxes, tmp_path):
    frames = spark.createDataFrame([(i, i % 3, H, W) for i in range(45)], FRAME)
    df = spark.createDataFrame(boxes, BOX)
    for name, rows in {"fr": frames, "bx": df}.items():
        sinks.write_bucketed(rows, f"bucketed_{name}", "frame_id", 4, str(tmp_path / name))
    cameras = frames.select(*raster.CAMERA).distinct()
    mask = materialize(raster.road_mask(raster.heatmap(df), 3))
    plain = raster.occupancy_precise(frames, df, mask, cameras)
    stored = raster.occupancy_precise(spark.table("bucketed_fr"), spark.table("bucketed_bx"), mask, cameras, bucketed=True)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(frame_id" not in plan
    assert "hashpartitioning(frame_id" in plain._jdf.queryExecution().executedPlan().toString()
    assert rows_of(stored, "frame_id") == rows_of(plain, "frame_id")
    for name in ("fr", "bx"):
        spark.sql(f"drop table bucketed_{name}")


def test_empty_mask_means_no_road(spark, boxes):
    df = spark.createDataFrame(boxes, BOX)
    frames = spark.createDataFrame([(i, i % 3, H, W) for i in range(40)], FRAME)
    nothing = raster.road_mask(raster.heatmap(df), 10**6)
    masked = frames.select(*raster.CAMERA).distinct()
    assert {r.occupancy for r in raster.occupancy_precise(frames, df, nothing, masked).collect()} == {0.0}
    assert {r.road_ratio for r in raster.road_ratio(nothing, masked).collect()} == {0.0}


def test_default_mask_covers_the_image(spark, boxes):
    df = spark.createDataFrame(boxes, BOX)
    cameras = spark.createDataFrame([(0, H, W), (9, H, W)], "cam bigint, img_h int, img_w int")
    mask = raster.mask_default(raster.road_mask(raster.heatmap(df.filter("cam = 0")), 2), cameras)
    got = to_dense(mask)
    assert got[9].all() and (got[0] == (dense(boxes, 1)[0] >= 2)).all()


def test_calibrated_threshold_rounds_half_to_even(spark):
    runs = spark.createDataFrame([(1, 1, 9, 0, 0, 1, 2), (1, 1, 9, 0, 2, 3, 1)], "cam long, img_h int, img_w int, y int, xs int, xe int, hits long")
    frames = spark.range(5).selectExpr("1L cam")  # 5 * 0.3 = 1.5 -> 2
    assert [(r.xs, r.xe) for r in raster.road_mask_calibrated(runs, frames).collect()] == [(0, 1)]


def test_mask_of_another_shape_gives_no_occupancy(spark):
    shape = "cam bigint, img_h int, img_w int"
    frames = spark.createDataFrame([(1, 1, 4, 4), (2, 1, 8, 8), (3, 2, 4, 4)], "frame_id bigint, " + shape)
    boxes = spark.createDataFrame([(f, c, n, n, 0, 0.9, 0.0, 0.0, 2.0, 2.0) for f, c, n in ((1, 1, 4), (2, 1, 8), (3, 2, 4))],
        "frame_id bigint, cam bigint, img_h int, img_w int, cls int, conf double, x1 double, y1 double, x2 double, y2 double")
    runs = spark.createDataFrame([(1, 4, 4, 0, 0, 4)], shape + ", y int, xs int, xe int")
    masked = spark.createDataFrame([(1, 4, 4)], shape)
    got = {r.frame_id: r.occupancy for r in raster.occupancy_precise(frames, boxes, runs, masked).collect()}
    assert got == {1: 50.0, 2: None, 3: 25.0}


@pytest.mark.parametrize("hot_rows", [10**6, 40, 3])
def test_painted_frames_equal_words(spark, hot_rows, monkeypatch):
    """Odd boxes, a crowded frame, an odd shape, missing and empty masks, boxes without a frame; batches that cut frames."""
    from roadpulse.operators import painted
    from roadpulse.plans import traffic
    from roadpulse.sources import dimensions as dim

    rng = random.Random(11)
    shapes = {0: (40, 70), 1: (40, 70), 2: (30, 130), 3: (40, 70)}
    frames = [(i, i % 4, *(shapes[i % 4] if i != 9 else (41, 70)), 10 * i) for i in range(80)] + [(12, 0, 40, 70, 121)]
    odd = [None, float("nan"), float("inf"), -1e300, 1e300, 0.5, 1.5, 2.5]
    boxes = []
    for i in [*range(70), *[5] * 60, 500, 501]:
        for _ in range(rng.randint(0, 5)):
            sides = [rng.choice(odd) if rng.random() < 0.1 else rng.uniform(-20, 80) for _ in range(4)]
            boxes.append((i, i % 4, *shapes[i % 4], rng.choice([0, 1, 2, 3, 4, None]), *sides))
    frame_df = spark.createDataFrame(frames, "frame_id long, cam long, img_h int, img_w int, t long").repartition(3)
    box_df = spark.createDataFrame(boxes, "frame_id long, cam long, img_h int, img_w int, cls int, x1 double, y1 double, x2 double, y2 double").repartition(5)
    runs = spark.createDataFrame([(c, 40, 70, y, 5 + c, 50 + y) for c in (0, 1) for y in range(20)], "cam long, img_h int, img_w int, y int, xs int, xe int")
    mask = traffic.RoadMask(runs, spark.createDataFrame([(c, 40, 70) for c in (0, 1, 3)], "cam long, img_h int, img_w int"))
    weights = dim.default_coefficients(spark)
    want = sorted(map(repr, traffic._by_words(frame_df, box_df, mask, weights).collect()))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (before, "7"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = traffic.frame_metrics(frame_df, box_df, mask, weights, hot_rows).select("frame_id", "cam", "img_h", "img_w", "t", "meu", "occ")
            assert sorted(map(repr, got.collect())) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    monkeypatch.setattr(painted, "MASK_RUNS", 3)
    assert sorted(map(repr, traffic.frame_metrics(frame_df, box_df, mask, weights).collect())) == want
    assert traffic.frame_metrics(frame_df.limit(0), box_df, mask, weights).count() == 0
    monkeypatch.setattr(painted, "MASK_RUNS", 1000)
    plan = traffic.frame_metrics(frame_df, box_df, mask, weights)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(frame_id") == 1


def test_tasks_follow_boxes(spark, boxes, monkeypatch):
    monkeypatch.setattr(raster, "TASK_BOXES", 20)
    words = raster.vehicle_words(spark.createDataFrame(boxes, BOX))
    assert words.rdd.getNumPartitions() == len(boxes) // 20


def test_occupancy_tasks_follow_boxes(spark, boxes, monkeypatch):
    monkeypatch.setattr(raster, "TASK_BOXES", 20)
    table, frames = spark.createDataFrame(boxes, BOX), spark.createDataFrame([(i, i % 3, H, W) for i in range(40)], FRAME)
    shape = "cam bigint, img_h int, img_w int"
    found = raster.occupancy_precise(frames, table, spark.createDataFrame([], f"{shape}, y int, xs int, xe int"), spark.createDataFrame([], shape))
    covered = dense(boxes, 0)
    assert rows_of(found.select("frame_id", "occupancy"), "frame_id") == [
        (i, float((covered[i] > 0).sum()) / float(H * W) * 100 if i in covered else 0.0) for i in range(40)
    ]
    assert f", {len(boxes) // 20}), REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
