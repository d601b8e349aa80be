"""Batch jobs from input tables to published tables, against plain Python on a small fixture."""

import json
import random

import numpy as np
from helpers import rows_of

from roadpulse.operators.edge_state import smooth_step
from roadpulse.plans import jobs
from roadpulse.sources import dimensions as dim
from roadpulse.sources import sinks

H, W = 20, 70
FRAME = "frame_id long, cam long, img_h int, img_w int, t long"
BOX = "frame_id long, cam long, img_h int, img_w int, cls int, x1 double, y1 double, x2 double, y2 double"
UNITS = {0: 1.0, 1: 3.236, 2: 8.568, 3: 10.0}


def test_calibration_then_traffic_in_two_versions(spark, tmp_path):
    rng = random.Random(5)
    frames = [(i, i % 3, H, W, 100 + 17 * i) for i in range(60)]
    boxes = []
    for frame, cam, *_ in frames:
        for _ in range(rng.randint(0, 6)):
            x, y = rng.randint(0, 100) / 2, rng.randint(0, 24) / 2
            boxes.append((frame, cam, H, W, rng.randint(0, 4), x, y, x + rng.randint(8, 60) / 2, y + rng.randint(4, 16) / 2))
    frames_df, boxes_df = spark.createDataFrame(frames, FRAME), spark.createDataFrame(boxes, BOX)
    coefficients = dim.default_coefficients(spark)
    mask_path, limits_path, out, state = (str(tmp_path / n) for n in ("mask", "limits", "out", "state"))
    report = jobs.calibration_job(frames_df, boxes_df, coefficients, mask_path, limits_path, 0).first()
    assert (report.n_low, report.preview) == (3, "0, 1, 2")

    edges = [(0, 0, "a"), (1, 0, "a"), (1, 1, "b"), (2, 0, "c")]
    flows = {"a": 60.0, "c": 31.0}
    edges_df = spark.createDataFrame(edges, "cam long, ord int, edge_id string")
    flows_df = spark.createDataFrame(list(flows.items()), "edge_id string, speed_kph double")
    mask = jobs.load_mask(spark, mask_path)
    limits = sinks.read_version(spark, limits_path, 0)
    for version, part in enumerate(["t < 600", "t >= 600", "t >= 600"]):
        version = min(version, 1)  # the second version is repeated
        jobs.traffic_job(
            frames_df.filter(part), boxes_df.join(frames_df.filter(part).select("frame_id"), "frame_id", "left_semi"), mask,
            coefficients, edges_df, flows_df, limits, out, state, version,
        )

    # plain Python
    px = lambda v, n: int(max(0, min(round(v), n - 1)))
    heat = np.zeros((3, H, W), int)
    cover, load = np.zeros((60, H, W), bool), [0.0] * 60
    for f, cam, _, _, cls, x1, y1, x2, y2 in boxes:
        area = np.s_[px(y1, H) : px(y2, H), px(x1, W) : px(x2, W)]
        heat[cam][area] += 1
        cover[f][area] = True
        load[f] += UNITS.get(cls, 0)
    road = heat >= max(1, round(20 * 0.30))
    top = [round(max(load[f] for f, c, *_ in frames if c == cam), 2) for cam in range(3)]
    states, want = {}, []
    for f, cam, _, _, t in frames:
        occ = (cover[f] & road[cam]).sum() / road[cam].sum() * 100
        density = 0.0 if occ <= 20 else min(round(load[f], 3) / top[cam], 1.0)
        for edge in [e for c, _, e in edges if c == cam]:
            flow = flows.get(edge, 50.0)
            states[edge], result = smooth_step(states.get(edge), t, max(flow * (1 - density), 3.0), flow)
            want.append((edge, f, result[4], result[5]))
    got = spark.read.parquet(out).select("edge_id", "event_id", "speed", "status")
    assert rows_of(got, "edge_id", "event_id") == sorted(want)
    final = sinks.read_version(spark, state, 1).select("edge_id", "speed", "status", "t")
    assert rows_of(final, "edge_id") == sorted((e, *s) for e, (v, st, t) in states.items() for s in [(v, st, t)])


def test_geometry_job(spark, tmp_path):
    zone = lambda value, shape: {"mapped_edge": {"edge_id": {"value": value}, "edge_info": {"shape": shape}}}
    shape = "_wdrS_mmojE"
    cameras = [
        {"cam_id": "a", "zones": {"9": zone(7, shape + "?@"), "1": zone(7, shape), "2": zone(None, shape), "3": zone(8, "")}},
        {"cam_id": "b", "zones": {}},
        {"cam_id": "c", "zones": {"1": zone(9, "AA"), "2": zone(8, shape)}},
    ]
    (tmp_path / "cameras.json").write_text(json.dumps(cameras))
    stats = jobs.geometry_job(spark, str(tmp_path / "cameras.json"), str(tmp_path / "out"), multi_line=True).first().asDict()
    assert stats == {
        "zones_seen": 6, "no_edge_id": 1, "no_shape": 1, "duplicates": 1, "written": 3, "out_of_range": 1, "cameras": 3,
    }
    got = {r.edge_id: r.points for r in sinks.read_geometry(spark, str(tmp_path / "out")).collect()}
    assert got == {"7": [[10.8, 106.7], [10.8, 106.699999]], "8": [[10.8, 106.7]], "9": [[1e-06, 1e-06]]}
