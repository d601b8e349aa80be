"""Files read and written, scalar functions, geometry."""

import json
import random

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from roadpulse.functions import scalars as S
from roadpulse.operators import accident, edge_state, geometry, metrics, report
from roadpulse.session import broadcast_if_small, hot_keys, is_small
from roadpulse.sources import cameras as cam_src
from roadpulse.sources import dimensions as dim
from roadpulse.sources import frames as frame_src
from roadpulse.sources import sinks


def zone(value, shape="??"):
    return {"way_id": 7, "side": "left", "mapped_edge": {"edge_id": {"value": value}, "edge_info": {"shape": shape}}}


@pytest.fixture
def camera_file(tmp_path):
    cameras = [
        {"cam_id": "b", "description": "Cầu Sài Gòn", "zones": {"z2": zone(5), "z1": {"mapped_edge": None}, "z0": zone(3_380_307_324_401)}},
        {"cam_id": "a", "zones": {}},
        {"cam_id": "c"},
        {"cam_id": "d", "zones": {"z": zone(None)}},
    ]
    path = tmp_path / "cameras.json"
    path.write_text(json.dumps(cameras, indent=1), encoding="utf-8")
    return str(path)


def test_cameras_keep_file_order(spark, camera_file):
    cameras = cam_src.read_cameras(spark, camera_file, multi_line=True)
    active = cam_src.active_cameras(cameras)
    assert [r.cam_id for r in active.orderBy("ordinal").collect()] == ["b", "d"]
    for limit, kept in {"1": ["b"], "0": [], "": ["b", "d"], None: ["b", "d"]}.items():
        assert sorted(r.cam_id for r in cam_src.camera_limit(active, limit).collect()) == kept
    edges = cam_src.camera_edges(cameras)
    assert rows_of(edges.select("cam_id", "ord", "edge_id", "way_id", "direction"), "ord") == [
        ("b", 0, "5", 7, "left"), ("b", 2, "3380307324401", 7, "left"),
    ]


def test_missing_and_empty_settings(spark, tmp_path):
    assert dim.read_meu_coefficients(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "empty.json").write_text("")
    assert dim.read_meu_coefficients(spark, str(tmp_path / "empty.json")).count() == 0
    (tmp_path / "some.json").write_text('{"0": 1.0, "1": 3.236}')
    assert [(r.cls, float(r.coef)) for r in dim.read_meu_coefficients(spark, str(tmp_path / "some.json")).orderBy("cls").collect()] == [(0, 1.0), (1, 3.236)]


def test_thresholds_from_one_object(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"x": {"meuMax": 200.0}, "y": {"meuMax": 0, "orMax": 35.0, "hciMax": 1.0}}))
    stored = dim.read_thresholds(spark, str(tmp_path / "t.json"), one_object=True)
    cameras = spark.createDataFrame([("x",), ("y",), ("z",)], "cam_id string")
    assert rows_of(dim.thresholds_or_default(cameras, stored), "cam_id") == [
        ("x", 200.0, None, None), ("y", 0.0, 35.0, 1.0), ("z", 1.0, 1.0, 1.0),
    ]


def test_frames_from_image_files(spark, tmp_path):
    for name, data in {
        "good.jpg": b"\xff\xd8" + b"x" * 4997 + b"\xff\xd9", "short.jpg": b"\xff\xd8" + b"x" * 4996 + b"\xff\xd9",
        "cut.jpg": b"\xff\xd8" + b"x" * 6000, "text.jpg": b"x" * 6000 + b"\xff\xd9",
    }.items():
        (tmp_path / name).write_bytes(data)
    kept = frame_src.valid_frames(frame_src.read_frames(spark, str(tmp_path)))
    assert [r.path.rsplit("/", 1)[1] for r in kept.collect()] == ["good.jpg"]


def test_intake_order_of_checks(spark):
    rows = [("text/html", b""), ("image/png", b""), ("image/png", b"x" * 11), ("image/png", b"GIF"), ("image/png", b"\xff\xd8."), (None, b"\xff\xd8")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, content_type string, content binary")
    assert [r.status for r in frame_src.with_intake_status(df, 10).orderBy("i").collect()] == [422, 422, 413, 400, 200, 422]


def test_parse_state(spark):
    raws = [None, "", "41.5", "41.5:17", "41.5:17:RED", "41.5:17:JAM", "x:1:RED", "1e1:2:GREEN:more", "4d:1:RED", " 7 :x:YELLOW", ":1:RED"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    got = [tuple(r.s) for r in df.select("i", S.parse_state("raw").alias("s")).orderBy("i").collect()]
    none = (None, None, None)
    assert got == [
        none, none, none, (41.5, 17, None), (41.5, 17, "RED"), (41.5, 17, None), none, (10.0, 2, "GREEN"), none,
        (7.0, None, "YELLOW"), none,
    ]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_density_and_speed(spark):
    weight = lambda occ, meu, top: value(spark, S.traffic_weight(F.lit(occ), F.lit(meu), F.lit(top)))
    assert round(weight(100.0, 58.12, 200.0), 2) == 0.29
    assert weight(20.0, 58.12, 200.0) == 0.0 and weight(20.01, 300.0, 200.0) == 1.0 and weight(90.0, 5.0, 0.0) == 0.0
    assert value(spark, S.greenshields_speed(F.lit(50.0), F.lit(1.0))) == 3.0
    assert value(spark, S.greenshields_speed(F.lit(50.0), F.lit(0.5), n=2.0)) == 37.5
    assert value(spark, S.round_even(F.lit(2.5))) == 2.0 and value(spark, S.round_even(F.lit(0.125), 2)) == 0.12


def test_zero_free_flow_stops_a_camera_at_that_edge(spark):
    edges = spark.createDataFrame([(1, 0, "a"), (1, 1, "z"), (1, 2, "b"), (2, 0, "b")], "cam long, ord int, edge_id string")
    flows = spark.createDataFrame([("z", 0.0)], "edge_id string, speed_kph double")
    assert rows_of(metrics.writable_edges(edges, flows).select("cam", "edge_id"), "cam") == [(1, "a"), (2, "b")]
    attempts = spark.createDataFrame([(1, 0, 5, True), (2, 0, 9, True), (3, 0, 9, True), (2, 0, 9, False)], "cam long, batch_id long, t long, fetched boolean")
    known = spark.createDataFrame([(1,), (2,)], "cam long")
    stats = report.cycle_stats(attempts, known, metrics.failing_cameras(edges, flows)).first()
    assert tuple(stats) == (0, 1, 3, 4, 4)


def test_readers_see_whole_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    assert sinks.latest_version(spark, path) is None
    rows = spark.createDataFrame([("a", 1, 5.0), ("b", 2, 6.0)], "k string, t long, v double")
    sinks.upsert_latest(rows, path, 0, "k", "t")
    sinks.upsert_latest(spark.createDataFrame([("a", 3, 7.0)], rows.schema), path, 1, "k", "t")
    sinks.upsert_latest(spark.createDataFrame([("a", 3, 7.0)], rows.schema), path, 1, "k", "t")
    assert sinks.latest_version(spark, path) == 1 and sinks.latest_version(spark, path, before=1) == 0
    want = [("a", 3, 7.0), ("b", 2, 6.0)]
    assert rows_of(sinks.read_version(spark, path, 1).select("k", "t", "v"), "k") == want
    # a writer that fails with its data half done leaves the record, and so the table, as it was
    broken = rows.withColumn("v", F.when(F.col("k") == "b", F.raise_error(F.lit("stop")).cast("double")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stop"):
        sinks.publish_version(broken, path, 2)
    assert rows_of(sinks.read_version(spark, path, sinks.latest_version(spark, path)).select("k", "t", "v"), "k") == want
    # a record that is just being rewritten leaves the other one
    sinks.publish_version(rows, path, 2)
    for name in ("record-0", "record-1"):
        held = tmp_path / "table" / name
        held.rename(tmp_path / "held")
        assert sinks.latest_version(spark, path) in (1, 2)
        (tmp_path / "held").rename(held)


def test_old_versions_make_room(spark, tmp_path):
    path = str(tmp_path / "table")
    for version in range(12):
        sinks.publish_version(spark.range(version, version + 1), path, version)
    folders = sorted(p.name for p in (tmp_path / "table").iterdir() if p.name.startswith("data"))
    assert len(folders) == sinks.KEPT_VERSIONS + 1
    kept = range(12 - sinks.KEPT_VERSIONS, 12)
    assert [sinks.read_version(spark, path, v).first().id for v in kept] == list(kept)


def test_a_batch_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    put = lambda batch, first, app="a": sinks.append_rows(spark.range(first, first + 3), path, app, batch)
    assert [put(0, 0), put(1, 10), put(1, 10), put(0, 0), put(2, 20), put(0, 100, "b")] == [True, True, False, False, True, True]
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 10, 11, 12, 20, 21, 22, 100, 101, 102]
    # a batch whose data came through but not its entry in the ledger is written over
    sinks.append_once(spark, path, "a", 3, lambda folder: spark.range(5).write.mode("overwrite").parquet(folder))
    sinks.write_record(spark, f"{path}.ledger/a", {"batch": 2})
    assert put(3, 30) and spark.read.parquet(f"{path}/app=a").count() == 12


def test_positions_follow_paths_and_splits(spark, tmp_path):
    lines = {f"f{i}/x.json": [f"{i}-{k}" for k in range(n)] for i, n in enumerate((3, 400, 1, 50))}
    for name, ids in lines.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True)
        (tmp_path / "in" / name).write_text("".join(json.dumps({"cam_id": c, "description": "d" * 50}) + "\n" for c in ids))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2048b", before):  # files cut into many splits, and many files in one partition
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            read = cam_src.read_cameras(spark, str(tmp_path / "in" / "*")).collect()
            assert [r.cam_id for r in sorted(read, key=lambda r: r.ordinal)] == [c for ids in lines.values() for c in ids]
            assert sorted(r.ordinal for r in read) == list(range(454))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_last_free_flow_of_several_files_wins(spark, tmp_path):
    for i, speed in enumerate((30.0, 40.0, 50.0)):
        (tmp_path / f"{i}.json").write_text("".join(json.dumps({"edge_id": e, "speed_kph": speed + (e == "pad")}) + "\n" for e in ["a"] + ["pad"] * (300 if i == 0 else 1)))
    assert rows_of(dim.read_free_flow(spark, str(tmp_path / "*.json")), "edge_id") == [("a", 50.0), ("pad", 51.0)]


def test_alert_text_keeps_non_ascii(spark, tmp_path):
    edges = spark.createDataFrame([(1, 1, "20"), (1, 0, "30"), (1, 2, None)], "cam long, ord int, edge_id string")
    cameras = spark.createDataFrame([(1, "Lối Gió Mát")], "cam long, description string")
    alerts = spark.createDataFrame([(1, 9, "human_incident", 0.81249)], "cam long, t long, class_name string, conf double")
    sinks.append_alerts(accident.alert_records(alerts, edges, cameras), str(tmp_path / "alerts"), "test", 0)
    line = spark.read.text(str(tmp_path / "alerts")).first().value
    assert "Lối Gió Mát" in line
    assert json.loads(line) == {"camId": "1", "edgeIds": [30, 20], "className": "human_incident", "confidence": 0.812, "ts": 9, "location": "Lối Gió Mát"}


def encode(points):
    """Plain encoder, the inverse of what the operator does."""
    text, last = "", (0, 0)
    for point in points:
        for now, before in zip(point, last):
            n = (now - before) * 2 if now >= before else (before - now) * 2 - 1
            while n >= 32:
                text += chr((n & 31) + 32 + 63)
                n >>= 5
            text += chr(n + 63)
        last = point
    return text


def test_polylines_round_trip(spark):
    rng = random.Random(4)
    lines = {f"e{k}": [(rng.randint(-90_000_000, 90_000_000), rng.randint(-180_000_000, 180_000_000)) for _ in range(k + 1)] for k in range(12)}
    shapes = spark.createDataFrame([(k, encode(v)) for k, v in lines.items()], "edge_id string, shape string")
    got = {}
    for r in geometry.polyline_points(shapes).orderBy("edge_id", "i").collect():
        got.setdefault(r.edge_id, []).append([r.lat, r.lon])
    assert got == {k: [[round(a * 1e-6, 6), round(o * 1e-6, 6)] for a, o in v] for k, v in lines.items()}
    assert {r.edge_id: r.points for r in geometry.edge_geometry(shapes.withColumn("ord", F.lit(1))).collect()} == got


def test_hot_keys_and_checked_broadcast(spark):
    rows = spark.range(100).selectExpr("if(id < 60, 0, id) k")
    assert hot_keys(rows, "k", 60) is None
    assert [(r.k, r.key_rows) for r in hot_keys(rows, "k", 59).collect()] == [(0, 60)]
    hinted = lambda df: "hint" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_small(rows, 100)) and not hinted(broadcast_if_small(rows, 99))
    wide = rows.selectExpr("k", "repeat('é', 1000) s", "array(k, k) a", "map('x', k) m", "cast('b' as binary) b", "struct(k) r")
    assert is_small(wide, 100) and is_small(wide, 100, 230_000) and not is_small(wide, 100, 200_000) and is_small(wide.limit(0), 0, 0)


def test_freshness_bound_is_inclusive(spark):
    state = spark.createDataFrame([("a", 100), ("b", 99)], "edge_id string, t long")
    assert [r.edge_id for r in edge_state.fresh_edges(state, 1000).collect()] == ["a"]
