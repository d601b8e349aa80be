"""Streams give what the batch operators give, also after restarts, replays and late rows."""

import random

from helpers import rows_of
from pyspark.sql import functions as F
from test_scan import edge_rows, incident_rows

from roadpulse import schemas
from roadpulse.operators import accident, edge_state
from roadpulse.plans import traffic
from roadpulse.sources import dimensions as dim
from roadpulse.sources import sinks
from roadpulse.streaming import frame_rows, jobs

SPEED = ["edge_id", "event_id", "prev_speed", "ema", "speed", "status"]


def write_slice(df, path):
    df.repartition(1).write.mode("append").parquet(path)


def thirds(df):
    low, high = df.agg(F.min("t"), F.max("t")).first()
    width = (high - low) // 3 + 1
    return [df.filter(F.col("t").between(low + i * width, low + (i + 1) * width - 1)) for i in range(3)]


def as_set(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


def replay_last(progress):
    """Takes back the commit of the last micro-batch, as a failure before it would."""
    last = max(int(p.name) for p in (progress / "commits").iterdir() if p.name.isdigit())
    (progress / "commits" / str(last)).unlink()
    for crc in (progress / "commits").glob(f".{last}*.crc"):
        crc.unlink()


def test_edge_stream_equals_batch_with_restart_and_replay(spark, tmp_path):
    series = edge_rows(spark, hot=400).drop("batch_id")
    source, out, published, progress = (str(tmp_path / n) for n in ("in", "out", "state", "progress"))

    def run():
        stream = jobs.file_stream(spark, source, schemas.EDGE_SERIES, 1)
        jobs.stream_edge_speeds(stream, out, progress, published).awaitTermination()

    for part in thirds(series):
        write_slice(part, source)
        run()  # every run is a restart from the stored state
    # small edges share early times with the hot edge, so no row is late and the stream equals the batch
    speeds = edge_state.speed_and_status(series)
    want, state = as_set(speeds, SPEED), ["edge_id", "t", "speed", "status"]
    assert as_set(spark.read.parquet(out), SPEED) == want
    newest = lambda: as_set(sinks.read_version(spark, published, sinks.latest_version(spark, published)), state)
    assert newest() == as_set(edge_state.latest_state(speeds), state)
    replay_last(tmp_path / "progress")
    run()
    assert as_set(spark.read.parquet(out), SPEED) == want and newest() == as_set(edge_state.latest_state(speeds), state)


def test_late_rows_are_dropped_or_meet_the_state(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    row = lambda edge, t, i, raw=30.0: (edge, t, i, raw, 50.0)

    def run(*rows):
        write_slice(spark.createDataFrame(list(rows), schemas.EDGE_SERIES), source)
        jobs.stream_edge_speeds(jobs.file_stream(spark, source, schemas.EDGE_SERIES, 1), out, progress).awaitTermination()

    run(row("a", 0, 1), row("b", 5000, 2))
    run(row("b", 4940, 3), row("b", 4941, 4, 20.0))
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2, 4]
    # the late row meets the state and doesn't date it back: 27.0 holds until 5000 + 1200
    run(row("b", 6199, 5, 27.0))
    run(row("b", 7399, 6))
    got = {r.event_id: (r.prev_speed, r.prev_t, r.speed) for r in spark.read.parquet(out).collect()}
    assert got[4] == (30.0, 5000, 27.0) and got[5] == (27.0, 5000, 27.0) and got[6] == (None, None, 30.0)


def test_timers_tell_stale_edges_once(spark, tmp_path):
    source, out, progress, cleared = (str(tmp_path / n) for n in ("in", "out", "progress", "cleared"))

    def run(*rows):
        write_slice(spark.createDataFrame([(e, t, i, 30.0, 50.0) for e, t, i in rows], schemas.EDGE_SERIES), source)
        stream = jobs.file_stream(spark, source, schemas.EDGE_SERIES, 1)
        jobs.stream_edge_speeds(stream, out, progress, cleared=cleared).awaitTermination()
        return sorted((r.edge_id, r.last_t, r.cleared_t) for r in spark.read.parquet(cleared).collect())

    assert run(("a", 100, 1), ("b", 100, 2), ("c", 100, 3)) == []
    assert run(("b", 900, 4), ("x", 1060, 5)) == []  # the watermark stands at 1000: exactly 900 s after a's last write
    told = [("a", 100, 1000), ("c", 100, 1000)]
    assert run(("x", 1061, 6)) == told  # a and c went stale, b's timer was cancelled by its write
    assert run(("a", 1100, 7), ("x", 1700, 8)) == told  # told once, also when the next write comes
    told += [("b", 900, 1800)]
    assert run(("x", 2000, 9)) == sorted(told)
    assert run(("a", 2500, 10)) == sorted([*told, ("a", 1100, 2000)])  # the next write came before the timer
    states = spark.read.parquet(out)
    assert {r.event_id: r.prev_speed for r in states.collect()}[10] is None


def test_frames_with_their_boxes_equal_the_batch(spark, tmp_path):
    rng = random.Random(6)
    shapes = {0: (40, 70), 1: (40, 70), 2: (30, 130), 3: (40, 70)}
    frames, boxes = [], []
    for i in range(60):
        cam = i % 4
        h, w = shapes[cam] if i != 9 else (41, 70)  # one frame doesn't fit its camera's mask
        frames.append((cam, i, 10 * i, h, w))
        for _ in range(rng.randint(0, 6) if i % 7 else 0):
            x, y = rng.uniform(-20, w), rng.uniform(-20, h)
            boxes.append((i, cam, h, w, rng.randint(0, 5), x, y, x + rng.uniform(0, 40), y + rng.uniform(0, 30)))
    frame_df = spark.createDataFrame(frames, "cam long, frame_id long, t long, img_h int, img_w int")
    box_df = spark.createDataFrame(boxes, "frame_id long, cam long, img_h int, img_w int, cls int, x1 double, y1 double, x2 double, y2 double")
    runs = [(c, 40, 70, y, 5 + c, 50 + y) for c in (0, 1) for y in range(0, 20)]
    cameras = [(c, 40, 70) for c in (0, 1, 3)]  # camera 2 has no mask, camera 3 an empty one
    mask = traffic.RoadMask(spark.createDataFrame(runs, "cam long, img_h int, img_w int, y int, xs int, xe int"), spark.createDataFrame(cameras, "cam long, img_h int, img_w int"))
    weights = dim.default_coefficients(spark)
    names = ["frame_id", "cam", "occ", "meu"]
    want = as_set(traffic.frame_metrics(frame_df, box_df, mask, weights), names)
    held = box_df.groupBy("frame_id").agg(F.collect_list(F.struct("cls", F.lit(0.9).alias("conf"), "x1", "y1", "x2", "y2")).alias("boxes"))
    whole = frame_df.join(held, "frame_id", "left").select("cam", "frame_id", "t", "img_h", "img_w", "boxes")
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    whole.repartition(3).write.parquet(source)
    stream = jobs.file_stream(spark, source, schemas.FRAME, 1)
    jobs.stream_frame_metrics(stream, mask, weights, out, progress).awaitTermination()
    assert as_set(spark.read.parquet(out), names) == want
    assert frame_rows.measured(whole.limit(0), mask, weights).count() == 0


def test_alert_stream_equals_batch(spark, tmp_path):
    series = incident_rows(spark, hot=300)
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for part in thirds(series):
        write_slice(part, source)
        stream = jobs.file_stream(spark, source, schemas.INCIDENT_SERIES, 1)
        jobs.stream_accident_alerts(stream, out, progress).awaitTermination()
    streaks = accident.incident_streak(series)
    got = spark.read.parquet(out)
    assert as_set(got, ["cam", "event_id", "streak"]) == as_set(streaks, ["cam", "event_id", "streak"])
    assert as_set(got.filter("fires"), ["cam", "event_id"]) == as_set(accident.alert_cooldown(streaks), ["cam", "event_id"])
    times = {}
    for r in got.filter("fires").orderBy("cam", "t", "event_id").collect():
        assert r.t - times.get(r.cam, -300) >= 300
        times[r.cam] = r.t


def test_streamed_calibration_counts_each_micro_batch_once(spark, tmp_path):
    from roadpulse.plans import jobs as batch_jobs

    rng = random.Random(9)
    frames, boxes = [], []
    for i in range(90):
        frames.append((i % 3, i, 10 * i, 30, 50))
        for _ in range(rng.randint(0, 5)):
            x, y = rng.uniform(-5, 45), rng.uniform(-5, 25)
            boxes.append((i, i % 3, 30, 50, rng.randint(0, 4), x, y, x + rng.uniform(0, 30), y + rng.uniform(0, 20)))
    frame_df = spark.createDataFrame(frames, "cam long, frame_id long, t long, img_h int, img_w int")
    box_df = spark.createDataFrame(boxes, "frame_id long, cam long, img_h int, img_w int, cls int, x1 double, y1 double, x2 double, y2 double")
    held = box_df.groupBy("frame_id").agg(F.collect_list(F.struct("cls", F.lit(0.9).alias("conf"), "x1", "y1", "x2", "y2")).alias("boxes"))
    whole = frame_df.join(held, "frame_id", "left").select("cam", "frame_id", "t", "img_h", "img_w", "boxes")
    weights = dim.default_coefficients(spark)
    place = lambda n: str(tmp_path / n)
    for version, part in enumerate(["t < 400", "t >= 400"]):
        own = box_df.join(frame_df.filter(part).select("frame_id"), "frame_id", "left_semi")
        batch_jobs.calibration_job(frame_df.filter(part), own, weights, place("mask"), place("limits"), version)
        whole.filter(part).repartition(2).write.parquet(place(f"in{version}"))
        for attempt in range(2):  # the last micro-batch is replayed, and so is the end of the run
            stream = jobs.file_stream(spark, place(f"in{version}"), schemas.FRAME, 1)
            jobs.stream_calibration(stream, weights, place("gathered"), f"run{version}", place(f"progress{version}")).awaitTermination()
            report = batch_jobs.finish_calibration(spark, place("gathered"), f"run{version}", place("mask2"), place("limits2"), version).first()
            if not attempt:
                replay_last(tmp_path / f"progress{version}")
        assert (report.n_low, report.preview) == (3, "0, 1, 2")
    for name, columns in (("mask/runs", ["cam", "y", "xs", "xe"]), ("mask/heatmap", ["cam", "y", "xs", "xe", "hits"]), ("limits", ["cam", "meu_max"])):
        want = as_set(sinks.read_version(spark, place(name), 1), columns)
        assert want and as_set(sinks.read_version(spark, place(name.replace("mask", "mask2").replace("limits", "limits2")), 1), columns) == want


def test_late_rows_of_a_cycle_are_dropped_and_counted(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def run(*times):
        write_slice(spark.createDataFrame([(i, 1, t, 0.0, 0.0) for i, t in enumerate(times)], schemas.OBSERVATION), source)
        query = jobs.stream_cycle_window(jobs.file_stream(spark, source, schemas.OBSERVATION, 1), out, progress)
        query.awaitTermination()
        return query

    run(1000, 1019, 1020, 1100)  # the watermark stands at 1040: two cycles are closed
    assert rows_of(spark.read.parquet(out).select("window_start", "n_frames"), "window_start") == [(1000, 2), (1020, 1)]
    assert jobs.dropped_rows(run(1005, 1021, 1041, 1130)) == 2
    assert rows_of(spark.read.parquet(out).select("window_start", "n_frames"), "window_start") == [(1000, 2), (1020, 1), (1040, 1)]


def test_cycle_window_on_a_stream(spark, tmp_path):
    from roadpulse.operators.report import cycle_window

    source = str(tmp_path / "in")
    rows = spark.range(200).selectExpr("id event_id", "id % 3 cam", "id t", "1d occ", "1d meu")
    write_slice(rows, source)
    stream = jobs.with_event_time(jobs.file_stream(spark, source, schemas.OBSERVATION, 1))
    query = cycle_window(stream).writeStream.format("memory").queryName("cycles").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = cycle_window(rows.withColumn("ts", F.timestamp_seconds("t")))
    assert rows_of(spark.table("cycles"), "window_start") == rows_of(batch, "window_start")


def test_files_of_a_slice_follow_its_rows(spark, monkeypatch):
    from roadpulse.plans import camera_queries

    monkeypatch.setattr(camera_queries, "FILE_ROWS", 100)
    monkeypatch.setattr(camera_queries, "LEAST_FILE_ROWS", 10)
    slices = lambda *sizes: spark.createDataFrame([(i,) for i, n in enumerate(sizes) for _ in range(n)], "slice int")
    files = [camera_queries._files_per_slice(slices(*sizes)) for sizes in ((900, 1000, 700), (1000, 50), (9, 8), (1000, 9), ())]
    assert files == [10, 5, 2, 2, 2]


def test_small_masks_are_sent_once_and_large_ones_joined(spark, monkeypatch):
    box = [(0, 0.9, 1.0, 1.0, 9.0, 9.0)]
    rows = [(0, 1, 0, 20, 30, box), (0, 2, 0, 21, 30, box), (1, 3, 0, 20, 30, box), (2, 4, 0, 20, 30, box), (None, 5, 0, 20, 30, box), (0, 6, 0, 20, 30, [])]
    frames = spark.createDataFrame(rows, schemas.FRAME)
    shape = "cam long, img_h int, img_w int"
    mask = traffic.RoadMask(spark.createDataFrame([(0, 20, 30, 2, 0, 20)], f"{shape}, y int, xs int, xe int"), spark.createDataFrame([(0, 20, 30), (1, 20, 30)], shape))
    want = [(1, 40.0), (2, None), (3, 0.0), (4, 64 / 600 * 100), (5, 64 / 600 * 100), (6, 0.0)]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    sent = frame_rows.occupancy(frames, mask)
    assert rows_of(sent.select("frame_id", "occ"), "frame_id") == want and "Join" not in plan(sent)
    monkeypatch.setattr("roadpulse.operators.painted.MASK_RUNS", 0)
    joined = frame_rows.occupancy(frames, mask)
    assert rows_of(joined.select("frame_id", "occ"), "frame_id") == want and "Join" in plan(joined)


def test_edge_frames_keep_their_types():
    from roadpulse.streaming import state

    found = state.EdgeProcessor()._frame("e", [(900, None, 3.0, "RED", 0, None, None, None, 0, True), (901, 7, None, None, None, 5.0, 5.0, "RED", 901, False)])
    assert list(found.columns) == [c.split()[0] for c in state.EDGE_OUTPUT.split(", ")]
    assert found["event_id"].dtype == found["prev_t"].dtype == "Int64" and found["event_id"].isna().tolist() == [True, False]


def test_edges_share_the_keys_of_a_stream(spark, tmp_path):
    from roadpulse.streaming import state

    source, out, progress, cleared = (str(tmp_path / n) for n in ("in", "out", "progress", "cleared"))
    edges = 3 * state.EDGE_BUCKETS
    first = spark.range(edges).selectExpr("cast(id as string) edge_id", "100L t", "id event_id", "30d raw_speed", "50d free_flow")
    write_slice(first.unionAll(spark.sql("select cast(null as string), 100L, -1L, 30d, 50d")), source)

    def run():
        query = jobs.stream_edge_speeds(jobs.file_stream(spark, source, schemas.EDGE_SERIES, 1), out, progress, cleared=cleared)
        query.awaitTermination()
        return max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"])

    assert run() <= 3 * state.EDGE_BUCKETS  # a state and a timer, by two orders, per bucket, not per edge
    write_slice(first.filter("event_id % 2 = 0").withColumn("t", F.lit(500)).withColumn("raw_speed", F.lit(20.0)), source)
    run()
    write_slice(spark.createDataFrame([("0", 1100, 0, 30.0, 50.0)], schemas.EDGE_SERIES), source)
    run()
    want = sorted((str(i) if i >= 0 else "None", 100, 1000) for i in [-1, *range(1, edges, 2)])
    assert sorted((str(r.edge_id), r.last_t, r.cleared_t) for r in spark.read.parquet(cleared).collect()) == want
    second = spark.read.parquet(out).filter("t = 500 and prev_speed = 30 and prev_t = 100")
    assert second.count() == edges // 2 and spark.read.parquet(out).count() == edges + 1 + edges // 2 + 1


def test_whole_frames_are_made_by_as_many_tasks_as_boxes_need(spark, sf_dir, monkeypatch):
    from roadpulse.plans import camera_queries

    names = ["frame_id", "cam", "t"]
    want = as_set(camera_queries._whole_frames(spark, sf_dir).select(*names, F.size("boxes").alias("n")), [*names, "n"])
    boxes = camera_queries._frames_boxes(spark, sf_dir)[1].count()
    monkeypatch.setattr(camera_queries, "TASK_BOXES", boxes // 30)
    many = camera_queries._whole_frames(spark, sf_dir)
    assert many.rdd.getNumPartitions() >= 30
    assert as_set(many.select(*names, F.size("boxes").alias("n")), [*names, "n"]) == want
