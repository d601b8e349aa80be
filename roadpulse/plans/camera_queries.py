"""Queries for frame rasters, calibration masks, accidents and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import fixtures as fx
from roadpulse import schemas
from roadpulse.operators import accident, calibration, metrics, raster
from roadpulse.operators.boxes import class_label
from roadpulse.plans import jobs as batch
from roadpulse.plans import traffic
from roadpulse.plans.registry import alerts_sql, query, speeds_sql, sql
from roadpulse.plans.source_queries import _processed, _series, arriving
from roadpulse.session import materialize, scratch_path, tasks_for
from roadpulse.sources import dimensions as dim
from roadpulse.sources import sinks
from roadpulse.streaming import jobs

# Detector classes of the incident report, as laid over the fixture's class numbers.
INCIDENT_NAMES = {0: "human_incident", 1: "vehicle_incident", 2: "human_normal", 3: "vehicle_normal"}
FIXTURE_INCIDENT_CONFIDENCE = 0.2


def _frames_boxes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return fx.frames(spark, sf_dir), fx.detections(spark, sf_dir)


def _mask(spark, sf_dir) -> traffic.RoadMask:
    return traffic.calibrate_mask(*_frames_boxes(spark, sf_dir))


# ---- frame metrics ----
@query(sql("select frame_id, cam, meu from frame_meu", "frame_meu"))
def meu_per_frame(spark, sf_dir):
    frames, boxes = _frames_boxes(spark, sf_dir)
    return metrics.meu_per_frame(frames, boxes, dim.default_coefficients(spark)).select("frame_id", "cam", "meu")


@query(sql("""select f.frame_id, coalesce(sum(case when w > 0 and h > 0 then w * h end) / any_value(f.img_h * f.img_w)::double * 100, 0.0::double) occupancy_raw
 from fx_frames f left join (select frame_id, greatest(0, least(x2, img_w)) - greatest(0, least(x1, img_w)) w,
  greatest(0, least(y2, img_h)) - greatest(0, least(y1, img_h)) h from fx_detections) d using (frame_id) group by f.frame_id""", "fx_frames fx_detections"))
def occupancy_raw(spark, sf_dir):
    return metrics.occupancy_raw(*_frames_boxes(spark, sf_dir)).select("frame_id", "occupancy_raw")


@query(sql("select frame_id, cam, occ occupancy from frame_occ", "frame_occ"))
def occupancy_precise(spark, sf_dir):
    frames, boxes = _frames_boxes(spark, sf_dir)
    mask = _mask(spark, sf_dir)
    return traffic.road_occupancy(frames, boxes, mask).select("frame_id", "cam", "occupancy")


@query(sql("""select f.frame_id, coalesce(v.n, 0)::double / (f.img_h * f.img_w)::double * 100 occupancy from fx_frames f
 left join (select frame_id, count(*) n from vehicle_px group by frame_id) v using (frame_id)""", "fx_frames vehicle_px"))
def occupancy_precise_no_mask(spark, sf_dir):
    """Cameras without a mask are measured against the whole image."""
    frames, boxes = _frames_boxes(spark, sf_dir)
    shape = "cam bigint, img_h int, img_w int"
    runs, cameras = spark.createDataFrame([], f"{shape}, y int, xs int, xe int"), spark.createDataFrame([], shape)
    none = raster.occupancy_precise(frames, boxes, runs, cameras)
    return none.select("frame_id", "occupancy")


@query(sql("""select frame_id, v.y::int y, count(*) px from vehicle_px v join mask_px m using (cam, y, x) group by frame_id, v.y""", "vehicle_px mask_px"))
def mask_and(spark, sf_dir):
    frames, boxes = _frames_boxes(spark, sf_dir)
    cut = raster.mask_and(raster.vehicle_words(boxes), _mask(spark, sf_dir).runs)
    return cut.groupBy("frame_id", "y").agg(F.sum(F.bit_count("bits")).alias("px"))


_FRAME_SPEED = """select frame_id, cam, occ, meu, twf, greatest(50.0::double * (1.0::double - pow(twf, 1.0::double)), 3.0::double) raw_speed
 from (select o.frame_id, o.cam, o.occ, m.meu, case when o.occ <= 20 then 0.0::double else least(m.meu / 40.0::double, 1.0::double) end twf
  from frame_occ o join frame_meu m using (frame_id))"""


@query(sql(_FRAME_SPEED, "frame_occ frame_meu"))
def frame_speeds(spark, sf_dir):
    """Boxes to speed in one plan: load, masked occupancy, density, speed."""
    frames, boxes = _frames_boxes(spark, sf_dir)
    limits = frames.select("cam").distinct().withColumn("meu_max", F.lit(40.0))
    rows = traffic.frame_speeds(frames, boxes, _mask(spark, sf_dir), dim.default_coefficients(spark), limits)
    return rows.select("frame_id", "cam", "occ", "meu", "twf", "raw_speed")


# ---- heatmaps and masks ----
@query(sql("select cam, y::int y, xs::int xs, xe::int xe, hits from heat_runs", "heat_runs"))
def heatmap(spark, sf_dir):
    return raster.heatmap(fx.detections(spark, sf_dir)).select("cam", "y", "xs", "xe", "hits")


@query(sql("select cam, y::int y, xs::int xs, xe::int xe, hits from heat_runs", "heat_runs"))
def heatmap_merge(spark, sf_dir):
    boxes = fx.detections(spark, sf_dir)
    halves = [raster.heatmap(boxes.filter(F.col("frame_id") % 2 == part)) for part in (0, 1)]
    return raster.heatmap_merge(*halves).select("cam", "y", "xs", "xe", "hits")


@query(sql("""select cam, y::int y, xs::int xs, xe::int xe, r.hits, cast(round_even(r.hits * s + (0.0::double - lo * s), 0) as int) "level", hi max_hits
 from heat_runs r join (select *, coalesce(255.0::double / nullif(hi - lo, 0)::double, 0.0::double) s
  from (select cam, max(hits) hi, case when count(*) < 48 * 64 then 0 else min(hits) end lo from heat_px group by cam)) using (cam)""", "heat_runs heat_px"))
def heatmap_normalized(spark, sf_dir):
    scaled = raster.heatmap_normalized(materialize(raster.heatmap(fx.detections(spark, sf_dir))))
    return scaled.select("cam", "y", "xs", "xe", "hits", "level", "max_hits")


@query(sql("""select cam, y::int y, min(x)::int xs, (max(x) + 1)::int xe from (select cam, y, x, x - row_number() over (partition by cam, y order by x) run
 from heat_px where hits >= 100) group by cam, y, run""", "heat_px"))
def road_mask(spark, sf_dir):
    return raster.road_mask(raster.heatmap(fx.detections(spark, sf_dir))).select("cam", "y", "xs", "xe")


@query(sql("select cam, y::int y, xs::int xs, xe::int xe from mask_runs", "mask_runs"))
def road_mask_calibrated(spark, sf_dir):
    return _mask(spark, sf_dir).runs.select("cam", "y", "xs", "xe")


@query(sql("""select cam, y::int y, xs::int xs, xe::int xe from mask_runs where cam%4<>0 union all
 select cam, unnest(range(48))::int y, 0, 64 from frame_counts c where cam%4=0 or not exists (select 1 from mask_runs m where m.cam = c.cam)""", "mask_runs frame_counts"))
def mask_default(spark, sf_dir):
    mask = _mask(spark, sf_dir)
    return raster.mask_default(mask.runs.filter("cam%4<>0"), mask.cameras).select("cam", "y", "xs", "xe")


_TWO_RUNS = sql("""select cam, y::int y, min(x)::int xs, (max(x) + 1)::int xe from (
  select h.cam, h.y, h.x, h.x - row_number() over (partition by h.cam, h.y order by h.x) run from heat_px h
  join (select cam, count(*) n from fx_frames where frame_id % 3 = 0 group by cam) c using (cam)
  where h.hits >= greatest(1, round_even(c.n * 0.30::double, 0))) group by cam, y, run""", "heat_px fx_frames")


@query(_TWO_RUNS)
def calibration_two_runs(spark, sf_dir):
    """Two calibration runs: heat adds up over both, the second run's frame counts set the threshold."""
    frames, boxes = _frames_boxes(spark, sf_dir)
    mask, limits = scratch_path(spark, "masks"), scratch_path(spark, "limits")
    for version, own in enumerate(("frame_id % 3 <> 0", "frame_id % 3 = 0")):
        batch.calibration_job(frames.filter(own), boxes.filter(own), dim.default_coefficients(spark), mask, limits, version)
    return batch.load_mask(spark, mask).runs.select("cam", "y", "xs", "xe")


@query(sql("select cam, road_px::double / (48 * 64)::double * 100 road_ratio from mask_area", "mask_area"))
def road_ratio(spark, sf_dir):
    mask = _mask(spark, sf_dir)
    return raster.road_ratio(mask.runs, mask.cameras)


_CAMERA_STATS = "select cam, count(*) frames, round_even(max(meu) * 100, 0) / 100 meu_max from frame_meu group by cam"


def _frame_loads(spark, sf_dir) -> DataFrame:
    frames, boxes = _frames_boxes(spark, sf_dir)
    return metrics.meu_per_frame(frames, boxes, dim.default_coefficients(spark)).select("frame_id", "cam", "meu")


@query(sql(_CAMERA_STATS, "frame_meu"))
def calibration_stats(spark, sf_dir):
    return calibration.calibration_stats(_frame_loads(spark, sf_dir))


# ---- accidents ----
def _incident_boxes(spark, sf_dir) -> DataFrame:
    box = F.expr("cls * 1000000L + cast((x1 + 100) * 2 as bigint) * 1000 + cast((y1 + 100) * 2 as bigint)")
    return fx.detections(spark, sf_dir).withColumns({"class_name": class_label("cls", INCIDENT_NAMES), "box": box})


_BOXES = """select *, case cls when 0 then 'human_incident' when 1 then 'vehicle_incident' end class_name,
 cls * 1000000::bigint + cast((x1 + 100) * 2 as bigint) * 1000 + cast((y1 + 100) * 2 as bigint) box
 from fx_detections where cls in (0, 1)"""
_BEST = "max_by({'c': class_name, 'f': conf, 'l': x1, 't': y1, 'r': x2, 'b': y2}, [conf::double, -box::double])"
_BEST_COLUMNS = ", ".join(f"{_BEST}.{k} {c}" for k, c in zip("cfltrb", ("class_name", "conf", "x1", "y1", "x2", "y2")))


def _sides(rows: DataFrame) -> DataFrame:
    """The box of a report row as four columns."""
    return rows.withColumns({c: F.col("bbox")[i] for i, c in enumerate(("x1", "y1", "x2", "y2"))}).drop("bbox")


@query(sql(f"select frame_id, count(*) num_detections, {_BEST_COLUMNS} from ({_BOXES}) group by frame_id", "fx_detections"))
def incident_best(spark, sf_dir):
    return _sides(accident.incident_best(_incident_boxes(spark, sf_dir), ["frame_id"], "box"))


@query(sql(f"""select f.frame_id, b.n is not null accident_detected, coalesce(b.n, 0) num_detections, f.img_w width, f.img_h height,
 0.4::double confidence_threshold, b.class_name, b.conf, b.x1, b.y1, b.x2, b.y2, coalesce(b.listed, '') listed
 from fx_frames f left join (select frame_id, count(*) n, {_BEST_COLUMNS}, string_agg(box || ' ' || class_name, ',' order by box, class_name) listed
  from ({_BOXES}) where conf >= 0.4::double group by frame_id) b using (frame_id)""", "fx_frames fx_detections"))
def detect_report(spark, sf_dir):
    report = _sides(accident.detect_report(fx.frames(spark, sf_dir), _incident_boxes(spark, sf_dir)))
    listed = F.array_join(F.transform("detections", lambda d: F.concat_ws(" ", d["box"], d["class_name"])), ",")
    return report.withColumn("listed", listed).drop("detections")


@query(sql(f"select frame_id, box, class_name, conf, x1, y1, x2, y2 from ({_BOXES}) where conf >= 0.4::double", "fx_detections"))
def detect_report_boxes(spark, sf_dir):
    rows = accident.detect_report_boxes(_incident_boxes(spark, sf_dir))
    sides = [F.col("bbox")[i].alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))]
    return rows.select("frame_id", "box", "class_name", "conf", *sides)


def _incident_series(spark, sf_dir) -> DataFrame:
    return accident.incident_series(fx.incidents(spark, sf_dir), fx.camera_edges(spark, sf_dir), FIXTURE_INCIDENT_CONFIDENCE)


@query(sql("select cam, t, event_id, hit, streak from streaks", "streaks"))
def incident_streak(spark, sf_dir):
    return accident.incident_streak(_incident_series(spark, sf_dir)).select("cam", "t", "event_id", "hit", "streak")


@query(alerts_sql("select cam, t, event_id, class_name, conf, streak from alerts where fires"))
def alert_cooldown(spark, sf_dir):
    series = _incident_series(spark, sf_dir)
    alerts = accident.alert_cooldown(accident.incident_streak(series), counted=series)
    return alerts.select("cam", "t", "event_id", "class_name", "conf", "streak")


@query(sql("select cam, string_agg(edge_id, ',' order by ord) edge_ids from fx_camera_edges group by cam", "fx_camera_edges"))
def alert_edges(spark, sf_dir):
    rows = accident.alert_edges(fx.camera_edges(spark, sf_dir))
    return rows.select("cam", F.array_join(F.col("edge_ids").cast("array<string>"), ",").alias("edge_ids"))


@query(sql("""select i.event_id, i.cam, case when c.cam is null then cast(i.cam as varchar) else coalesce(c.description, '') end "location"
 from fx_incidents i left join (select * from fx_cameras where cam%7<>6) c using (cam)""", "fx_incidents fx_cameras"))
def join_location(spark, sf_dir):
    cameras = fx.cameras(spark, sf_dir).filter("cam%7<>6")
    return accident.join_location(fx.incidents(spark, sf_dir).select("event_id", "cam"), cameras)


_ALERT_RECORDS = alerts_sql("""select cast(a.cam as varchar) "camId", e.ids "edgeIds", a.class_name "className", round_even(a.conf * 1000, 0) / 1000 confidence,
 a.t ts, coalesce(c.description, '') "location" from alerts a join fx_cameras c using (cam)
 join (select cam, string_agg(edge_id, ',' order by ord) ids from fx_camera_edges group by cam) e using (cam) where a.fires""", "fx_cameras fx_camera_edges")


@query(_ALERT_RECORDS)
def sink_alerts(spark, sf_dir):
    records = traffic.accident_alerts(
        fx.incidents(spark, sf_dir), fx.camera_edges(spark, sf_dir), fx.cameras(spark, sf_dir), FIXTURE_INCIDENT_CONFIDENCE
    )
    path = scratch_path(spark, "alerts")
    for batch, part in ((0, "hash(camId) % 2 = 0"), (1, "hash(camId) % 2 <> 0"), (1, "hash(camId) % 2 <> 0")):  # the second one is repeated
        sinks.append_alerts(records.filter(part), path, "alerts", batch)
    edges = F.array_join(F.col("edgeIds").cast("array<string>"), ",")
    return sinks.read_alerts(spark, path).withColumn("edgeIds", edges)


@query(sql("""select cam, event_id, t, cam || '_' || t || '_' || class_name || '_' || printf('%.2f', conf) || '.jpg' file_name
 from accident_frames where hit""", "accident_frames"))
def suspect_catalog(spark, sf_dir):
    return accident.suspect_catalog(_incident_series(spark, sf_dir))


# ---- streams: table rows written as files in time order, then read as a stream ----
SLICES, FILES_PER_SLICE = 3, 2
# Rows of a file, which one task writes, and the fewest for each file that a slice is dealt to, so that none stays empty.
FILE_ROWS, LEAST_FILE_ROWS = 100_000, 1_000
# Boxes, or frames, that one task puts together to whole frames.
TASK_BOXES = 500_000


def _files_per_slice(slices: DataFrame) -> int:
    """Files of every slice of time (column ``slice``): as many for each, so that a micro-batch is a slice, and more for more rows."""
    most, least = slices.groupBy("slice").count().agg(F.max("count"), F.min("count")).first()
    return max(FILES_PER_SLICE, min(-(-(most or 0) // FILE_ROWS), (least or 0) // LEAST_FILE_ROWS))


def _as_stream(spark: SparkSession, rows: DataFrame, schema: str) -> DataFrame:
    """``rows`` as a file stream whose micro-batches are slices of time."""
    path = scratch_path(spark, "stream")
    rows = materialize(rows)
    start, end = rows.agg(F.min("t"), F.max("t")).first()
    width = (end - start) // SLICES + 1
    files = _files_per_slice(rows.select(F.floor((F.col("t") - start) / width).alias("slice")))
    for i in range(SLICES):
        part = rows.filter(F.col("t").between(start + i * width, start + (i + 1) * width - 1))
        part.repartition(files).write.mode("append").parquet(path)
    return jobs.file_stream(spark, path, schema, files)


def _outputs(spark: SparkSession) -> tuple[str, str]:
    return scratch_path(spark, "out"), scratch_path(spark, "progress")


def _edge_stream(spark, sf_dir) -> DataFrame:
    series = _series(spark, sf_dir).select("edge_id", "t", "event_id", "raw_speed", "free_flow")
    out, progress = _outputs(spark)
    stream = _as_stream(spark, series, schemas.EDGE_SERIES)
    jobs.stream_edge_speeds(stream, out, progress).awaitTermination()
    return spark.read.parquet(out)


@query(speeds_sql("select edge_id, event_id, t, prev_speed, ema, speed, status from speeds"))
def stream_edge_speeds(spark, sf_dir):
    return _edge_stream(spark, sf_dir).select("edge_id", "event_id", "t", "prev_speed", "ema", "speed", "status")


@query(speeds_sql("""select l.edge_id, l.real_event event_id, l.real_t t, s.prev_speed, s.ema, s.speed, s.status
 from speeds s join late_series l on l.edge_id = s.edge_id and l.event_id = s.rn""", "late_series"))
def stream_edge_speeds_late(spark, sf_dir):
    """Micro-batches some of whose rows are late, but within the watermark: they meet the stored state in order of arrival."""
    path, (out, progress) = scratch_path(spark, "stream"), _outputs(spark)
    series = materialize(arriving(_series(spark, sf_dir)).select("edge_id", "t", "event_id", "raw_speed", "free_flow", "run"))
    files = _files_per_slice(series.select(F.col("run").alias("slice")))
    for run in range(6):
        series.filter(F.col("run") == run).drop("run").repartition(files).write.mode("append").parquet(path)
    stream = jobs.file_stream(spark, path, schemas.EDGE_SERIES, files)
    jobs.stream_edge_speeds(stream, out, progress).awaitTermination()
    return spark.read.parquet(out).select("edge_id", "event_id", "t", "prev_speed", "ema", "speed", "status")


def _whole_frames(spark, sf_dir) -> DataFrame:
    """Frames with their boxes in one row."""
    frames, boxes = _frames_boxes(spark, sf_dir)
    entry = F.struct("cls", "conf", "x1", "y1", "x2", "y2")
    tasks = max(tasks_for(boxes, TASK_BOXES), tasks_for(frames, TASK_BOXES))  # also those that read the whole frames again
    held = boxes.repartition(tasks, "frame_id").groupBy("frame_id").agg(F.collect_list(entry).alias("boxes"))
    rows = frames.repartition(tasks, "frame_id").join(held, "frame_id", "left").withColumn("t", F.col("frame_id") * 7)
    rows = rows.withColumn("boxes", F.coalesce("boxes", F.array().cast(held.schema["boxes"].dataType)))
    return rows.select("cam", "frame_id", "t", "img_h", "img_w", "boxes")


def _traffic_stream(spark, sf_dir, mode: str) -> DataFrame:
    stream = _as_stream(spark, _whole_frames(spark, sf_dir), schemas.FRAME)
    out, progress = _outputs(spark)
    jobs.stream_traffic(
        stream, _mask(spark, sf_dir), dim.default_coefficients(spark), fx.camera_edges(spark, sf_dir), fx.free_flow(spark, sf_dir),
        fx.thresholds(spark, sf_dir), out, progress, mode=mode,
    ).awaitTermination()
    return spark.read.parquet(out).select("edge_id", "event_id", "t", "speed", "status")


@query(speeds_sql("select edge_id, event_id, t, speed, status from speeds", "frame_series"))
def stream_traffic(spark, sf_dir):
    """Whole frames with their boxes in, speeds and status out, in one streaming job."""
    return _traffic_stream(spark, sf_dir, "sequential")


@query(speeds_sql("select edge_id, event_id, t, speed, status from speeds", "frame_slices"))
def stream_traffic_batch_mode(spark, sf_dir):
    """As ``stream_traffic``; of an edge's rows in a micro-batch, which is a third of the time, the last one counts."""
    return _traffic_stream(spark, sf_dir, "batch")


@query(speeds_sql("select edge_id, count(*) n, count(*) filter (where prev_speed is null) cold_starts from speeds group by edge_id"))
def state_ttl_edges(spark, sf_dir):
    """Expired state makes an edge start anew; counted from the stream."""
    return _edge_stream(spark, sf_dir).groupBy("edge_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prev_speed").isNull()).alias("cold_starts")
    )


@query(sql("""select edge_id, t last_t, t + 900 cleared_t from (select edge_id, t, lead(t) over (partition by edge_id order by t, event_id) next,
 max(t) over () newest from series) where coalesce(next, newest - 60) - t > 900""", "series"))
def stream_cleared_edges(spark, sf_dir):
    """Edges that went stale, each told by its timer, or by its next write where that came first."""
    series = _series(spark, sf_dir).select("edge_id", "t", "event_id", "raw_speed", "free_flow")
    (out, progress), cleared = _outputs(spark), scratch_path(spark, "cleared")
    jobs.stream_edge_speeds(_as_stream(spark, series, schemas.EDGE_SERIES), out, progress, cleared=cleared).awaitTermination()
    return spark.read.parquet(cleared).drop("batch")


@query(sql("select o.frame_id, o.cam, o.occ, m.meu from frame_occ o join frame_meu m using (frame_id)", "frame_occ frame_meu"))
def stream_frame_metrics(spark, sf_dir):
    stream = _as_stream(spark, _whole_frames(spark, sf_dir), schemas.FRAME)
    out, progress = _outputs(spark)
    jobs.stream_frame_metrics(stream, _mask(spark, sf_dir), dim.default_coefficients(spark), out, progress).awaitTermination()
    return spark.read.parquet(out).select("frame_id", "cam", "occ", "meu")


def _alert_stream(spark, sf_dir) -> DataFrame:
    series = _incident_series(spark, sf_dir).select("cam", "t", "event_id", "class_name", "conf", "hit")
    out, progress = _outputs(spark)
    jobs.stream_accident_alerts(_as_stream(spark, series, schemas.INCIDENT_SERIES), out, progress).awaitTermination()
    return spark.read.parquet(out)


@query(alerts_sql("select cam, t, event_id, class_name, conf, streak from alerts where fires"))
def stream_accident_alerts(spark, sf_dir):
    return _alert_stream(spark, sf_dir).filter("fires").select("cam", "t", "event_id", "class_name", "conf", "streak")


@query(_ALERT_RECORDS)
def stream_alert_records(spark, sf_dir):
    """Published alerts straight from the stream."""
    series = _incident_series(spark, sf_dir).select("cam", "t", "event_id", "class_name", "conf", "hit")
    out, progress = _outputs(spark)
    stream = _as_stream(spark, series, schemas.INCIDENT_SERIES)
    jobs.stream_alert_records(stream, fx.camera_edges(spark, sf_dir), fx.cameras(spark, sf_dir), out, progress).awaitTermination()
    edges = F.array_join(F.col("edgeIds").cast("array<string>"), ",")
    return sinks.read_alerts(spark, out).withColumn("edgeIds", edges)


@query(sql("select cam, count(*) n, max(streak) longest, count(*) filter (where streak = 1) restarts from streaks group by cam", "streaks"))
def state_ttl_streak(spark, sf_dir):
    """Streaks that expired start at 1 again; counted from the stream."""
    return _alert_stream(spark, sf_dir).groupBy("cam").agg(
        F.count(F.lit(1)).alias("n"), F.max("streak").alias("longest"), F.count_if(F.col("streak") == 1).alias("restarts")
    )


@query(sql("select cam, count(*) frames, max(meu) meu_max from edge_obs group by cam", "edge_obs"))
def stream_calibration(spark, sf_dir):
    rows = _processed(spark, sf_dir).select("event_id", "cam", "t", "occ", "meu")
    out, progress = _outputs(spark)
    jobs.stream_camera_stats(_as_stream(spark, rows, schemas.OBSERVATION), out, progress).awaitTermination()
    return sinks.read_version(spark, out, sinks.latest_version(spark, out))


def _streamed_calibration(spark, sf_dir) -> tuple[str, str]:
    """Two calibration runs, each gathered by a stream."""
    frames = materialize(_whole_frames(spark, sf_dir))
    mask, limits = scratch_path(spark, "masks"), scratch_path(spark, "limits")
    for version, own in enumerate(("frame_id % 3 <> 0", "frame_id % 3 = 0")):
        gathered, progress = _outputs(spark)
        stream = _as_stream(spark, frames.filter(own), schemas.FRAME)
        jobs.stream_calibration(stream, dim.default_coefficients(spark), gathered, "run", progress).awaitTermination()
        batch.finish_calibration(spark, gathered, "run", mask, limits, version)
    return mask, limits


@query(_TWO_RUNS)
def stream_calibration_masks(spark, sf_dir):
    """Masks of two streamed runs; equal to those of ``calibration_two_runs``."""
    mask, _ = _streamed_calibration(spark, sf_dir)
    return batch.load_mask(spark, mask).runs.select("cam", "y", "xs", "xe")


@query(sql("""select cam, round_even(max(meu) filter (where frame_id % 3 = 0) * 100, 0) / 100 meu_max from frame_meu group by cam""", "frame_meu"))
def stream_calibration_limits(spark, sf_dir):
    """Load limits of the second of two streamed runs."""
    _, limits = _streamed_calibration(spark, sf_dir)
    return sinks.read_version(spark, limits, sinks.latest_version(spark, limits)).select("cam", "meu_max")


_LATE_FRAMES = "event_id % 40 = 3"


@query(sql(f"""select t//20*20 window_start, count(*) n_frames, min(cam) min_cam, max(cam) max_cam from (
  select *, max(t) over () newest from fx_observations where fetched)
 where not ({_LATE_FRAMES} and t < newest - 2000) and t//20*20 + 20 <= newest - 60 group by all""", "fx_observations"))
def stream_cycle_window(spark, sf_dir):
    """Cycles that the watermark has closed; some rows come long after theirs was and are dropped."""
    rows = fx.observations(spark, sf_dir).filter("fetched").select("event_id", "cam", "t", "occ", "meu")
    newest = rows.agg(F.max("t")).first()[0]
    late = F.expr(_LATE_FRAMES) & (F.col("t") < newest - 2000)
    path, (out, progress) = scratch_path(spark, "stream"), _outputs(spark)
    for part in (rows.filter((F.col("t") < newest - 1000) & ~late), rows.filter(F.col("t") >= newest - 1000), rows.filter(late)):
        part.repartition(FILES_PER_SLICE).write.mode("append").parquet(path)
    jobs.stream_cycle_window(jobs.file_stream(spark, path, schemas.OBSERVATION, FILES_PER_SLICE), out, progress).awaitTermination()
    return spark.read.parquet(out)


@query(sql("select event_id, cam, t, occ, meu from edge_obs", "edge_obs"))
def dedup_observations(spark, sf_dir):
    rows = _processed(spark, sf_dir).select("event_id", "cam", "t", "occ", "meu")
    out, progress = _outputs(spark)
    twice = _as_stream(spark, rows.unionAll(rows), schemas.OBSERVATION)
    jobs.stream_dedup(twice, out, progress).awaitTermination()
    return spark.read.parquet(out)
