"""Queries for sources, sinks, scalar functions, joins and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse import fixtures as fx
from roadpulse.functions import scalars as S
from roadpulse.operators import boxes, calibration, edge_state, geometry, metrics, report
from roadpulse.plans.registry import query, speeds_sql, sql
from roadpulse.session import materialize, scratch_path
from roadpulse.sources import cameras as cam_src
from roadpulse.sources import dimensions as dim
from roadpulse.sources import frames as frame_src
from roadpulse.sources import sinks

CAMERA_BASE_URL = "https://cameras.example/snapshot"
EPOCH_SHIFT = 1_700_000_000


def _camera_files(spark: SparkSession, sf_dir: str) -> str:
    """Nested camera JSON derived from the fixture cameras; some zones have no mapped edge."""
    zone = lambda edge, way, side: (
        f"named_struct('way_id', {way}, 'side', '{side}', 'mapped_edge', named_struct('edge_id', named_struct('value', cast({edge} as string)),"
        " 'edge_info', named_struct('shape', '_wdrS_mmojE')))"
    )
    mapped = f"'zone_0', {zone('cam*2', 'cam*10', 'left')}, 'zone_1', {zone('10000 + cam div 2', 'cam*10 + 1', 'right')}"
    unmapped = f"'zone_x', {zone('cast(null as bigint)', 'cam*10 + 2', 'left')}"
    zones = f"case when cam%13=12 then null when cam%5=0 then map({unmapped}, {mapped}) else map({mapped}) end"
    path = scratch_path(spark, "cameras")
    fx.cameras(spark, sf_dir).selectExpr(
        "cam ordinal", "cast(cam as string) cam_id", "description", f"{zones} zones"
    ).write.json(path)
    return path


def _json(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    df.write.json(path)
    return path


# ---- sources ----
@query(sql("""select cast(cam as varchar) cam_id, cam ordinal, description, 2 + (cam%5=0)::int n_zones
 from fx_cameras where cam%13<>12""", "fx_cameras"))
def src_cameras(spark, sf_dir):
    active = cam_src.active_cameras(cam_src.read_cameras(spark, _camera_files(spark, sf_dir)))
    return active.select("cam_id", "ordinal", "description", F.size("zones").alias("n_zones"))


@query(sql("select cast(cam as varchar) cam_id, cam ordinal from fx_cameras where cam%13<>12 order by cam limit 10", "fx_cameras"))
def camera_limit(spark, sf_dir):
    active = cam_src.active_cameras(cam_src.read_cameras(spark, _camera_files(spark, sf_dir)))
    return cam_src.camera_limit(active, "10").select("cam_id", "ordinal")


@query(sql("""select cast(cam as varchar) cam_id, ord + (cam%5=0)::int ord, edge_id, cam*10 + ord way_id,
 if(ord=0, 'left', 'right') direction from fx_camera_edges""", "fx_camera_edges"))
def src_camera_edges(spark, sf_dir):
    return cam_src.camera_edges(cam_src.read_cameras(spark, _camera_files(spark, sf_dir))).drop("ordinal")


@query(sql("""select cam cam_id, row_number() over (order by cam % 3, cam) - 1 ordinal, (row_number() over (order by cam % 3, cam) <= 25) first_25
 from (select distinct user_id cam from events)""", "fx_cameras"))
def src_cameras_ordinal(spark, sf_dir):
    """Position of every camera over three files, the last of which is the largest and so is read first."""
    path = scratch_path(spark, "camera-files")
    cams = fx.cameras(spark, sf_dir)
    for i, pad in enumerate((1, 3, 200)):
        part = cams.filter(F.col("cam") % 3 == i).orderBy("cam").selectExpr("cast(cam as string) cam_id", f"repeat('x', {pad}) description", "map('z', null) zones")
        part.coalesce(1).write.json(f"{path}/{i}")
    read = cam_src.read_cameras(spark, f"{path}/*")
    first = cam_src.camera_limit(read, "25").select("cam_id", F.lit(True).alias("first"))
    return read.join(first, "cam_id", "left").selectExpr("cast(cam_id as bigint) cam_id", "ordinal", "coalesce(first, false) first_25")


@query(sql("select edge_id, speed_kph from fx_free_flow", "fx_free_flow"))
def src_free_flow(spark, sf_dir):
    listed = fx.free_flow(spark, sf_dir)
    entries = listed.selectExpr("0L ordinal", "edge_id", "speed_kph + 5 speed_kph").unionAll(
        listed.selectExpr("1L", "edge_id", "speed_kph")
    )
    return dim.read_free_flow(spark, _json(spark, entries, "free-flow"))


@query(sql("""select d.cls, coalesce(c.coef, 0.0::double) coef, count(*) n_boxes from fx_detections d
 left join fx_coefficients c using (cls) group by all""", "fx_detections fx_coefficients"))
def src_meu_coefficients(spark, sf_dir):
    path = scratch_path(spark, "coefficients")
    stored = {str(cls): float(coef) for cls, coef in K.MEU_COEFFICIENTS.items()}
    spark.range(1).select(F.to_json(F.create_map(*[F.lit(v) for p in stored.items() for v in p])).alias("value")).write.text(path)
    counted = fx.detections(spark, sf_dir).groupBy("cls").agg(F.count(F.lit(1)).alias("n_boxes"))
    joined = metrics.join_coefficients(counted, dim.read_meu_coefficients(spark, path))
    return joined.select("cls", F.col("coef").cast("double").alias("coef"), "n_boxes")


@query(sql("""select cast(c.cam as varchar) cam_id, case when h.cam is null then 1.0::double else h.meu_max end meu_max,
 case when h.cam is null then 1.0::double when h.cam%2=0 then 35.0::double end or_max,
 case when h.cam is null then 1.0::double end hci_max from fx_cameras c left join fx_thresholds h using (cam)""",
 "fx_cameras fx_thresholds"))
def src_thresholds(spark, sf_dir):
    stored = fx.thresholds(spark, sf_dir).selectExpr("cast(cam as string) cam_id", "meu_max meuMax", "if(cam%2=0, 35d, null) orMax")
    read = dim.read_thresholds(spark, _json(spark, stored, "thresholds"))
    return dim.thresholds_or_default(fx.cameras(spark, sf_dir).selectExpr("cast(cam as string) cam_id"), read)


@query(sql("""select event_id, case when meu_max > 0 then 0.7::double * (meu / meu_max) + 0.3::double * (occ / 35.0::double)
 else 0.0::double end hci from weighted""", "weighted"))
def src_hci_weights(spark, sf_dir):
    path = _json(spark, spark.range(1).selectExpr("0.7d w1", "0.3d w2"), "hci")
    w1, w2 = dim.read_hci_weights(spark, path)
    rows = _weighted(spark, sf_dir)
    return rows.select("event_id", S.hybrid_congestion("meu", "occ", "meu_max", F.lit(35.0), w1, w2).alias("hci"))


@query(sql("""select doc_id, octet_length(content) n_bytes from fx_images where octet_length(content) > 5000
 and hex(content) like 'FFD8%' and hex(content) like '%FFD9'""", "fx_images"))
def src_frames_valid(spark, sf_dir):
    return frame_src.valid_frames(fx.images(spark, sf_dir)).select("doc_id", F.octet_length("content").cast("bigint").alias("n_bytes"))


@query(sql("""select doc_id, case when content_type not like 'image/%' then 422 when octet_length(content) = 0 then 422
 when octet_length(content) > 20000 then 413 when hex(content) like 'FFD8%' or hex(content) like '89504E470D0A1A0A%' or hex(content) like '474946383761%' or hex(content) like '474946383961%'
  or hex(content) like '424D%' or hex(content) like '49492A00%' or hex(content) like '4D4D002A%' or hex(content) like '52494646________57454250%' then 200 else 400 end status from fx_images""", "fx_images"))
def image_intake_status(spark, sf_dir):
    return frame_src.with_intake_status(fx.images(spark, sf_dir), 20_000).select("doc_id", "status")


@query(sql("select frame_id, cls, conf, x1, y1, x2, y2 from fx_detections where conf >= 0.3::double", "fx_detections"))
def src_detections(spark, sf_dir):
    path = scratch_path(spark, "detections")
    fx.detections(spark, sf_dir).write.parquet(path)
    rows = frame_src.read_detections(spark, path, K.VEHICLE_CONFIDENCE)
    return rows.select("frame_id", "cls", "conf", "x1", "y1", "x2", "y2")


@query(sql("""select cam, 'https://cameras.example/snapshot?id=' || cam || '&bg=black&w=500&h=500&t=1700000000000' url
 from fx_cameras""", "fx_cameras"))
def camera_url(spark, sf_dir):
    return fx.cameras(spark, sf_dir).select("cam", cam_src.camera_url(CAMERA_BASE_URL, "cam", F.lit(1_700_000_000_000)).alias("url"))


# ---- boxes ----
@query(sql("select frame_id, cls, x1, y1, x2, y2 from px_boxes", "px_boxes"))
def clip_boxes_px(spark, sf_dir):
    return boxes.clip_boxes_px(fx.detections(spark, sf_dir)).select("frame_id", "cls", "x1", "y1", "x2", "y2")


@query(sql("""select * from (select frame_id, cls, greatest(0, least(x1, img_w)) x1, greatest(0, least(y1, img_h)) y1,
 greatest(0, least(x2, img_w)) x2, greatest(0, least(y2, img_h)) y2 from fx_detections) where x2 > x1 and y2 > y1""", "fx_detections"))
def clip_boxes_float(spark, sf_dir):
    return boxes.clip_boxes_float(fx.detections(spark, sf_dir)).select("frame_id", "cls", "x1", "y1", "x2", "y2")


@query(sql("""select frame_id, cls, case cls when 0 then 'motorcycle' when 1 then 'car' when 2 then 'bus' when 3 then 'truck'
 else cast(cls as varchar) end label from fx_detections""", "fx_detections"))
def class_label(spark, sf_dir):
    return fx.detections(spark, sf_dir).select("frame_id", "cls", boxes.class_label("cls").alias("label"))


@query(sql("select * from fx_incidents where class_name in ('human_incident', 'vehicle_incident')", "fx_incidents"))
def incident_filter(spark, sf_dir):
    return boxes.incident_filter(fx.incidents(spark, sf_dir))


# ---- scalar functions over observations ----
def _weighted(spark, sf_dir) -> DataFrame:
    """Processed observations of known cameras with their load limit and density."""
    rows = metrics.join_thresholds(_processed(spark, sf_dir), fx.thresholds(spark, sf_dir))
    return rows.withColumn("twf", S.traffic_weight("occ", "meu", "meu_max"))


def _processed(spark, sf_dir) -> DataFrame:
    known = fx.cameras(spark, sf_dir).filter("known")
    return report.known_cameras(fx.observations(spark, sf_dir).filter("fetched"), known)


@query(sql("select event_id, twf from weighted", "weighted"))
def twf(spark, sf_dir):
    return _weighted(spark, sf_dir).select("event_id", "twf")


@query(sql("""select event_id, case when occ <= 70 then 0.0::double when occ >= 90 then d
 else (occ - 70.0::double) / 20.0::double * d end twf_ramp
 from (select *, case when meu_max > 0 then least(meu / meu_max, 1.0::double) else 0.0::double end d from weighted)""", "weighted"))
def twf_ramp(spark, sf_dir):
    return _weighted(spark, sf_dir).select("event_id", S.traffic_weight_ramp("occ", "meu", "meu_max").alias("twf_ramp"))


# Weights of load and occupancy in the congestion index, for the queries and their check alike.
HCI_LOAD, HCI_OCCUPANCY = 0.7, 0.3
_HCI = f"""select *, case when meu_max > 0 then {HCI_LOAD}::double * (meu / meu_max) + {HCI_OCCUPANCY}::double * (occ / 35.0::double)
 else 0.0::double end hci from weighted"""


@query(sql(f"select event_id, hci from ({_HCI})", "weighted"))
def hci(spark, sf_dir):
    value = S.hybrid_congestion("meu", "occ", "meu_max", F.lit(35.0), HCI_LOAD, HCI_OCCUPANCY)
    return _weighted(spark, sf_dir).select("event_id", value.alias("hci"))


@query(sql(f"""select event_id, case when occ < 85 then 1.0::double when hci / 2.0::double >= 0.9::double then 0.1::double
 when hci / 2.0::double >= 0.8::double then 0.5::double else 1.0::double end cost_tier from ({_HCI})""", "weighted"))
def cost_tier(spark, sf_dir):
    value = S.hybrid_congestion("meu", "occ", "meu_max", F.lit(35.0), HCI_LOAD, HCI_OCCUPANCY)
    rows = _weighted(spark, sf_dir).withColumn("hci", value)
    return rows.select("event_id", S.cost_tier("occ", "hci", F.lit(2.0)).alias("cost_tier"))


@query(sql("select edge_id, event_id, free_flow, raw_speed from series", "series"))
def greenshields_speed(spark, sf_dir):
    return _series(spark, sf_dir).select("edge_id", "event_id", "free_flow", "raw_speed")


@query(sql("""select edge_id, ((edge_id::bigint * 33554432 + edge_id::bigint % 1000) & 33554431) tile,
 (edge_id::bigint * 33554432 + edge_id::bigint % 1000) >> 25 idx from first_zones""", "first_zones"))
def graph_id_parts(spark, sf_dir):
    edges = geometry.first_geometry_per_edge(fx.zones(spark, sf_dir))
    graph_id = F.expr("cast(edge_id as bigint) * 33554432 + cast(edge_id as bigint) % 1000")
    return edges.select("edge_id", S.graph_tile(graph_id).alias("tile"), S.graph_index(graph_id).alias("idx"))


@query(sql("""select o.event_id, coalesce(round_even(w.meu / 2, 0)::int, 127) code from fx_observations o
 left join edge_obs w using (event_id)""", "fx_observations edge_obs"))
def speed_code(spark, sf_dir):
    done = _processed(spark, sf_dir).select("event_id", F.col("meu").alias("speed"))
    return fx.observations(spark, sf_dir).select("event_id").join(done, "event_id", "left").select(
        "event_id", S.speed_code("speed").alias("code")
    )


@query(sql("""select event_id, case when event_id%11 in (0,1,2,7,9) then tenths / 10.0::double when event_id%11 = 6 then -(tenths / 10.0::double)
 when event_id%11 = 8 then tenths * 10.0::double end speed, case when event_id%11 in (0,1,2,6,8,9) then ts else -1 end::bigint ts,
 case event_id%11 when 0 then 'RED' when 6 then 'GREEN' when 7 then 'YELLOW' when 8 then 'GREEN' when 9 then 'YELLOW' end status from fx_state_strings""", "fx_state_strings"))
def parse_state(spark, sf_dir):
    return fx.state_strings(spark, sf_dir).select("event_id", S.parse_state("raw").alias("s")).select(
        "event_id", "s.speed", F.coalesce("s.ts", F.lit(-1).cast("bigint")).alias("ts"), "s.status"
    )


# ---- joins ----
@query(sql("""select d.frame_id, d.cls, coalesce(c.coef, 0.0::double) coef, d.x1, d.y1 from fx_detections d
 left join fx_coefficients c using (cls)""", "fx_detections fx_coefficients"))
def join_coefficients(spark, sf_dir):
    joined = metrics.join_coefficients(fx.detections(spark, sf_dir), dim.default_coefficients(spark))
    return joined.select("frame_id", "cls", F.col("coef").cast("double").alias("coef"), "x1", "y1")


@query(sql("select event_id, cam, meu_max from weighted", "weighted"))
def join_thresholds(spark, sf_dir):
    return metrics.join_thresholds(_processed(spark, sf_dir), fx.thresholds(spark, sf_dir)).select("event_id", "cam", "meu_max")


@query(sql("select o.event_id, o.cam, e.ord, e.edge_id from fx_observations o join fx_camera_edges e using (cam)", "fx_observations fx_camera_edges"))
def fanout_edges(spark, sf_dir):
    rows = metrics.fanout_edges(fx.observations(spark, sf_dir), fx.camera_edges(spark, sf_dir))
    return rows.select("event_id", "cam", "ord", "edge_id")


@query(sql("""select e.cam, e.ord, e.edge_id, coalesce(f.speed_kph, 50.0::double) free_flow from fx_camera_edges e
 left join fx_free_flow f using (edge_id)""", "fx_camera_edges fx_free_flow"))
def join_free_flow(spark, sf_dir):
    return metrics.join_free_flow(fx.camera_edges(spark, sf_dir), fx.free_flow(spark, sf_dir)).select("cam", "ord", "edge_id", "free_flow")


@query(sql("select event_id, cam from fx_observations semi join known using (cam)", "fx_observations known"))
def known_cameras(spark, sf_dir):
    return report.known_cameras(fx.observations(spark, sf_dir), fx.cameras(spark, sf_dir).filter("known")).select("event_id", "cam")


@query(sql("select event_id, cam from fx_observations anti join known using (cam)", "fx_observations known"))
def unknown_cameras(spark, sf_dir):
    return report.unknown_cameras(fx.observations(spark, sf_dir), fx.cameras(spark, sf_dir).filter("known")).select("event_id", "cam")


@query(sql("""select c.cam, count(e.edge_id) n_edges, count(e.edge_id) > 0 accident_eligible from fx_cameras c
 left join fx_camera_edges e using (cam) group by c.cam""", "fx_cameras fx_camera_edges"))
def has_edges(spark, sf_dir):
    return report.has_edges(fx.cameras(spark, sf_dir), fx.camera_edges(spark, sf_dir))


_EXISTING = "select cam, meu_max, 35.0::double or_max, if(cam%2=0, 1.0::double, null) hci_max from fx_thresholds"
_STATS = """select cam, count(*) frames, round_even(max(meu) * 100, 0) / 100 meu_max from fx_observations
 where fetched and cam%4<>3 group by cam"""
_MERGED = f"""select cam, coalesce(s.meu_max, e.meu_max) meu_max, e.or_max, e.hci_max
 from ({_EXISTING}) e full join ({_STATS}) s using (cam)"""


def _merged(spark, sf_dir) -> DataFrame:
    existing = fx.thresholds(spark, sf_dir).selectExpr("cam", "meu_max", "35d or_max", "if(cam%2=0, 1d, null) hci_max")
    stats = calibration.calibration_stats(fx.observations(spark, sf_dir).filter("fetched and cam%4<>3"))
    return calibration.merge_thresholds(existing, stats)


@query(sql(_MERGED, "fx_thresholds fx_observations"))
def merge_thresholds(spark, sf_dir):
    return _merged(spark, sf_dir)


# ---- reports ----
@query(sql("""select batch_id cycle_id, count(*) filter (where ok) ok, count(*) filter (where not ok) fail, count(*) total,
 max(t) - min(t) elapsed from (select o.*, o.fetched and k.cam is not null and o.batch_id % 11 <> 3 and o.event_id % 13 <> 5 and (cam // 2) % 17 <> 4 ok from fx_observations o left join known k using (cam))
 group by batch_id""", "fx_observations known"))
def cycle_stats(spark, sf_dir):
    """Some batches fail as a whole, some images don't fit their mask, and some cameras have an edge without free flow."""
    seen, edges = fx.observations(spark, sf_dir), fx.camera_edges(spark, sf_dir)
    stopped = seen.filter("(cam div 2) % 17 = 4").select(F.expr("cast(10000 + cam div 2 as string)").alias("edge_id"), F.lit(0.0).alias("speed_kph")).distinct()
    free_flow = fx.free_flow(spark, sf_dir).join(stopped, "edge_id", "left_anti").unionByName(stopped)
    edges = edges.unionByName(seen.filter("(cam div 2) % 17 = 4 and cam % 13 = 12").select("cam", F.lit(1).alias("ord"), F.expr("cast(10000 + cam div 2 as string)").alias("edge_id")).distinct(), allowMissingColumns=True)
    failing = metrics.failing_cameras(edges, free_flow)
    batches, misfits = seen.filter("batch_id % 11 = 3").select("batch_id"), seen.filter("event_id % 13 = 5").select("event_id")
    return report.cycle_stats(seen, fx.cameras(spark, sf_dir).filter("known"), failing, batches, misfits)


_QUEUE = """
 select *, (row_number() over (order by t, marker, event_id) - 1) // 100 batch from (
  select event_id, cam, t, fetched, 0 marker from fx_observations
  union all select -batch_id, null, max(t), null, 1 from fx_observations where batch_id % 5 = 2 group by batch_id)"""


@query(sql(f"""select cycle cycle_id, count(*) filter (where ok) ok, count(*) filter (where marker = 0 and not ok) fail, count(*) filter (where marker = 0) total,
 count(distinct batch) batches, max(marker) = 1 ended, max(t) - coalesce(lag(max(t)) over (order by cycle), min(min(t)) over ()) elapsed
 from (select q.*, marker = 0 and fetched and k.cam is not null and not exists (select 1 from fx_free_flow f join fx_camera_edges e using (edge_id) where e.cam = q.cam and f.speed_kph = 0) ok,
  c.cycle from ({_QUEUE}) q left join known k using (cam)
  join (select batch, coalesce(sum(ended) over (order by batch rows between unbounded preceding and 1 preceding), 0)::bigint cycle
   from (select batch, max(marker) ended from ({_QUEUE}) group by batch)) c using (batch))
 group by cycle""", "fx_observations known fx_free_flow fx_camera_edges"))
def cycle_stats_marked(spark, sf_dir):
    """Cycles of a queue that hold markers now and then, over batches of a hundred ids."""
    seen = fx.observations(spark, sf_dir)
    ids = seen.selectExpr("event_id", "cam", "t", "fetched", "0 marker", "cast(cam as string) item")
    markers = seen.filter("batch_id % 5 = 2").groupBy("batch_id").agg(F.max("t").alias("t")).selectExpr("-batch_id event_id", "t", "1 marker", f"'{K.CYCLE_SENTINEL}' item")
    queue = ids.unionByName(markers, allowMissingColumns=True)
    failing = metrics.failing_cameras(fx.camera_edges(spark, sf_dir), fx.free_flow(spark, sf_dir))
    return report.marked_cycle_stats(queue, ["t", "marker", "event_id"], fx.cameras(spark, sf_dir).filter("known"), failing, stretch=7)


@query(sql("""select batch_id, count(*) n_ids, batch_id%2=0 sentinel from fx_observations group by batch_id""", "fx_observations"))
def drop_sentinel(spark, sf_dir):
    seen = fx.observations(spark, sf_dir)
    ids = seen.selectExpr("batch_id", "cast(cam as string) item")
    markers = seen.filter("batch_id%2=0").select("batch_id").distinct().withColumn("item", F.lit(K.CYCLE_SENTINEL))
    return report.drop_sentinel(ids.unionByName(markers))[1]


@query(sql("""select t//20*20 window_start, count(*) n_frames, min(cam) min_cam, max(cam) max_cam from fx_observations
 where fetched group by all""", "fx_observations"))
def cycle_window(spark, sf_dir):
    rows = fx.observations(spark, sf_dir).filter("fetched").withColumn("ts", F.timestamp_seconds("t"))
    return report.cycle_window(rows)


@query(sql("""select batch_id, backlog, backlog <= 0.5 * (select count(*) from fx_cameras) admitted
 from (select batch_id, count(*) * (batch_id % 40) backlog from fx_observations group by batch_id)""", "fx_observations fx_cameras"))
def admission_control(spark, sf_dir):
    backlog = fx.observations(spark, sf_dir).groupBy("batch_id").agg((F.count(F.lit(1)) * (F.col("batch_id") % 40)).alias("backlog"))
    return report.admission_control(backlog, fx.cameras(spark, sf_dir).count())


@query(sql("""select cast(cam as varchar) cam_id, count(*) frames from fx_observations where fetched group by cam
 having count(*) < 50""", "fx_observations"))
def low_frame_cameras(spark, sf_dir):
    return calibration.low_frame_cameras(calibration.calibration_stats(fx.observations(spark, sf_dir).filter("fetched")))


@query(sql("""select max(n) n_low, string_agg(cam_id, ', ' order by cam_id) || case when max(n) > 20 then '...' else '' end preview
 from (select cast(cam as varchar) cam_id, count(*) over () n from fx_observations where fetched group by cam
  having count(*) < 50 order by cam_id limit 20)""", "fx_observations"))
def low_frame_preview(spark, sf_dir):
    stats = calibration.calibration_stats(fx.observations(spark, sf_dir).filter("fetched"))
    return calibration.low_frame_preview(calibration.low_frame_cameras(stats))


# ---- sinks, each read back ----
@query(sql("""select strftime(make_timestamp((t + 1700000000) * 1000000) + interval 7 hour, '%Y-%m-%d %H:%M:%S') "timestamp",
 cast(cam as varchar) "cameraId", round_even(occ * 100, 0) / 100 "preciseOccupancy", round_even(meu * 100, 0) / 100 meu,
 round_even(twf * 100, 0) / 100 twf from weighted""", "weighted"))
def sink_history_log(spark, sf_dir):
    """Two batches appended, the second one twice, as after a failure."""
    path = scratch_path(spark, "history")
    rows = materialize(_weighted(spark, sf_dir).withColumn("t", F.col("t") + EPOCH_SHIFT))
    for batch, part in ((0, "event_id % 2 = 0"), (1, "event_id % 2 = 1"), (1, "event_id % 2 = 1")):
        sinks.append_history(rows.filter(part), path, "history", batch)
    return sinks.read_history(spark, path)


@query(sql(_MERGED, "fx_thresholds fx_observations"))
def sink_thresholds(spark, sf_dir):
    path = scratch_path(spark, "limits")
    sinks.publish_version(_merged(spark, sf_dir), path, 0)
    return sinks.read_version(spark, path, sinks.latest_version(spark, path))


@query(sql("select edge_id, count(*) n_points, sum(i)::bigint last_i, max(lat) max_lat, max(lon) max_lon from zone_points group by edge_id", "zone_points"))
def sink_geometry(spark, sf_dir):
    path = scratch_path(spark, "geometry")
    sinks.write_geometry(geometry.edge_geometry(fx.zones(spark, sf_dir)), path)
    points = sinks.read_geometry(spark, path).select("edge_id", F.posexplode("points").alias("i", "p"))
    return points.groupBy("edge_id").agg(
        F.count(F.lit(1)).alias("n_points"), F.sum("i").alias("last_i"),
        F.max(F.col("p")[0]).alias("max_lat"), F.max(F.col("p")[1]).alias("max_lon"),
    )


# ---- geometry ----
@query(sql("select edge_id, ord, shape from first_zones", "first_zones"))
def first_geometry_per_edge(spark, sf_dir):
    return geometry.first_geometry_per_edge(fx.zones(spark, sf_dir))


@query(sql("select edge_id, i, lat, lon from zone_points", "zone_points"))
def polyline_points(spark, sf_dir):
    points = geometry.polyline_points(geometry.first_geometry_per_edge(fx.zones(spark, sf_dir)))
    return points.withColumn("i", F.col("i").cast("bigint"))


@query(sql("""select edge_id, lat lat0, lon lon0, not (lat between 9.5 and 11.5 and lon between 105.5 and 107.5) out_of_range
 from zone_points where i = 0""", "zone_points"))
def geo_range_flag(spark, sf_dir):
    return geometry.geo_range_flag(geometry.first_geometry_per_edge(fx.zones(spark, sf_dir)))


@query(sql("""select count(*) zones_seen, count(*) filter (where edge_id is null) no_edge_id,
 count(*) filter (where edge_id is not null and shape is null) no_shape,
 (select count(*) from usable_zones) - (select count(*) from first_zones) duplicates,
 (select count(*) from first_zones) written, (select count(*) from first_zones where not prefixed) out_of_range from fx_zones""",
 "fx_zones usable_zones first_zones"))
def geometry_stats(spark, sf_dir):
    return geometry.geometry_stats(fx.zones(spark, sf_dir))


@query(sql("select count(distinct cam) cameras from fx_zones", "fx_zones"))
def geometry_cameras(spark, sf_dir):
    return geometry.camera_count(fx.zones(spark, sf_dir))


# ---- edge state ----
def _series(spark, sf_dir) -> DataFrame:
    return edge_state.edge_series(
        _processed(spark, sf_dir), fx.camera_edges(spark, sf_dir), fx.free_flow(spark, sf_dir), fx.thresholds(spark, sf_dir)
    )


def _speeds(spark, sf_dir, mode: str = "sequential") -> DataFrame:
    return edge_state.speed_and_status(_series(spark, sf_dir), mode)


def _newest(spark, sf_dir) -> int:
    """Time of the last processed observation, the moment the state is looked at."""
    return _processed(spark, sf_dir).agg(F.max("t")).first()[0]


_LATEST = "select edge_id, speed, t, status from speeds qualify row_number() over (partition by edge_id order by t desc, event_id desc) = 1"
_AS_OF = "(select max(t) from edge_obs)"


@query(sql("select edge_id, event_id, batch_id, t, raw_speed from last_series", "last_series"))
def batch_last_writer(spark, sf_dir):
    return edge_state.batch_last_writer(_series(spark, sf_dir)).select("edge_id", "event_id", "batch_id", "t", "raw_speed")


@query(speeds_sql("select edge_id, event_id, t, raw_speed, ema, speed from speeds"))
def speed_ema(spark, sf_dir):
    return _speeds(spark, sf_dir).select("edge_id", "event_id", "t", "raw_speed", "ema", "speed")


@query(speeds_sql("select edge_id, event_id, t, free_flow, status from speeds"))
def traffic_status(spark, sf_dir):
    return _speeds(spark, sf_dir).select("edge_id", "event_id", "t", "free_flow", "status")


@query(speeds_sql("select edge_id, event_id, t, ema, speed, status from speeds", "last_series"))
def speed_status_batch_mode(spark, sf_dir):
    return _speeds(spark, sf_dir, "batch").select("edge_id", "event_id", "t", "ema", "speed", "status")


@query(speeds_sql("select edge_id, event_id, t, prev_speed, prev_status, coalesce(prev_t, -1) prev_t from speeds"))
def prev_state_asof(spark, sf_dir):
    speeds = materialize(_speeds(spark, sf_dir))
    found = edge_state.prev_state_asof(speeds, speeds)
    return found.select("edge_id", "event_id", "t", "prev_speed", "prev_status", F.coalesce("prev_t", F.lit(-1).cast("bigint")).alias("prev_t"))


@query(speeds_sql("""select p.edge_id, p.t, case when p.t - h.t < 1200 then h.speed end speed, case when p.t - h.t < 1200 then h.status end status,
 coalesce(case when p.t - h.t < 1200 then h.t end, -1) state_t from (
  select e.edge_id, g.t from (select distinct edge_id from fx_camera_edges) e,
   (select unnest(range((select min(t) - 100 from edge_obs), (select max(t) + 1500 from edge_obs), 333)) t) g) p
 asof left join (select * from speeds qualify row_number() over (partition by edge_id, t order by event_id desc) = 1) h on p.edge_id = h.edge_id and p.t >= h.t""", "series", "fx_camera_edges edge_obs"))
def state_asof_probes(spark, sf_dir):
    """Stored state of every edge at moments of a fixed rhythm, most of which have no observation."""
    low, high = _processed(spark, sf_dir).agg(F.min("t"), F.max("t")).first()
    edges = fx.camera_edges(spark, sf_dir).select("edge_id").distinct()
    probes = edges.select("edge_id", F.lit(None).cast("bigint").alias("event_id"), F.explode(F.sequence(F.lit(low - 100), F.lit(high + 1499), F.lit(333).cast("bigint"))).alias("t"))
    found = edge_state.prev_state_asof(probes, materialize(_speeds(spark, sf_dir)))
    return found.select("edge_id", "t", F.col("prev_speed").alias("speed"), F.col("prev_status").alias("status"), F.coalesce("prev_t", F.lit(-1).cast("bigint")).alias("state_t"))


@query(speeds_sql("select edge_id, event_id, t, prev_status from_status, status to_status from speeds where prev_status <> status"))
def status_changes(spark, sf_dir):
    return edge_state.status_changes(_speeds(spark, sf_dir))


@query(speeds_sql(_LATEST))
def sink_edge_speeds(spark, sf_dir):
    path = scratch_path(spark, "edge-speeds")
    speeds = materialize(_speeds(spark, sf_dir))
    half = _newest(spark, sf_dir) - 12_000
    sinks.upsert_latest(edge_state.latest_state(speeds.filter(F.col("t") <= half)), path, 0, "edge_id", "t")
    sinks.upsert_latest(edge_state.latest_state(speeds.filter(F.col("t") > half)), path, 1, "edge_id", "t")
    return sinks.read_version(spark, path, sinks.latest_version(spark, path)).drop("event_id")


@query(speeds_sql("select edge_id, event_id, t, prev_speed, ema, speed, status from speeds"))
def speed_ema_resumed(spark, sf_dir):
    """The same series in two runs, the second going on from the stored state of the first."""
    series = _series(spark, sf_dir)
    half = _newest(spark, sf_dir) - 12_000
    first = materialize(edge_state.speed_and_status(series.filter(F.col("t") <= half)))
    state = materialize(edge_state.expire_state(edge_state.latest_state(first)))
    second = edge_state.speed_and_status(series.filter(F.col("t") > half), previous=state)
    return first.unionByName(second).select("edge_id", "event_id", "t", "prev_speed", "ema", "speed", "status")


HOT_TEST_CHUNKS = 48


@query(speeds_sql("select edge_id, event_id, t, prev_speed, ema, speed, status from speeds"))
def speed_ema_hot(spark, sf_dir):
    """Most edges take the way of hot keys, at any scale."""
    speeds = edge_state.speed_and_status(_series(spark, sf_dir), hot_rows=_hot_rows(_series(spark, sf_dir)), max_chunks=HOT_TEST_CHUNKS)
    return speeds.select("edge_id", "event_id", "t", "prev_speed", "ema", "speed", "status")


def _hot_rows(series: DataFrame, parts: int = 1) -> int:
    """A limit that most edges pass at any scale: a quarter of the median rows of an edge, in one of ``parts`` like parts."""
    counts = series.groupBy("edge_id").count()
    return max(2, counts.agg(F.percentile_approx("count", 0.5)).first()[0] // (4 * parts)) if not counts.isEmpty() else 2


@query(speeds_sql("""select l.edge_id, l.real_event event_id, l.real_t t, s.prev_speed, s.ema, s.speed, s.status
 from speeds s join late_series l on l.edge_id = s.edge_id and l.event_id = s.rn""", "late_series"))
def speed_ema_resumed_hot(spark, sf_dir):
    """Six runs that go on from each other's state; some rows come a run late, and most edges are hot keys in each."""
    series = materialize(arriving(_series(spark, sf_dir)))
    hot_rows = _hot_rows(series, 6)
    done, state = [], None
    for run in range(6):
        rows = series.filter(F.col("run") == run).drop("run")
        done.append(materialize(edge_state.speed_and_status(rows, hot_rows=hot_rows, previous=state, max_chunks=HOT_TEST_CHUNKS)))
        state = materialize(edge_state.carried_state(done[-1], state))
    both = done[0]
    for part in done[1:]:
        both = both.unionByName(part)
    return both.select("edge_id", "event_id", "t", "prev_speed", "ema", "speed", "status")


def arriving(series: DataFrame) -> DataFrame:
    """``series`` with the slice of time (``run``) that each row arrives in, late for some of a slice's last moments."""
    low, high = series.agg(F.min("t"), F.max("t")).first()
    width = (high - low) // 6 + 1
    own = F.floor((F.col("t") - low) / width)
    late = (F.col("event_id") % 3 == 0) & (own < 5) & ((F.col("t") - low) % width >= width - 50)
    return series.withColumn("run", (own + late.cast("int")).cast("int"))


@query(speeds_sql(f"select edge_id, printf('%.1f', speed) || ':' || t || ':' || status wire from ({_LATEST})"))
def edge_speed_wire(spark, sf_dir):
    return edge_state.edge_speed_wire(edge_state.latest_state(_speeds(spark, sf_dir)))


@query(speeds_sql(f"select edge_id, speed, t, status from ({_LATEST}) where {_AS_OF} - t <= 900"))
def fresh_edges(spark, sf_dir):
    return edge_state.fresh_edges(edge_state.latest_state(_speeds(spark, sf_dir)), _newest(spark, sf_dir)).drop("event_id")


_ACTIVE = "select edge_id from (select edge_id, max(t) t from series where t <= {at} group by edge_id) where {at} - t <= 900"


@query(sql(f"{_ACTIVE.format(at=f'({_AS_OF} - 600)')} except {_ACTIVE.format(at=_AS_OF)}", "series edge_obs"))
def cleared_edges(spark, sf_dir):
    now = _newest(spark, sf_dir)
    speeds = materialize(_speeds(spark, sf_dir))
    active = lambda at: edge_state.fresh_edges(edge_state.state_at(speeds, at), at)
    return edge_state.cleared_edges(active(now - 600), active(now))


@query(speeds_sql(f"""select count(l.edge_id) n_live, count(*) n_edges, count(l.edge_id)::double / count(*)::double coverage
 from (select distinct edge_id from fx_camera_edges) e
 left join (select edge_id from ({_LATEST}) where {_AS_OF} - t <= 900) l using (edge_id)"""))
def edge_coverage(spark, sf_dir):
    live = edge_state.fresh_edges(edge_state.latest_state(_speeds(spark, sf_dir)), _newest(spark, sf_dir))
    return edge_state.edge_coverage(live, fx.camera_edges(spark, sf_dir))


@query(speeds_sql(f"""select min({_AS_OF} - t) min_lag, sum({_AS_OF} - t)::double / count(*)::double avg_lag, max({_AS_OF} - t) max_lag
 from ({_LATEST})"""))
def freshness_lag(spark, sf_dir):
    return edge_state.freshness_lag(edge_state.latest_state(_speeds(spark, sf_dir)), _newest(spark, sf_dir))
