"""Named queries over the test tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadpulse.fixtures import DUCKDB

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Derived tables used by several checks, in an order in which each may use those before it.
DERIVED = {
    "px_boxes": """
select * from (select frame_id, cam, cls, conf, img_h, img_w,
  greatest(0, least(round_even(x1, 0)::int, img_w - 1)) x1, greatest(0, least(round_even(x2, 0)::int, img_w - 1)) x2,
  greatest(0, least(round_even(y1, 0)::int, img_h - 1)) y1, greatest(0, least(round_even(y2, 0)::int, img_h - 1)) y2
 from fx_detections) where x2 > x1 and y2 > y1""",
    "box_px": """
select frame_id, cam, y, unnest(range(x1, x2)) x
from (select frame_id, cam, x1, x2, unnest(range(y1, y2)) y from px_boxes)""",
    "heat_px": "select cam, y, x, count(*) hits from box_px group by all",
    "heat_runs": """
select cam, y, min(x) xs, max(x) + 1 xe, any_value(hits) hits
from (select *, sum(brk) over (partition by cam, y order by x) run
 from (select *, case when lag(x) over w = x - 1 and lag(hits) over w = hits then 0 else 1 end brk
  from heat_px window w as (partition by cam, y order by x)))
group by cam, y, run""",
    "frame_counts": "select cam, count(*) n from fx_frames group by cam",
    "mask_px": """
select h.cam, h.y, h.x from heat_px h join frame_counts c using (cam)
where h.hits >= greatest(1, round_even(c.n * 0.30::double, 0))""",
    "mask_runs": """
select cam, y, min(x) xs, max(x) + 1 xe
from (select cam, y, x, x - row_number() over (partition by cam, y order by x) run from mask_px)
group by cam, y, run""",
    "mask_area": """
select c.cam, coalesce(m.n, 0) road_px
from frame_counts c left join (select cam, count(*) n from mask_px group by cam) m using (cam)""",
    "vehicle_px": "select distinct frame_id, cam, y, x from box_px",
    "frame_occ": """
select f.frame_id, f.cam, f.img_h, f.img_w,
 coalesce(case when a.road_px > 0 then coalesce(v.n, 0)::double / a.road_px::double * 100 end, 0.0::double) occ
from fx_frames f left join mask_area a using (cam)
left join (select v.frame_id, count(*) n from vehicle_px v join mask_px m using (cam, y, x) group by v.frame_id) v using (frame_id)""",
    "frame_meu": """
select f.frame_id, f.cam, coalesce(m.meu, 0.0::double) meu
from fx_frames f left join (select d.frame_id, sum(coalesce(c.coef, 0)::decimal(18,3))::double meu
 from fx_detections d left join fx_coefficients c using (cls) group by d.frame_id) m using (frame_id)""",
    "known": "select * from fx_cameras where known",
    "edge_obs": "select o.* from fx_observations o semi join known k using (cam) where o.fetched",
    "weighted": """
select o.*, coalesce(h.meu_max, 200.0::double) meu_max,
 case when o.occ <= 20 then 0.0::double when coalesce(h.meu_max, 200.0::double) > 0
  then least(o.meu / coalesce(h.meu_max, 200.0::double), 1.0::double) else 0.0::double end twf
from edge_obs o left join fx_thresholds h using (cam)""",
    "series": """
select e.edge_id, w.event_id, w.cam, w.t, w.batch_id, w.twf, coalesce(f.speed_kph, 50.0::double) free_flow,
 greatest(coalesce(f.speed_kph, 50.0::double) * (1.0::double - pow(w.twf, 1.0::double)), 3.0::double) raw_speed
from weighted w join fx_camera_edges e using (cam) left join fx_free_flow f on f.edge_id = e.edge_id""",
    # Six slices of time; some rows of a slice's last moments come with the next one.
    "late_series": """
select edge_id, row_number() over arrival event_id, max(t) over arrival t, raw_speed, free_flow, event_id real_event, t real_t
from (select *, slice + (event_id % 3 = 0 and slice < 5 and (t - lo) % width >= width - 50)::int batch from (
 select *, (t - lo) // width slice from (select *, min(t) over () lo, (max(t) over () - min(t) over ()) // 6 + 1 width from series)))
window arrival as (partition by edge_id order by batch, t, event_id)""",
    "frame_series": """
select e.edge_id, w.frame_id event_id, w.frame_id * 7 t, coalesce(f.speed_kph, 50.0::double) free_flow,
 greatest(coalesce(f.speed_kph, 50.0::double) * (1.0::double - pow(w.twf, 1.0::double)), 3.0::double) raw_speed
from (select o.frame_id, o.cam, case when o.occ <= 20 then 0.0::double when coalesce(h.meu_max, 200.0::double) > 0
  then least(m.meu / coalesce(h.meu_max, 200.0::double), 1.0::double) else 0.0::double end twf
 from frame_occ o join frame_meu m using (frame_id) left join fx_thresholds h on h.cam = o.cam) w
join fx_camera_edges e using (cam) left join fx_free_flow f on f.edge_id = e.edge_id""",
    # Micro-batches are thirds of the time.
    "frame_slices": """
select * from (select *, (t - min(t) over ()) // ((max(t) over () - min(t) over ()) // 3 + 1) slice from (
 select s.*, (select min(frame_id) * 7 from fx_frames) lo, (select max(frame_id) * 7 from fx_frames) hi from frame_series s))
qualify row_number() over (partition by edge_id, (t - lo) // ((hi - lo) // 3 + 1) order by t desc, event_id desc) = 1""",
    "last_series": "select * from series qualify row_number() over (partition by edge_id, batch_id order by t desc, event_id desc) = 1",
    "accident_frames": """
select i.*, i.class_name in ('human_incident', 'vehicle_incident') and i.conf >= 0.2::double hit
from fx_incidents i semi join fx_camera_edges e using (cam) where i.class_name is not null""",
    "streaks": """
select cam, t, event_id, class_name, conf, hit,
 case when hit then row_number() over (partition by cam, island order by t, event_id) else 0 end streak
from (select *, sum(brk) over (partition by cam order by t, event_id) island
 from (select *, case when hit and lag(hit) over w and t - lag(t) over w < 50 then 0 else 1 end brk
  from accident_frames window w as (partition by cam order by t, event_id)))""",
    "usable_zones": "select * from fx_zones where edge_id is not null and length(shape) > 0",
    "first_zones": "select * from usable_zones qualify row_number() over (partition by edge_id order by ord) = 1",
    "zone_points": """
select edge_id, 0::bigint i, 10.8::double lat, 106.7::double lon from first_zones where prefixed
union all
select edge_id, case when prefixed then 1 else 0 end,
 (case when prefixed then 10800000 else 0 end + case when d1 % 2 = 0 then d1 // 2 else -((d1 + 1) // 2) end) / 1000000.0::double,
 (case when prefixed then 106700000 else 0 end + case when d2 % 2 = 0 then d2 // 2 else -((d2 + 1) // 2) end) / 1000000.0::double
from first_zones""",
}

# Ordered folds: one step per row of the key, all keys in parallel.
SPEEDS = """
seq as (select *, row_number() over (partition by edge_id order by t, event_id) rn from {rows}),
speeds as (
 select edge_id, rn, t, event_id, free_flow, raw_speed, null::double prev_speed, null::varchar prev_status, null::bigint prev_t,
  raw_speed ema, round_even(raw_speed * 10, 0) / 10 speed,
  case when 1 - raw_speed / free_flow >= 0.75 then 'RED' when 1 - raw_speed / free_flow >= 0.40 then 'YELLOW' else 'GREEN' end status
 from seq where rn = 1
 union all
 select edge_id, rn, t, event_id, free_flow, raw_speed, prev_speed, prev_status, prev_t, ema, round_even(ema * 10, 0) / 10,
  case prev_status
   when 'RED' then case when d >= 0.60 then 'RED' when d >= 0.30 then 'YELLOW' else 'GREEN' end
   when 'YELLOW' then case when d >= 0.75 then 'RED' when d < 0.30 then 'GREEN' else 'YELLOW' end
   when 'GREEN' then case when d >= 0.40 then 'YELLOW' else 'GREEN' end
   else case when d >= 0.75 then 'RED' when d >= 0.40 then 'YELLOW' else 'GREEN' end end
 from (select *, 1 - ema / free_flow d from (
  select *, case when prev_speed is null then raw_speed else 0.3::double * raw_speed + 0.7::double * prev_speed end ema from (
   select s.edge_id, s.rn, s.t, s.event_id, s.free_flow, s.raw_speed,
    case when s.t - p.t < 1200 then p.speed end prev_speed, case when s.t - p.t < 1200 then p.status end prev_status,
    case when s.t - p.t < 1200 then p.t end prev_t
   from speeds p join seq s on s.edge_id = p.edge_id and s.rn = p.rn + 1))))"""
ALERTS = """
cand as (select *, row_number() over (partition by cam order by t, event_id) rn from streaks where streak >= 3),
alerts as (
 select cam, t, event_id, class_name, conf, streak, rn, true fires, t last_alert from cand where rn = 1
 union all
 select c.cam, c.t, c.event_id, c.class_name, c.conf, c.streak, c.rn, c.t - a.last_alert >= 300,
  case when c.t - a.last_alert >= 300 then c.t else a.last_alert end
 from alerts a join cand c on c.cam = a.cam and c.rn = a.rn + 1)"""


def sql(body: str, tables: str, fold: str = "") -> str:
    """Check SQL with the named fixture and derived tables in front."""
    both = {**DUCKDB, **DERIVED}
    wanted, todo = set(), tables.split()
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += [other for other in both if other != name and f" {other} " in f" {both[name]} ".replace("\n", " ").replace(")", " ")]
    ctes = [f"{name} as ({text.strip()})" for name, text in both.items() if name in wanted]
    if fold:
        ctes.append(fold.strip())
    return f"with recursive {', '.join(ctes)} {body}"


def speeds_sql(body: str, rows: str = "series", tables: str = "") -> str:
    return sql(body, f"{rows} {tables}", SPEEDS.format(rows=rows))


def alerts_sql(body: str, tables: str = "") -> str:
    return sql(body, f"streaks {tables}", ALERTS)


def query(check: str | None = None):
    """Register a query under the function's name."""

    def add(function):
        QUERIES[function.__name__] = function
        if check:
            ORACLES[function.__name__] = check
        return function

    return add
