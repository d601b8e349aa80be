"""Road-camera tables projected from the general-purpose test tables (see FIXTURES.md).

``spark_fixture`` builds them with Spark; ``DUCKDB`` holds the same projections for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IMG_H, IMG_W = 48, 64

# Microseconds since 1970 of a zone-less timestamp, independent of the session time zone.
_MICROS = (
    "(unix_date(cast(ts as date)) * 86400000000L + hour(ts) * 3600000000L + minute(ts) * 60000000L"
    " + cast(extract(SECOND from ts) * 1000000 as bigint))"
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, top = "((l_orderkey%40)*3)%30 + ((l_partkey*7)%41)/2d - 8d", "((l_orderkey%40)*5)%24 + ((l_suppkey*11)%31)/2d - 6d"
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey frame_id", "l_orderkey % 40 cam", f"{IMG_H} img_h", f"{IMG_W} img_w",
        "cast(l_linenumber % 5 as int) cls",
        "cast((l_partkey*13 + l_suppkey*7) % 101 as int) / 100d conf",
        f"{left} x1", f"{top} y1",
        f"{left} + 4d + l_quantity/2d x2", f"{top} + 3d + (l_quantity%24d)/2d y2",
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey frame_id", "o_orderkey % 40 cam", f"{IMG_H} img_h", f"{IMG_W} img_w"
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id cam", f"{_MICROS} div 100000000 t", f"{_MICROS} div 100000000 div 20 batch_id",
        "(cast(round(value*100) as bigint)%10000)/100d occ",
        "cast(get_json_object(props,'$.k') as int)*3.236d meu", "event_type <> 'view' fetched",
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id cam", f"{_MICROS} div 2000000000 t",
        "case event_type when 'error' then 'human_incident' when 'signup' then 'vehicle_normal'"
        " when 'view' then null else 'vehicle_incident' end class_name",
        "(cast(round(value*100) as bigint)%100)/100d conf",
    )


def _cams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("cam")).distinct()


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cams(spark, sf_dir).selectExpr(
        "cam", "case when cam%3=0 then null else concat('Junction ', cam) end description", "cam%29<>28 known"
    )


def camera_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = F.explode(F.expr("array(struct(0 as ord, cam*2 as e), struct(1 as ord, 10000 + cam div 2 as e))"))
    return (
        _cams(spark, sf_dir).filter("cam%13<>12").select("cam", zones.alias("z"))
        .selectExpr("cam", "z.ord ord", "cast(z.e as string) edge_id")
    )


def free_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = F.explode(F.expr("array(cam*2, 10000 + cam div 2)")).alias("e")
    return (
        _cams(spark, sf_dir).select(edge).distinct().filter("e%3<>0")
        .selectExpr("cast(e as string) edge_id", "30d + e%40 speed_kph")
    )


def thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cams(spark, sf_dir).filter("cam%5 in (0,1)").selectExpr("cam", "if(cam%5=0, 60d, 0d) meu_max")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey ord", "if(o_orderkey%19=0, null, cast(o_custkey as string)) edge_id",
        "if(o_orderkey%17=0, null, concat(if(o_orderkey%23=0,'','_wdrS_mmojE'), chr(63+o_custkey%32),"
        " chr(63+32+(32+o_orderkey%992)%32), chr(63+(32+o_orderkey%992) div 32))) shape",
        "o_orderkey div 4 cam",
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "case when doc_id%50=7 then X'' when doc_id%4 in (0,3) then X'FFD8' || encode(text,'utf-8') || X'FFD9'"
        " when doc_id%4=1 then X'FFD8' || encode(text,'utf-8') else"
        " case doc_id%36 when 2 then X'89504E470D0A1A0A' when 6 then X'474946383761' when 10 then X'474946383961' when 14 then X'424D'"
        " when 18 then X'49492A00' when 22 then X'4D4D002A' when 26 then X'524946460000000057454250' when 30 then X'5249464600000000' else X'' end"
        " || encode(text,'utf-8') end content",
        "if(doc_id%31=5, 'text/html', if(doc_id%4=2, 'image/png', 'image/jpeg')) content_type",
    )


def state_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored states of all shapes: with and without status, signs, exponents, blanks, further parts, and broken ones."""
    rows = _table(spark, sf_dir, "events").selectExpr(
        "event_id", "cast(round(value*100) as bigint) % 1000 tenths", f"{_MICROS} div 1000000 ts"
    )
    return rows.selectExpr("event_id", "tenths", "ts", "concat(tenths div 10, '.', tenths % 10) speed").selectExpr(
        "event_id",
        "case event_id%11 when 0 then concat(speed, ':', ts, ':RED') when 1 then concat(speed, ':', ts) when 2 then concat(speed, ':', ts, ':JAM')"
        " when 3 then concat('x', speed, ':', ts, ':RED') when 4 then speed when 5 then '' when 6 then concat('-', speed, ':', ts, ':GREEN')"
        " when 7 then concat('+', speed, ':x', ts, ':YELLOW') when 8 then concat(tenths, 'e1:', ts, ':GREEN:more')"
        " when 9 then concat(' ', speed, ' :', ts, ':YELLOW') end raw",
    )


DUCKDB = {
    "fx_detections": """
select l_orderkey frame_id, l_orderkey % 40 cam, 48 img_h, 64 img_w, cast(l_linenumber % 5 as int) cls,
 cast((l_partkey*13 + l_suppkey*7) % 101 as int) / 100.0::double conf,
 ((l_orderkey%40)*3)%30 + ((l_partkey*7)%41)/2.0::double - 8.0::double x1,
 ((l_orderkey%40)*5)%24 + ((l_suppkey*11)%31)/2.0::double - 6.0::double y1,
 ((l_orderkey%40)*3)%30 + ((l_partkey*7)%41)/2.0::double - 8.0::double + 4.0::double + l_quantity/2.0::double x2,
 ((l_orderkey%40)*5)%24 + ((l_suppkey*11)%31)/2.0::double - 6.0::double + 3.0::double + (l_quantity%24.0::double)/2.0::double y2
from lineitem""",
    "fx_frames": "select o_orderkey frame_id, o_orderkey % 40 cam, 48 img_h, 64 img_w from orders",
    "fx_observations": """
select event_id, user_id cam, epoch_us(ts)//100000000 t, epoch_us(ts)//100000000//20 batch_id,
 (cast(round(value*100) as bigint)%10000)/100.0::double occ,
 cast(json_extract_string(props,'$.k') as int)*3.236::double meu, event_type <> 'view' fetched from events""",
    "fx_incidents": """
select event_id, user_id cam, epoch_us(ts)//2000000000 t,
 case event_type when 'error' then 'human_incident' when 'signup' then 'vehicle_normal' when 'view' then null else 'vehicle_incident' end class_name,
 (cast(round(value*100) as bigint)%100)/100.0::double conf from events""",
    "fx_cameras": """
select distinct user_id cam, case when user_id%3=0 then null else concat('Junction ', user_id) end description,
 user_id%29<>28 known from events""",
    "fx_camera_edges": """
select cam, 0 ord, cast(cam*2 as varchar) edge_id from (select distinct user_id cam from events) where cam%13<>12
union all
select cam, 1, cast(10000 + cam // 2 as varchar) from (select distinct user_id cam from events) where cam%13<>12""",
    "fx_free_flow": """
select cast(e as varchar) edge_id, 30.0::double + e%40 speed_kph
from (select distinct user_id*2 e from events union select distinct 10000 + user_id//2 from events
) where e%3<>0""",
    "fx_thresholds": "select distinct user_id cam, if(user_id%5=0, 60.0::double, 0.0::double) meu_max from events where user_id%5 in (0,1)",
    "fx_zones": """
select o_orderkey ord, if(o_orderkey%19=0, null, cast(o_custkey as varchar)) edge_id, o_orderkey // 4 cam,
 if(o_orderkey%17=0, null, concat(if(o_orderkey%23=0,'','_wdrS_mmojE'), chr(cast(63+o_custkey%32 as int)), chr(cast(63+32+(32+o_orderkey%992)%32 as int)), chr(cast(63+(32+o_orderkey%992)//32 as int)))) shape,
 cast(o_custkey%32 as int) d1, cast(32+o_orderkey%992 as int) d2, o_orderkey%23<>0 prefixed from orders""",
    "fx_images": """
select doc_id, case when doc_id%50=7 then ''::blob when doc_id%4 in (0,3) then unhex('FFD8') || encode(text) || unhex('FFD9')
 when doc_id%4=1 then unhex('FFD8') || encode(text) else
 case doc_id%36 when 2 then unhex('89504E470D0A1A0A') when 6 then unhex('474946383761') when 10 then unhex('474946383961') when 14 then unhex('424D')
 when 18 then unhex('49492A00') when 22 then unhex('4D4D002A') when 26 then unhex('524946460000000057454250') when 30 then unhex('5249464600000000') else ''::blob end
 || encode(text) end content,
 if(doc_id%31=5, 'text/html', if(doc_id%4=2, 'image/png', 'image/jpeg')) content_type from documents""",
    "fx_state_strings": """
select event_id, tenths, ts, case event_id%11 when 0 then concat(speed, ':', ts, ':RED') when 1 then concat(speed, ':', ts) when 2 then concat(speed, ':', ts, ':JAM')
 when 3 then concat('x', speed, ':', ts, ':RED') when 4 then speed when 5 then '' when 6 then concat('-', speed, ':', ts, ':GREEN')
 when 7 then concat('+', speed, ':x', ts, ':YELLOW') when 8 then concat(tenths, 'e1:', ts, ':GREEN:more')
 when 9 then concat(' ', speed, ' :', ts, ':YELLOW') end raw
from (select *, concat(tenths // 10, '.', tenths % 10) speed from (
 select event_id, cast(round(value*100) as bigint) % 1000 tenths, epoch_us(ts) // 1000000 ts from events))""",
    "fx_coefficients": "select * from (values (0,1.0::double),(1,3.236::double),(2,8.568::double),(3,10.0::double)) v(cls, coef)",
}
