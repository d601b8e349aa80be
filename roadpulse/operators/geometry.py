"""Road-edge geometry from encoded polylines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse import constants as K


def polyline_deltas(shape: str) -> Column:
    """Signed deltas of an encoded line: base-63 characters of five bits, low bits first.

    The characters with code below 32 end a number, so their positions cut the text into numbers.
    """
    codes = f"transform(split({shape}, ''), c -> ascii(c) - 63)"
    ends = "filter(sequence(1, size(codes)), i -> codes[i - 1] < 32)"
    number = (
        "aggregate(transform(slice(codes, start, end - start + 1), (c, k) -> shiftleft(cast(c & 31 as bigint), 5 * k)),"
        " 0L, (acc, part) -> acc | part)"
    )
    signed = "if(n & 1 = 1, ~shiftright(n, 1), shiftright(n, 1))"
    start = "if(i = 0, 1, ends[i - 1] + 1)"
    # let-style bindings: one-element arrays carry intermediate values without recomputing them
    numbers = f"transform(ends, (end, i) -> transform(array({start}), start -> {number})[0])"
    signed_all = f"transform({numbers}, n -> {signed})"
    with_ends = f"transform(array({ends}), ends -> {signed_all})[0]"
    return F.expr(f"if(length({shape}) > 0, transform(array({codes}), codes -> {with_ends})[0], array())")


def _degrees(units) -> Column:
    return units / F.lit(float(K.POLYLINE_SCALE))


def polyline_points(shapes: DataFrame, key: str = "edge_id") -> DataFrame:
    """Points (key, i, lat, lon) of one encoded shape per key; deltas are summed as integers."""
    pairs = F.expr("transform(sequence(0, size(d) div 2 - 1), i -> struct(d[2 * i] as lat, d[2 * i + 1] as lon))")
    decoded = shapes.select(key, polyline_deltas("shape").alias("d")).filter(F.size("d") >= 2)
    steps = decoded.select(key, F.posexplode(pairs).alias("i", "p"))
    line = W.partitionBy(key).orderBy("i")
    return steps.select(
        key, "i", _degrees(F.sum("p.lat").over(line)).alias("lat"), _degrees(F.sum("p.lon").over(line)).alias("lon")
    )


def first_geometry_per_edge(zones: DataFrame) -> DataFrame:
    """First zone in file order with an edge and a shape, per edge."""
    usable = zones.filter(F.col("edge_id").isNotNull() & (F.length("shape") > 0))
    return usable.groupBy("edge_id").agg(F.min("ord").alias("ord"), F.min_by("shape", "ord").alias("shape"))


def geo_range_flag(geometry: DataFrame) -> DataFrame:
    """First point of each shape and whether it lies outside the expected area."""
    first = polyline_deltas("shape")
    points = geometry.withColumn("d", first).filter(F.size("d") >= 2)
    lat, lon = _degrees(F.col("d")[0]), _degrees(F.col("d")[1])
    inside = lat.between(*K.LAT_RANGE) & lon.between(*K.LON_RANGE)
    return points.select("edge_id", lat.alias("lat0"), lon.alias("lon0"), (~inside).alias("out_of_range"))


def geometry_stats(zones: DataFrame) -> DataFrame:
    """Quality counters of the geometry extract."""
    no_edge = F.col("edge_id").isNull()
    no_shape = ~no_edge & ~(F.coalesce(F.length("shape"), F.lit(0)) > 0)
    per_edge = (
        zones.groupBy("edge_id").agg(
            F.count_if(no_edge).alias("no_edge"), F.count_if(no_shape).alias("no_shape"),
            F.count_if(~no_edge & ~no_shape).alias("usable"), F.count(F.lit(1)).alias("zones"),
            F.min_by("shape", F.when(~no_edge & ~no_shape, F.col("ord"))).alias("shape"),
        )
    )
    written = F.col("usable") > 0
    first = polyline_deltas("shape")
    lat, lon = (_degrees(F.get(first, F.lit(i))) for i in (0, 1))
    inside = lat.between(*K.LAT_RANGE) & lon.between(*K.LON_RANGE)
    return per_edge.agg(
        F.sum("zones").alias("zones_seen"), F.sum("no_edge").alias("no_edge_id"), F.sum("no_shape").alias("no_shape"),
        F.sum(F.when(written, F.col("usable") - 1).otherwise(0)).alias("duplicates"),
        F.count_if(written).alias("written"), F.count_if(written & ~inside).alias("out_of_range"),
    )


def camera_count(zones: DataFrame) -> DataFrame:
    return zones.agg(F.countDistinct("cam").alias("cameras"))


def edge_geometry(zones: DataFrame) -> DataFrame:
    """Edge id and its points as [lat, lon] pairs, the published layout."""
    points = polyline_points(first_geometry_per_edge(zones))
    line = F.array_sort(F.collect_list(F.struct("i", F.array("lat", "lon").alias("p"))))
    return points.groupBy("edge_id").agg(line.alias("l")).select("edge_id", F.col("l.p").alias("points"))
