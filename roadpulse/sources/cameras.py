"""Camera configuration files: nested JSON with a map of zones per camera."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse import schemas
from roadpulse.functions.scalars import col
from roadpulse.operators.ordinal import file_position

# Where a row was read.
FILE_PLACE = ("_metadata.file_path as file", "_metadata.file_block_start as split")


def read_cameras(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All cameras with their position; files without an ``ordinal`` field keep file order, several files that of their paths."""
    raw = spark.read.schema(schemas.CAMERA).option("multiLine", multi_line).json(path)
    return file_position(raw.selectExpr("*", *FILE_PLACE), F.col("ordinal"))


def active_cameras(cameras: DataFrame) -> DataFrame:
    """Cameras that have at least one zone."""
    return cameras.filter(F.coalesce(F.size(F.map_keys("zones")), F.lit(0)) > 0)


def camera_limit(cameras: DataFrame, limit: str | None) -> DataFrame:
    """First cameras in file order; an empty or missing setting keeps all, "0" keeps none."""
    return cameras.orderBy("ordinal").limit(int(limit)) if limit else cameras


def camera_zones(cameras: DataFrame) -> DataFrame:
    """One row per zone: zone position, edge id as text, way, direction and encoded shape."""
    return cameras.select("cam_id", "ordinal", F.posexplode("zones").alias("ord", "zone", "z")).select(
        "cam_id", "ordinal", "ord", "zone",
        F.col("z.mapped_edge.edge_id.value").cast("string").alias("edge_id"),
        F.col("z.way_id").alias("way_id"),
        F.col("z.side").alias("direction"),
        F.col("z.mapped_edge.edge_info.shape").alias("shape"),
    )


def camera_edges(cameras: DataFrame) -> DataFrame:
    """Zones that are mapped to a road edge."""
    return camera_zones(cameras).filter(F.col("edge_id").isNotNull()).drop("shape", "zone")


def camera_url(base_url: str, cam_id, now_ms=None) -> Column:
    """Snapshot address of a camera; ``now_ms`` adds a value that defeats caches."""
    url = F.concat(F.lit(f"{base_url}?id="), col(cam_id).cast("string"), F.lit(K.SNAPSHOT_QUERY))
    return url if now_ms is None else F.concat(url, F.lit("&t="), col(now_ms).cast("string"))
