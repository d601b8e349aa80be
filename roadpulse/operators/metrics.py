"""Per-frame load and the dimension joins of the speed model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse.operators.boxes import clip_boxes_float


def join_coefficients(detections: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Unit weight of every box; classes without a weight count 0."""
    zero = F.lit(0).cast("decimal(10,3)")
    return detections.join(coefficients, "cls", "left").withColumn("coef", F.coalesce("coef", zero))


def meu_per_frame(frames: DataFrame, detections: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Sum of unit weights per frame; summed as decimals, so the order of boxes does not matter."""
    sums = join_coefficients(detections, coefficients).groupBy("frame_id").agg(F.sum("coef").alias("meu"))
    meu = F.coalesce(F.col("meu").cast("double"), F.lit(0.0))
    return frames.join(sums, "frame_id", "left").withColumn("meu", meu)


def occupancy_raw(frames: DataFrame, detections: DataFrame) -> DataFrame:
    """Sum of box areas over the image area in percent; overlaps count twice."""
    areas = clip_boxes_float(detections).groupBy("frame_id").agg(F.sum(F.col("w") * F.col("h")).alias("area"))
    image = (F.col("img_h") * F.col("img_w")).cast("double")
    usable = (F.col("img_h") > 0) & (F.col("img_w") > 0)
    share = F.when(usable, F.try_divide(F.col("area"), image) * 100)
    joined = frames.join(areas, "frame_id", "left")
    return joined.select(*frames.columns, F.coalesce(share, F.lit(0.0)).alias("occupancy_raw"))


def join_thresholds(rows: DataFrame, thresholds: DataFrame, default: float = K.MEU_MAX_DEFAULT) -> DataFrame:
    """Maximum load of the camera; a stored 0 is kept, only a missing value takes the default."""
    limits = thresholds.select("cam", "meu_max")
    return rows.join(limits, "cam", "left").withColumn("meu_max", F.coalesce("meu_max", F.lit(default)))


def fanout_edges(rows: DataFrame, camera_edges: DataFrame) -> DataFrame:
    """One row per road edge the camera looks at; cameras without edges give none."""
    return rows.join(camera_edges.select("cam", "ord", "edge_id"), "cam")


def join_free_flow(rows: DataFrame, free_flow: DataFrame, default: float = K.FREE_FLOW_DEFAULT_KMH) -> DataFrame:
    joined = rows.join(free_flow.withColumnRenamed("speed_kph", "free_flow"), "edge_id", "left")
    return joined.withColumn("free_flow", F.coalesce("free_flow", F.lit(default)))


def writable_edges(camera_edges: DataFrame, free_flow: DataFrame) -> DataFrame:
    """Edges with free flow, without those whose camera stops before or at them.

    A free flow of zero makes the status undefined: the camera fails at that edge, and only the
    edges listed before it are written.
    """
    edges = join_free_flow(camera_edges.select("cam", "ord", "edge_id"), free_flow)
    stop = F.min(F.when(F.col("free_flow") == 0, F.col("ord"))).over(Window.partitionBy("cam"))
    return edges.withColumn("stop", stop).filter(F.col("stop").isNull() | (F.col("ord") < F.col("stop"))).drop("stop")


def failing_cameras(camera_edges: DataFrame, free_flow: DataFrame) -> DataFrame:
    """Cameras with an edge whose free flow is zero."""
    edges = join_free_flow(camera_edges.select("cam", "edge_id"), free_flow)
    return edges.filter(F.col("free_flow") == 0).select("cam").distinct()
