"""Small configuration tables: free-flow speeds, coefficients, thresholds, index weights."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse import schemas
from roadpulse.operators.ordinal import file_position
from roadpulse.sources.cameras import FILE_PLACE


def read_free_flow(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Free-flow speed per edge; when an edge is listed twice the later entry wins."""
    raw = spark.read.schema(schemas.FREE_FLOW).option("multiLine", multi_line).json(path)
    raw = file_position(raw.selectExpr("*", *FILE_PLACE), F.col("ordinal"))
    return raw.groupBy("edge_id").agg(F.max_by("speed_kph", "ordinal").alias("speed_kph"))


def _json_map(spark: SparkSession, path: str, value_type: str) -> DataFrame:
    """Rows (key, value) of one JSON object file; a missing or empty file has none."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        text = spark.createDataFrame([], "value string")
    return text.select(F.explode(F.from_json("value", f"map<string, {value_type}>")).alias("key", "value"))


def read_meu_coefficients(spark: SparkSession, path: str) -> DataFrame:
    """Motorcycle-equivalent units per vehicle class."""
    return _json_map(spark, path, "decimal(10,3)").select(F.col("key").cast("int").alias("cls"), F.col("value").alias("coef"))


def default_coefficients(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({cls}, cast({coef} as decimal(10,3)))" for cls, coef in K.MEU_COEFFICIENTS.items())
    return spark.sql(f"select * from values {rows} as t(cls, coef)")


def read_thresholds(spark: SparkSession, path: str, one_object: bool = False) -> DataFrame:
    """Calibrated limits per camera, from rows with ``cam_id`` or from one object keyed by camera."""
    if one_object:
        rows = _json_map(spark, path, f"struct<{schemas.THRESHOLD.replace(' double', ': double')}>").select("key", "value.*")
        rows = rows.withColumnRenamed("key", "cam_id")
    else:
        rows = spark.read.schema(f"cam_id string, {schemas.THRESHOLD}").json(path)
    return rows.select(
        "cam_id", F.col("meuMax").alias("meu_max"), F.col("orMax").alias("or_max"), F.col("hciMax").alias("hci_max")
    )


def thresholds_or_default(cameras: DataFrame, thresholds: DataFrame, key: str = "cam_id") -> DataFrame:
    """Whole default set for cameras without an entry; a present entry keeps its own gaps."""
    limits = ["meu_max", "or_max", "hci_max"]
    stored = thresholds.select(key, F.struct(*limits).alias("stored"))
    default = F.struct(*[F.lit(K.THRESHOLD_DEFAULT).alias(c) for c in limits])
    return (
        cameras.select(key).join(stored, key, "left")
        .select(key, F.coalesce("stored", default).alias("limits")).select(key, "limits.*")
    )


def read_hci_weights(spark: SparkSession, path: str) -> tuple[float, float]:
    """The two weights of the hybrid congestion index, a single-row setting."""
    row = spark.read.schema("w1 double, w2 double").option("multiLine", True).json(path).first()
    return row.w1, row.w2
