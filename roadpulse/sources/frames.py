"""Camera frames and detected boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse import schemas
from roadpulse.functions.scalars import intake_status, is_complete_jpeg


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Image files with path, modification time, length and content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def valid_frames(images: DataFrame) -> DataFrame:
    return images.filter(is_complete_jpeg("content"))


def with_intake_status(images: DataFrame, max_bytes: int = K.UPLOAD_MAX_BYTES) -> DataFrame:
    return images.withColumn("status", intake_status("content_type", "content", max_bytes))


def read_detections(spark: SparkSession, path: str, confidence: float) -> DataFrame:
    return confident(spark.read.schema(schemas.DETECTION).parquet(path), confidence)


def confident(detections: DataFrame, confidence: float) -> DataFrame:
    return detections.filter(F.col("conf") >= confidence)
