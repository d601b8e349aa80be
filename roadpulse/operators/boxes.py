"""Row-wise work on detected boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse.functions.scalars import clip_pixel, clip_span, col


def clip_boxes_px(boxes: DataFrame) -> DataFrame:
    """Boxes on the pixel grid as half-open ranges; boxes left without area are dropped."""
    return boxes.withColumns(
        {
            "x1": clip_pixel("x1", "img_w"), "x2": clip_pixel("x2", "img_w"),
            "y1": clip_pixel("y1", "img_h"), "y2": clip_pixel("y2", "img_h"),
        }
    ).filter((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))


def clip_boxes_float(boxes: DataFrame) -> DataFrame:
    """Boxes limited to the image, with width and height; boxes left without area are dropped."""
    spans = boxes.withColumns(
        {
            "x1": clip_span("x1", "img_w"), "x2": clip_span("x2", "img_w"),
            "y1": clip_span("y1", "img_h"), "y2": clip_span("y2", "img_h"),
        }
    )
    sized = spans.withColumns({"w": F.col("x2") - F.col("x1"), "h": F.col("y2") - F.col("y1")})
    return sized.filter((F.col("w") > 0) & (F.col("h") > 0))


def class_label(cls, names: dict[int, str] = K.VEHICLE_NAMES) -> Column:
    """Class name, or the class number as text when it has none."""
    lookup = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    return F.coalesce(F.try_element_at(lookup, col(cls)), col(cls).cast("string"))


def incident_filter(boxes: DataFrame, class_column: str = "class_name") -> DataFrame:
    return boxes.filter(F.col(class_column).isin(*K.INCIDENT_CLASSES))
