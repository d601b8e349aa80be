"""Explicit schemas of the files this package reads."""

ZONE = (
    "struct<way_id: bigint, side: string,"
    " mapped_edge: struct<edge_id: struct<value: string>, edge_info: struct<shape: string>>>"
)
CAMERA = f"ordinal bigint, cam_id string, description string, zones map<string, {ZONE}>"
FREE_FLOW = "ordinal bigint, edge_id string, speed_kph double"
THRESHOLD = "meuMax double, orMax double, hciMax double"
HISTORY = "timestamp string, cameraId string, preciseOccupancy double, meu double, twf double"
DETECTION = (
    "cam bigint, frame_id bigint, img_h int, img_w int, cls int, conf double,"
    " x1 double, y1 double, x2 double, y2 double"
)
# A whole frame in one row.
FRAME = (
    "cam bigint, frame_id bigint, t bigint, img_h int, img_w int,"
    " boxes array<struct<cls: int, conf: double, x1: double, y1: double, x2: double, y2: double>>"
)
OBSERVATION = "event_id bigint, cam bigint, t bigint, occ double, meu double"
EDGE_SERIES = "edge_id string, t bigint, event_id bigint, raw_speed double, free_flow double"
INCIDENT_SERIES = "cam bigint, t bigint, event_id bigint, class_name string, conf double, hit boolean"
ALERT = "camId string, edgeIds array<bigint>, className string, confidence double, ts bigint, location string"
