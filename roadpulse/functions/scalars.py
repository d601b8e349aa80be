"""Column functions: every formula of the traffic model as a native Spark expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse import constants as K


def col(c: Column | str | float) -> Column:
    if isinstance(c, str):
        return F.col(c)
    return c if isinstance(c, Column) else F.lit(c)


def round_even(value, digits: int = 0) -> Column:
    """Round half to even; digits > 0 scales, rounds and scales back."""
    if digits == 0:
        return F.rint(col(value))
    scale = float(10**digits)
    return F.rint(col(value) * F.lit(scale)) / F.lit(scale)


# ---- boxes ----
def clip_pixel(value, size) -> Column:
    """Nearest pixel index inside 0 .. size - 1."""
    return F.greatest(F.lit(0.0), F.least(F.rint(col(value)), (col(size) - 1).cast("double"))).cast("int")


def clip_span(value, size) -> Column:
    """Coordinate limited to 0 .. size, not rounded."""
    return F.greatest(F.lit(0.0), F.least(col(value), col(size).cast("double")))


# ---- density and speed ----
def _load_ratio(meu, meu_max) -> Column:
    meu, meu_max = col(meu), col(meu_max)
    return F.when(meu_max > 0, F.least(F.try_divide(meu, meu_max), F.lit(1.0))).otherwise(F.lit(0.0))


def traffic_weight(occupancy, meu, meu_max) -> Column:
    """Zero up to the occupancy gate, then load / maximum load, at most 1."""
    return F.when(col(occupancy) <= K.OCCUPANCY_GATE, F.lit(0.0)).otherwise(_load_ratio(meu, meu_max))


def traffic_weight_ramp(occupancy, meu, meu_max) -> Column:
    """Variant with a linear ramp between the two ramp bounds."""
    occ, load = col(occupancy), _load_ratio(meu, meu_max)
    ramp = (occ - K.RAMP_LOW) / (K.RAMP_HIGH - K.RAMP_LOW)
    return F.when(occ <= K.RAMP_LOW, F.lit(0.0)).when(occ >= K.RAMP_HIGH, load).otherwise(ramp * load)


def hybrid_congestion(meu, occupancy, meu_max, or_max, w1, w2) -> Column:
    usable = (col(meu_max) > 0) & (col(or_max) > 0)
    load = col(w1) * F.try_divide(col(meu), col(meu_max))
    area = col(w2) * F.try_divide(col(occupancy), col(or_max))
    return F.when(usable, load + area).otherwise(F.lit(0.0))


def cost_tier(occupancy, hci, hci_max) -> Column:
    """Retired routing weight: 1.0 normal, 0.5 slow, 0.1 jammed."""
    ratio = F.try_divide(col(hci), col(hci_max))
    return (
        F.when((col(occupancy) < K.COST_GATE) | (col(hci_max) <= 0), F.lit(K.COST_NORMAL))
        .when(ratio >= K.COST_JAM_RATIO, F.lit(K.COST_JAM))
        .when(ratio >= K.COST_SLOW_RATIO, F.lit(K.COST_SLOW))
        .otherwise(F.lit(K.COST_NORMAL))
    )


def greenshields_speed(free_flow, density, n: float = K.GREENSHIELDS_N) -> Column:
    free = col(free_flow)
    return F.greatest(free * (F.lit(1.0) - F.pow(col(density), F.lit(n))), F.lit(K.MIN_SPEED_KMH))


# ---- stored state strings ----
def edge_wire(speed, ts, status) -> Column:
    """speed with one decimal : epoch seconds : status."""
    return F.concat_ws(":", F.format_string("%.1f", col(speed)), col(ts).cast("string"), col(status))


def _to_number(text: Column) -> Column:
    # Java reads 1.0d and 1.0f as numbers; those suffixes are not part of the format.
    suffixed = F.trim(text).rlike("^[+-]?[0-9.].*[dDfF]$")
    return F.when(~suffixed, text.try_cast("double"))


def parse_state(raw) -> Column:
    """struct(speed, ts, status); all null when the text has no speed and second part."""
    parts = F.split(col(raw), ":")
    speed = F.when(F.size(parts) >= 2, _to_number(F.get(parts, F.lit(0))))
    status = F.get(parts, F.lit(2))
    return F.struct(
        speed.alias("speed"),
        F.when(speed.isNotNull(), F.get(parts, F.lit(1)).try_cast("bigint")).alias("ts"),
        F.when(speed.isNotNull() & status.isin(*K.STATUSES), status).alias("status"),
    )


# ---- routing ids ----
def graph_tile(edge_id) -> Column:
    return col(edge_id).cast("bigint").bitwiseAND(F.lit((1 << K.GRAPH_TILE_BITS) - 1))


def graph_index(edge_id) -> Column:
    return F.shiftright(col(edge_id).cast("bigint"), K.GRAPH_TILE_BITS)


def speed_code(speed) -> Column:
    """Half km/h steps; 127 stands for unknown."""
    code = F.rint(col(speed) / 2).cast("int")
    return F.coalesce(code, F.lit(K.UNKNOWN_SPEED_CODE))


# ---- images ----
def is_complete_jpeg(content) -> Column:
    data = col(content)
    size = F.octet_length(data)
    return (
        (size > K.JPEG_MIN_BYTES)
        & (F.substring(data, 1, 2) == F.lit(b"\xff\xd8"))
        & (F.substring(data, -2, 2) == F.lit(b"\xff\xd9"))
    )


def is_image_data(content) -> Column:
    """Whether the content begins like one of the known image formats."""
    data = col(content)
    known = [F.substring(data, 1, len(magic)) == F.lit(magic) for magic in K.IMAGE_MAGIC]
    webp = (F.substring(data, 1, 4) == F.lit(b"RIFF")) & (F.substring(data, 9, 4) == F.lit(b"WEBP"))
    found = webp
    for one in known:
        found = found | one
    return found


def intake_status(content_type, content, max_bytes: int = K.UPLOAD_MAX_BYTES) -> Column:
    """HTTP-style verdict on an uploaded image, tested in this order."""
    data = col(content)
    size = F.coalesce(F.octet_length(data), F.lit(0))
    is_image = F.coalesce(F.startswith(col(content_type), F.lit("image/")), F.lit(False))
    return (
        F.when(~is_image, F.lit(422))
        .when(size == 0, F.lit(422))
        .when(size > max_bytes, F.lit(413))
        .when(~is_image_data(content), F.lit(400))
        .otherwise(F.lit(200))
    )


# ---- time ----
def local_time_text(epoch_seconds, zone: str = K.HISTORY_TIME_ZONE) -> Column:
    """yyyy-MM-dd HH:mm:ss in ``zone``, whatever the session time zone is."""
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=col(epoch_seconds))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("string")
