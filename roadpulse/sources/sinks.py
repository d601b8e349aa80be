"""Files this package writes."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import schemas
from roadpulse.functions.scalars import local_time_text, round_even


# ---- small records ----
RECORD = "serial bigint, body string"


def read_record(spark: SparkSession, path: str) -> dict | None:
    """Newest whole record below ``path``; None when there is none.

    Records are written in turn to two places, so one of them is whole at any time.
    """
    found = []
    for place in (0, 1):
        try:
            found += spark.read.schema(RECORD).option("ignoreMissingFiles", True).json(f"{path}/record-{place}").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return {"serial": -1} | max(({"serial": r["serial"]} | json.loads(r["body"]) for r in found), key=lambda r: r["serial"]) if found else None


def write_record(spark: SparkSession, path: str, body: dict) -> None:
    """Puts ``body`` in place of the record below ``path``. There is one writer at a time."""
    last = read_record(spark, path)
    serial = 0 if last is None else last["serial"] + 1
    row = spark.createDataFrame([(serial, json.dumps(body))], RECORD)
    row.coalesce(1).write.mode("overwrite").json(f"{path}/record-{serial % 2}")


# ---- tables that grow: each batch lies in its own folder and counts once ----
def append_once(spark: SparkSession, path: str, app: str, batch: int, write: Callable[[str], None]) -> bool:
    """Calls ``write`` with the folder of ``batch`` of application ``app``, unless the ledger says that it is done.

    The ledger beside the table holds the last batch of each application; batches come in ascending order. A batch
    that failed before it got there is written again over what it left. False when the batch was done before.
    """
    ledger = f"{path}.ledger/{app}"
    done = read_record(spark, ledger)
    if done is not None and batch <= done["batch"]:
        return False
    write(f"{path}/app={app}/batch={batch}")
    write_record(spark, ledger, {"batch": batch})
    return True


def append_rows(rows: DataFrame, path: str, app: str, batch: int) -> bool:
    return append_once(rows.sparkSession, path, app, batch, lambda folder: rows.write.mode("overwrite").parquet(folder))


def append_history(metrics: DataFrame, path: str, app: str, batch: int) -> bool:
    """Frame metrics with two decimals, appended as CSV with a header."""
    rows = metrics.select(
        local_time_text("t").alias("timestamp"), F.col("cam").cast("string").alias("cameraId"),
        round_even("occ", 2).alias("preciseOccupancy"), round_even("meu", 2).alias("meu"), round_even("twf", 2).alias("twf"),
    )
    return append_once(metrics.sparkSession, path, app, batch, lambda folder: rows.write.mode("overwrite").option("header", True).csv(folder))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.HISTORY).option("header", True).csv(path).drop("app", "batch")


def alert_json(records: DataFrame) -> DataFrame:
    return records.select(F.to_json(F.struct(*records.columns)).alias("value"))


def append_alerts(records: DataFrame, path: str, app: str, batch: int) -> bool:
    """One JSON text per alert; non-ASCII characters stay as they are."""
    return append_once(records.sparkSession, path, app, batch, lambda folder: alert_json(records).write.mode("overwrite").text(folder))


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ALERT).json(path).drop("app", "batch")


def write_geometry(geometry: DataFrame, path: str) -> None:
    geometry.write.mode("overwrite").json(path)


def read_geometry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("edge_id string, points array<array<double>>").json(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """Table laid out by ``key``: joins and grouping on the key then need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def write_part(df: DataFrame, path: str, version: int) -> None:
    """Results of one run among those of others; repeating a run writes its folder anew."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


# ---- tables replaced as a whole: data in a new folder first, then the record that names it ----
# Versions that stay readable; their folders are used in turn, so none pile up.
KEPT_VERSIONS = 5


def _entries(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(version, folder number) of the versions that can be read, in ascending order."""
    record = read_record(spark, path)
    return [] if record is None else [tuple(e) for e in record["versions"]]


def publish_version(df: DataFrame, path: str, version: int) -> None:
    """Makes ``df`` a version of the table at ``path``; readers see the versions before or this one whole.

    Repeating a version puts a new folder in its place.
    """
    spark = df.sparkSession
    entries = _entries(spark, path)
    folder = next(i for i in range(KEPT_VERSIONS + 1) if i not in {f for _, f in entries})
    df.write.mode("overwrite").parquet(f"{path}/data-{folder}")
    kept = sorted([e for e in entries if e[0] != version] + [(version, folder)])[-KEPT_VERSIONS:]
    write_record(spark, path, {"versions": kept})


def latest_version(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """Highest version, optionally below ``before``."""
    return max((v for v, _ in _entries(spark, path) if before is None or v < before), default=None)


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/data-{dict(_entries(spark, path))[version]}")


def upsert_latest(updates: DataFrame, path: str, version: int, key: str, order: str) -> None:
    """Newest row per key of the table before ``version`` and ``updates``, written as ``version``.

    Repeating a version gives the same table, so a replayed micro-batch does no harm.
    """
    spark = updates.sparkSession
    previous = latest_version(spark, path, before=version)
    rows = updates if previous is None else read_version(spark, path, previous).select(*updates.columns).unionByName(updates)
    rest = [c for c in updates.columns if c != key]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")
    publish_version(newest, path, version)
