"""Session-level helpers: shared folder, size checks before broadcasting, hot-key splitting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension is broadcast only when it is found to have at most this many rows and bytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 256 * 1024 * 1024
# A key with more rows than this is split over tasks.
HOT_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder is made only in local mode, where no such setting exists; it goes when the process ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            named = tempfile.mkdtemp(prefix="roadpulse-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which outlives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _bytes(column: Column, kind: T.DataType) -> Column:
    """About the bytes of a value: its length in text or bytes, or as JSON if it is nested."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column.alias("v")))), F.lit(0)) + 16
    return F.lit(8)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows and about ``size`` bytes; no more rows than that are looked at."""
    width = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0))
    count, total = df.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return count <= rows and (total or 0) <= size


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when counted small; otherwise leave the join to a shuffle with AQE.

    ``df`` is evaluated for the count, so pass a stored or materialized table.
    """
    return F.broadcast(df) if is_small(df, rows) else df


def tasks_for(df: DataFrame, rows: int) -> int:
    """Partitions that leave a task about ``rows`` rows of ``df``, however many there are; never fewer than the session's."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


def hot_keys(df: DataFrame, key: str, limit: int = HOT_ROWS) -> DataFrame | None:
    """Keys of ``df`` with more than ``limit`` rows and their counts, or None when there are none.

    Only the key column is read, counts combine before the shuffle, and at most
    rows / limit keys can remain.
    """
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows")).filter(F.col("key_rows") > limit)
    return None if hot.isEmpty() else materialize(hot)


def split_hot(
    df: DataFrame, key: str, limit: int = HOT_ROWS, counted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows of ordinary keys, rows of hot keys or None, number of hot rows).

    ``counted`` may name a cheaper table with at least the rows of ``df`` per key, such as an input
    of which ``df`` is a filtered view.
    """
    hot = hot_keys(df if counted is None else counted, key, limit)
    if hot is None:
        return df, None, 0
    rows = hot.agg(F.sum("key_rows")).first()[0]
    ids = broadcast_if_small(hot.select(key))
    return df.join(ids, key, "left_anti"), df.join(ids, key, "left_semi"), rows


def local_session(cpus: str = "8", memory: str = "12g") -> SparkSession:
    """Session for tests, checks and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("roadpulse")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
