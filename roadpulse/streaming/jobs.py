"""Streaming jobs: sources with bounded micro-batches, frame metrics, speeds, alerts, calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators.accident import alert_records
from roadpulse.operators.edge_state import edge_series
from roadpulse.operators.raster import CAMERA, heatmap
from roadpulse.operators.report import cycle_window
from roadpulse.plans.traffic import RoadMask
from roadpulse.sources.sinks import append_alerts, append_rows, upsert_latest
from roadpulse.streaming import frame_rows, state

WATERMARK_SECONDS = 60


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int) -> DataFrame:
    """Parquet files as a stream; ``files_per_batch`` limits what one micro-batch admits."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def cycle_trigger(writer, seconds: int | None = None):
    """Live runs start a micro-batch per cycle; without ``seconds`` all present data is processed once."""
    return writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")


def stream_frame_metrics(frames: DataFrame, mask: RoadMask, coefficients: DataFrame, out: str, checkpoint: str, every: int | None = None) -> StreamingQuery:
    """Occupancy and load per frame. Each input row is a whole frame with its ``boxes`` (schemas.FRAME), so none is ever split."""
    return _append(frame_rows.measured(frames, mask, coefficients).select("frame_id", "cam", "occ", "meu"), out, checkpoint, every)


def _append(df: DataFrame, out: str, checkpoint: str, every: int | None) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").format("parquet")
    return cycle_trigger(writer.option("path", out).option("checkpointLocation", checkpoint), every).start()


def _speeds_sink(speeds: DataFrame, out: str, published: str | None, cleared: str | None, checkpoint: str, every: int | None) -> StreamingQuery:
    """Speeds go to ``out``/batch=N, edges that went stale to ``cleared``/batch=N and the latest state per edge to ``published``.

    State and progress are Spark's; the sink only writes, and a replayed micro-batch writes the same again.
    """
    several = cleared is not None or published is not None

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist() if several else batch
        rows = batch.filter(~F.col("cleared")).drop("cleared")
        rows.drop("clock").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if cleared is not None:
            gone = batch.filter("cleared").select("edge_id", F.col("prev_t").alias("last_t"), F.col("t").alias("cleared_t"))
            gone.write.mode("overwrite").parquet(f"{cleared}/batch={batch_id}")
        if published is not None:
            newest = F.max_by(F.struct("speed", F.col("clock").alias("t"), "status"), F.struct("clock", "t", "event_id"))
            upsert_latest(rows.groupBy("edge_id").agg(newest.alias("s")).select("edge_id", "s.*"), published, batch_id, "edge_id", "t")
        if several:
            batch.unpersist()

    writer = speeds.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return cycle_trigger(writer, every).start()


def stream_edge_speeds(
    series: DataFrame, out: str, checkpoint: str, published: str | None = None, cleared: str | None = None,
    every: int | None = None, mode: str = "sequential",
) -> StreamingQuery:
    """Smoothed speed and status per edge from a stream of edge observations.

    The state lies in Spark's state store, keyed by bucket of edges; rows later than the watermark are dropped.
    """
    return _speeds_sink(state.edge_speeds(series, mode, WATERMARK_SECONDS), out, published, cleared, checkpoint, every)


def stream_traffic(
    frames: DataFrame, mask: RoadMask, coefficients: DataFrame, camera_edges: DataFrame, free_flow: DataFrame,
    thresholds: DataFrame, out: str, checkpoint: str, published: str | None = None, cleared: str | None = None,
    every: int | None = None, mode: str = "sequential",
) -> StreamingQuery:
    """Boxes to published speed and status per edge, in one streaming query.

    Each input row is a whole frame with its ``boxes`` (schemas.FRAME). In ``batch`` mode all of a micro-batch meet the
    state before it and the last one of an edge counts.
    """
    observed = frame_rows.measured(frames, mask, coefficients).withColumnRenamed("frame_id", "event_id")
    series = edge_series(observed, camera_edges, free_flow, thresholds)
    return _speeds_sink(state.edge_speeds(series, mode, WATERMARK_SECONDS), out, published, cleared, checkpoint, every)


def stream_accident_alerts(series: DataFrame, out: str, checkpoint: str, every: int | None = None) -> StreamingQuery:
    """Streak and alert flag for every processed frame of a stream."""
    return _append(state.accident_alerts(series, WATERMARK_SECONDS), out, checkpoint, every)


def stream_alert_records(
    series: DataFrame, camera_edges: DataFrame, cameras: DataFrame, out: str, checkpoint: str, every: int | None = None
) -> StreamingQuery:
    """Published alert records from a stream of processed frames, as JSON in ``out``; a replayed micro-batch counts once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_alerts(alert_records(batch.filter("fires"), camera_edges, cameras), out, "stream", batch_id)

    fired = state.accident_alerts(series, WATERMARK_SECONDS)
    return cycle_trigger(fired.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), every).start()


def stream_camera_stats(frame_loads: DataFrame, out: str, checkpoint: str, every: int | None = None) -> StreamingQuery:
    """Running frame count and largest load per camera, kept as a published table."""
    stats = frame_loads.groupBy("cam").agg(F.count(F.lit(1)).alias("frames"), F.max("meu").alias("meu_max"))
    writer = stats.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: upsert_latest(batch, out, batch_id, "cam", "frames")
    )
    return cycle_trigger(writer, every).start()


def stream_calibration(frames: DataFrame, coefficients: DataFrame, gathered: str, run: str, checkpoint: str, every: int | None = None) -> StreamingQuery:
    """Gathers what calibration needs from whole frames (schemas.FRAME): heat, frame counts and largest loads.

    Heat adds up, so each micro-batch must count once: it leaves only its own sums, in a folder of its own, and the ledger
    of ``run`` keeps a replayed one out. ``jobs.finish_calibration`` makes masks and limits of them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        boxes = batch.select(*CAMERA, F.inline("boxes"))
        append_rows(heatmap(boxes), f"{gathered}/heat", run, batch_id)
        loads = batch.withColumn("meu", frame_rows.load(coefficients))
        stats = loads.groupBy(*CAMERA).agg(F.count(F.lit(1)).alias("frames"), F.max("meu").alias("meu_max"))
        append_rows(stats, f"{gathered}/stats", run, batch_id)
        batch.unpersist()

    writer = frames.withColumn("boxes", frame_rows.boxes_or_none(frames)).writeStream.foreachBatch(write)
    return cycle_trigger(writer.option("checkpointLocation", checkpoint), every).start()


def stream_cycle_window(rows: DataFrame, out: str, checkpoint: str, every: int | None = None) -> StreamingQuery:
    """Frames per tumbling cycle, each written once when the watermark has passed its end.

    Rows of a cycle that is written already are dropped; ``dropped_rows`` tells how many.
    """
    return _append(cycle_window(with_event_time(rows)), out, checkpoint, every)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that a query's stateful operators dropped as late, over its last hundred micro-batches.

    Aggregation meets rows that a task has summed up already, so several late rows of a window may count as one.
    """
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])


def with_event_time(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ts", F.timestamp_seconds("t")).withWatermark("ts", f"{WATERMARK_SECONDS} seconds")


def dedup_observations(rows: DataFrame) -> DataFrame:
    """First copy of every observation; replays within the watermark are dropped."""
    return with_event_time(rows).dropDuplicatesWithinWatermark(["event_id"])


def stream_dedup(rows: DataFrame, out: str, checkpoint: str, every: int | None = None) -> StreamingQuery:
    return _append(dedup_observations(rows).drop("ts"), out, checkpoint, every)
