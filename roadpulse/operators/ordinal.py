"""Positions and running sums along one global order, split over tasks.

Each task numbers its own stretch; only one sum per stretch is put in line, and what lies before a stretch is carried
into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse.session import broadcast_if_small, materialize

# Bits of a row's number within its partition, as Spark's increasing ids have it.
ROW_BITS = 33
# Positions that are summed up together.
STRETCH = 1_000_000


def _before(stretches: DataFrame, order: list[str], value: str) -> DataFrame:
    """``stretches`` with ``before``: the sum of ``value`` over all earlier ones. There is one row per stretch."""
    line = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return stretches.withColumn("before", F.coalesce(F.sum(value).over(line), F.lit(0))).drop(value)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its position (from 0) along ``order``, which must not tie; one range shuffle and no window over rows."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("own", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("stretch", F.shiftright("own", ROW_BITS)))
    stretches = _before(placed.groupBy("stretch").agg(F.count(F.lit(1)).alias("rows")), ["stretch"], "rows")
    joined = placed.join(F.broadcast(stretches), "stretch")  # one row per partition
    return joined.withColumn(name, F.col("own").bitwiseAND(2**ROW_BITS - 1) + F.col("before")).drop("own", "stretch", "before")


def running_sum(df: DataFrame, position: str, value: str, name: str, stretch: int = STRETCH) -> DataFrame:
    """``df`` (stored) with the sum of ``value`` over all rows at lower positions; positions have few gaps and no ties."""
    rows = df.withColumn("stretch", F.expr(f"{position} div {stretch}L"))
    stretches = _before(rows.groupBy("stretch").agg(F.sum(value).alias("sum")), ["stretch"], "sum")
    inside = W.partitionBy("stretch").orderBy(position).rowsBetween(W.unboundedPreceding, -1)
    own = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return rows.join(broadcast_if_small(stretches), "stretch").withColumn(name, own + F.col("before")).drop("stretch", "before")


def file_position(df: DataFrame, explicit: Column) -> DataFrame:
    """``df`` (read from files, with columns ``file`` and ``split`` from their metadata) with ``ordinal``.

    Files count by path, and within a file its splits by where they begin, however Spark deals them to tasks; an
    ``explicit`` ordinal goes before the position.
    """
    rows = materialize(df.withColumn("own", F.monotonically_increasing_id()))
    splits = rows.groupBy("file", "split").agg(F.count(F.lit(1)).alias("rows"), F.min("own").alias("first"))
    splits = _before(splits, ["file", "split"], "rows")
    joined = rows.join(broadcast_if_small(splits), ["file", "split"])
    position = F.col("own") - F.col("first") + F.col("before")
    return joined.withColumn("ordinal", F.coalesce(explicit, position)).drop("file", "split", "own", "first", "before")


def as_of(probes: DataFrame, history: DataFrame, key: str, value: list[str], ttl: int, chunk_seconds: int = 86_400) -> DataFrame:
    """``probes`` (key, t, tie) with the ``value`` columns and ``found_t`` of the last row of ``history`` (key, t, tie, value) before.

    Before means a smaller (t, tie), and less than ``ttl`` seconds ago; else both are null. Rows of a key are put in
    order by chunks of time, so a key's chunks go to different tasks, and the last state of a chunk is carried on.
    """
    if ttl > chunk_seconds:
        raise ValueError("a chunk must be as long as a state lives")
    held = F.struct(*value, F.col("t").alias("found_t"))
    written = history.select(key, "t", "tie", F.lit(1).alias("kind"), held.alias("state"))
    asked = probes.withColumn("kind", F.lit(0))
    rows = asked.unionByName(written, allowMissingColumns=True).withColumn("chunk", F.expr(f"t div {chunk_seconds}L"))
    order = W.partitionBy(key, "chunk").orderBy("t", "tie", "kind").rowsBetween(W.unboundedPreceding, -1)
    met = rows.withColumn("found", F.last("state", ignorenulls=True).over(order)).filter("kind = 0")
    # A state lives no longer than a chunk, so only the chunk before can still matter.
    exits = written.withColumn("chunk", F.expr(f"t div {chunk_seconds}L + 1")).groupBy(key, "chunk").agg(F.max_by("state", F.struct("t", "tie")).alias("carried"))
    met = met.join(exits, [key, "chunk"], "left").withColumn("found", F.coalesce("found", "carried"))
    met = met.withColumn("found", F.when(F.col("t") - F.col("found.found_t") < ttl, F.col("found")))
    return met.select(*probes.columns, "found.*")
