"""Sharding by sampled splitters: shards of near-equal bytes, each a contiguous range of keys.

The key of a row is (hash of its text, doc_id, row number), so equal texts lie side by side. A size-weighted sample of
keys gives quantile boundaries of many small ranges; ranges that turn out overfull are divided by a sample of their
own until none is. Exact sums per range then place every row on the line of all bytes, cut into equal parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count as count_from

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadpulse.llm.common import stored

SHARDS = 24
ROW_BYTES = 8
# Ranges per shard, rows in a range, and keys sampled for each range: all bounds, whatever the input.
RANGES_PER_SHARD = 8
RANGE_ROWS = 2_000_000
SAMPLES_PER_RANGE = 64
SEED = 7
# A range is overfull beyond this many times the mean.
OVERFULL = 2.0
# A group of equal texts up to this share of a shard isn't cut at a shard's border.
WHOLE_GROUP = 0.02

KEY = ("h", "k", "u")


def _quantiles(keys: list[tuple[int, int, int, float]], parts: int) -> list[tuple[int, int, int]]:
    """Keys that cut a weighted sample into ``parts`` stretches of about equal weight."""
    total, out, run = sum(k[3] for k in keys), [], 0.0
    for h, k, u, w in sorted(keys):
        if run + w >= total * (len(out) + 1) / parts and len(out) < parts - 1:
            out.append((h, k, u))
        run += w
    return sorted(set(out))


def _splitters(rows: DataFrame, amount: float, parts: int, seed: int) -> list[tuple[int, int, int]]:
    """Keys that cut ``rows`` into about ``parts`` ranges of equal weight, from a weighted sample of bounded size."""
    step = amount / (parts * SAMPLES_PER_RANGE)
    chosen = rows.filter(F.rand(seed) < F.col("weight") / step).select(*KEY, F.greatest("weight", F.lit(step)).alias("w"))
    return _quantiles([(r["h"], r["k"], r["u"], r["w"]) for r in chosen.collect()], parts)


def _ranged(rows: DataFrame, splitters: list[tuple[int, int, int]]) -> DataFrame:
    """``rows`` with ``range``: how many splitters are not above the key."""
    table = np.array(splitters, np.int64).reshape(-1, 3)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, k, u = (np.asarray(batch.column(names.index(c))) for c in KEY)
            low, high = np.searchsorted(table[:, 0], h, "left"), np.searchsorted(table[:, 0], h, "right")
            place = low.copy()
            for i in np.flatnonzero(high > low):  # only keys whose hash is a splitter's
                own = table[low[i] : high[i]]
                place[i] += int(((own[:, 1] < k[i]) | ((own[:, 1] == k[i]) & (own[:, 2] <= u[i]))).sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int32())], names=[*names, "range"])

    return rows.mapInArrow(run, f"{', '.join(f'{n} {t}' for n, t in rows.dtypes)}, range int")


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), a row per row of ``docs``.

    ``size`` is the bytes of the text in UTF-8 plus 8; a null text has none and the checksum of an empty one. The law
    is ``bytes``: shards are ranges of keys cut where the running sum of sizes passes the next of equal parts, so they
    differ by about a row. ``slot`` counts a shard's rows from 0. Repeated rows and null doc_ids are placed like all
    others. An empty table gives an empty table; with fewer rows than shards some stay empty.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), (F.octet_length(value) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(value).alias("text_crc32"), F.xxhash64(value).alias("h"),
        F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(-(2**63))).alias("k"), F.monotonically_increasing_id().alias("u"),
    )
    rows = stored(rows, "rows")
    count, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not count:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

    # Bytes and rows count alike, so a range is bounded in both.
    parts = max(shards * RANGES_PER_SHARD, -(-count // RANGE_ROWS))
    weighed = rows.withColumn("weight", F.col("size") / F.lit(float(total)) + F.lit(1.0 / count))
    splitters = _splitters(weighed, 2.0, parts, SEED) if count > parts else []
    limit = OVERFULL * 2.0 / parts
    for turn in count_from(1):
        ranged = _ranged(weighed, splitters)
        sums = {r["range"]: r for r in ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"), F.sum("weight").alias("w")).collect()}
        overfull = [i for i, r in sums.items() if r["w"] > limit and r["n"] > 2 * SAMPLES_PER_RANGE]
        if not overfull:
            break
        more: set[tuple[int, int, int]] = set()
        for i in overfull:  # at most `parts / OVERFULL` of them
            own = ranged.filter(F.col("range") == i)
            found = set(_splitters(own, sums[i]["w"], int(-(-sums[i]["w"] * parts // 2.0)), SEED + turn)) - set(splitters)
            if not found:  # the sample told nothing new: some rows of the range at random, whose keys all differ
                drawn = own.orderBy(F.rand(SEED + turn)).limit(SAMPLES_PER_RANGE).select(*KEY).collect()
                found = set(_quantiles([(r["h"], r["k"], r["u"], 1.0) for r in drawn], 2)) - set(splitters)
            more |= found
        splitters = sorted({*splitters, *more})
    before, seen_rows, seen_bytes = [], 0, 0
    for i in sorted(sums):
        before.append((i, seen_rows, seen_bytes))
        seen_rows, seen_bytes = seen_rows + sums[i]["n"], seen_bytes + sums[i]["b"]
    of_range = docs.sparkSession.createDataFrame(before, "range int, before_rows bigint, before_bytes bigint")

    inside = Window.partitionBy("range").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.select("doc_id", "size", "text_crc32", "h", "range", F.count(F.lit(1)).over(inside).alias("n"), F.sum("size").over(inside).alias("b"))
    placed = placed.join(F.broadcast(of_range), "range").select(  # one row per range
        "doc_id", "size", "text_crc32", "h", (F.col("before_rows") + F.col("n") - 1).alias("place"), (F.col("before_bytes") + F.col("b")).alias("through"),
    )
    middle = 2 * F.col("through") - F.col("size")
    placed = placed.withColumn("shard", F.least(F.expr(f"{shards}").cast("bigint") * middle / F.lit(2 * total), F.lit(shards - 1)).cast("int"))
    placed = stored(placed.drop("through"), "placed")
    # At most one group lies across each border; small ones go where their middle is.
    across = placed.groupBy("h").agg(F.min("shard").alias("low"), F.max("shard").alias("high"), F.sum("size").alias("b"), F.percentile_approx("shard", 0.5).alias("to"))
    moved = across.filter((F.col("low") < F.col("high")) & (F.col("b") <= WHOLE_GROUP * total / shards)).select("h", "to").collect()
    own = F.col("shard")
    for r in moved:
        own = F.when(F.col("h") == r["h"], F.lit(r["to"])).otherwise(own)
    placed = placed.withColumn("shard", own)
    first = {r["shard"]: r["p"] for r in placed.groupBy("shard").agg(F.min("place").alias("p")).collect()}
    start = F.get(F.array(*[F.lit(first.get(i, 0)).cast("bigint") for i in range(shards)]), F.col("shard"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
