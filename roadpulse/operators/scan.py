"""Exact ordered folds over keyed series whose keys may be arbitrarily large.

Window functions cannot express a state that feeds its own rounded output back, and a fold per group
would put a hot key into one task. Spark does the partitioning and sorting here; the Python part walks
sorted Arrow batches and holds one batch and one state at a time.

* Ordinary keys: hash-partitioned by key, sorted within partitions, folded in one pass.
* Hot keys: range-partitioned by (key, order), so one key spreads over many tasks. Only the first key of a
  task's range can go on from the task before. Its chunk is first folded from every state it may be entered
  with (states soon coincide, so this costs little more than one fold), the other keys' chunks as new; the
  per-chunk results are chained, and each chunk is folded again from its true entry state.
  A chunk entered with a state that wasn't foreseen is folded from that state before the chain goes on.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from roadpulse.session import HOT_ROWS, broadcast_if_small, materialize, split_hot

# Label of an exit that holds for every entry.
ANY = "any entry"


@dataclass(frozen=True)
class Fold:
    """A fold over rows sorted by (time, tie).

    ``step(state, time, *inputs)`` gives (new state, output values); the state is a tuple or None.
    ``entry_states(time, *inputs)`` lists, by label, the states a series may have just before a row at
    ``time``, or is None if the row's step takes no notice of its entry; ``entry_label(state, time)`` names
    the one that a real state stands for, None meaning "as if new". ``resolve(exit, entry)`` turns a chunk's
    exit into the real state when it refers to its entry. With ``bound``, the largest value of that column
    within the key is one more argument of ``entry_states``.
    """

    inputs: tuple[str, ...]
    outputs: str
    step: Callable
    entry_states: Callable
    entry_label: Callable
    resolve: Callable = lambda exit_state, entry: exit_state
    bound: str | None = None


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[list]:
    """Columns as Python lists; those without nulls go through numpy, which is several times faster."""
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return [c.to_pylist() if c.null_count else c.to_numpy(zero_copy_only=False).tolist() for c in columns]


def _append_outputs(fold: Fold, key: str, time: str, schema: pa.Schema, entered: bool):
    """Batch function that appends the fold's outputs; ``entered`` rows carry their chunk and its pickled entry state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, current, state = fold.step, object(), None
        for batch in batches:
            keys, times, *values = _columns(batch, [key, time, *fold.inputs])
            groups = list(zip(keys, *_columns(batch, ["chunk"]))) if entered else keys
            entries = batch.column(batch.schema.get_field_index("entry")) if entered else None
            rows = []
            for i, row in enumerate(zip(keys, times, *values)):
                if groups[i] != current:
                    current = groups[i]
                    entry = entries[i].as_py() if entered else None
                    state = None if entry is None else pickle.loads(entry)
                state, out = step(state, *row[1:])
                rows.append(out)
            kept = [c for n, c in zip(batch.schema.names, batch.columns) if n in schema.names]
            added = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), list(schema)[len(kept):])]
            if rows:
                yield pa.RecordBatch.from_arrays(kept + added, schema=schema)

    return run


def _chunk_exits(fold: Fold, key: str, time: str, schema: pa.Schema, entered: bool):
    """Batch function giving, per (key, chunk), the exit state for every foreseen entry state.

    A chunk is one range of (key, order), so its keys but the first begin in it and are entered with no state. That keeps
    the many states to as many rows as there are chunks, however many keys they hold. ``entered`` rows carry the entry state of their chunk, and only the exit for that one is found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, first, states = None, None, {}

        def result():
            exits = {label: s for s, labels in states.items() for label in labels}
            row = [*current, first, pickle.dumps(exits)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        def begin(t, values, bound, entry, within):
            if entered:
                return {None if entry is None else pickle.loads(entry): [ANY]}
            if within:
                return {None: [None]}
            foreseen = fold.entry_states(t, *values, *bound)
            found = {None: [ANY if foreseen is None else None]}
            for label, s in (foreseen or {}).items():
                found.setdefault(s, []).append(label)
            return found

        for batch in batches:
            keys, times, numbers, *values = _columns(batch, [key, time, "chunk", *fold.inputs])
            bounds = _columns(batch, ["key_bound"]) if fold.bound else []
            entries = batch.column(batch.schema.get_field_index("entry")).to_pylist() if entered else None
            for i, (k, t, n, *v) in enumerate(zip(keys, times, numbers, *values)):
                if (k, n) != current:
                    within = current is not None and current[1] == n
                    if current is not None:
                        yield result()
                    current, first = (k, n), t
                    states = begin(t, v, [b[i] for b in bounds], entries[i] if entered else None, within)
                merged: dict = {}
                for s, labels in states.items():
                    merged.setdefault(fold.step(s, t, *v)[0], []).extend(labels)
                states = merged
        if current is not None:
            yield result()

    return run


def _chain(fold: Fold, schema: pa.Schema):
    """Batch function giving the entry state of every chunk, from rows (key, chunk, first, exits, own) sorted by key and chunk.

    ``own`` holds the exit for the true entry where none was foreseen; a key's chain ends where that is still wanting.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, waiting = object(), None, False
        for batch in batches:
            rows = []
            for key, chunk, first, packed, own in zip(*(c.to_pylist() for c in batch.columns)):
                if key != current:
                    current, state, waiting = key, None, False
                if waiting:
                    continue
                entry, exits = state, pickle.loads(packed)
                label = None if state is None else fold.entry_label(state, first)
                if ANY in exits:
                    state = exits[ANY]
                elif label in exits:
                    state = fold.resolve(exits[label], None if label is None else entry)
                elif own is not None:
                    state = pickle.loads(own)[ANY]
                else:
                    waiting = True
                rows.append((key, chunk, pickle.dumps(entry), waiting))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def ordered_scan(
    df: DataFrame, key: str, time: str, tie: str | list[str], fold: Fold, hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None, max_chunks: int | None = None,
) -> DataFrame:
    """``df`` with the outputs of ``fold`` over each key's rows in (time, tie) order.

    ``counted`` may name a cheaper table with at least the rows of ``df`` per key, to find hot keys in.
    Hot rows go to about one task per ``hot_rows`` of them, or to ``max_chunks`` if that is fewer.
    """
    order = [key, time, *([tie] if isinstance(tie, str) else tie)]
    result = StructType(list(df.schema) + list(StructType.fromDDL(fold.outputs)))
    arrow = to_arrow_schema(result)
    ordinary, hot, rows = split_hot(df, key, hot_rows, counted)
    ordinary = ordinary.repartition(key).sortWithinPartitions(*order)
    folded = ordinary.mapInArrow(_append_outputs(fold, key, time, arrow, False), result)
    if hot is None:
        return folded
    chunks = max(2, min(-(-rows // hot_rows), max_chunks or rows))
    hot = hot.select(*df.columns)
    if fold.bound:
        bounds = hot.groupBy(key).agg(F.max(fold.bound).alias("key_bound"))
        hot = hot.join(bounds, key).select(*df.columns, "key_bound")
    ranged = hot.repartitionByRange(chunks, *order).sortWithinPartitions(*order)
    # Stored, because range bounds are sampled anew in every evaluation and all passes must agree.
    ranged = materialize(ranged.withColumn("chunk", F.spark_partition_id()))
    key_type, time_type = df.schema[key].dataType.simpleString(), df.schema[time].dataType.simpleString()
    summary = StructType.fromDDL(f"{key} {key_type}, chunk int, first {time_type}, exits binary")
    entry = StructType.fromDDL(f"{key} {key_type}, chunk int, entry binary, waiting boolean")

    def enter(entries: DataFrame) -> DataFrame:
        """Rows of chunks with their entry states, in order whichever way they were joined."""
        joined = ranged.join(broadcast_if_small(entries.select(key, "chunk", "entry")), [key, "chunk"])
        return joined.sortWithinPartitions(key, "chunk", *order[1:])

    exits = materialize(ranged.mapInArrow(_chunk_exits(fold, key, time, to_arrow_schema(summary), False), summary))
    own = exits.select(key, "chunk", F.col("exits").alias("own")).limit(0)
    while True:
        steps = exits.join(own, [key, "chunk"], "left").select(key, "chunk", "first", "exits", "own")
        steps = steps.repartition(key).sortWithinPartitions(key, "chunk")
        entries = materialize(steps.mapInArrow(_chain(fold, to_arrow_schema(entry)), entry))
        waiting = entries.filter("waiting")
        if waiting.isEmpty():
            break
        found = enter(waiting).mapInArrow(_chunk_exits(fold, key, time, to_arrow_schema(summary), True), summary)
        own = materialize(own.unionByName(found.select(key, "chunk", F.col("exits").alias("own"))))
    refolded = enter(entries).mapInArrow(_append_outputs(fold, key, time, arrow, True), result)
    return folded.unionByName(refolded)
