"""Positions, running sums, as-of states and marked cycles against plain Python."""

import random

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from roadpulse import constants as K
from roadpulse.operators import edge_state, ordinal, report
from roadpulse.operators.edge_state import smooth_step


def test_positions_and_running_sums(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 40), i, rng.randint(-3, 9)) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int, v int").repartition(7)
    placed = ordinal.numbered(df, ["a", "b"], "position")
    want = [(i, *r) for i, r in enumerate(sorted(rows))]
    assert rows_of(placed.select("position", "a", "b", "v"), "position") == want
    for stretch in (1, 7, 10_000):
        sums = ordinal.running_sum(placed, "position", "v", "sum", stretch).select("position", "sum")
        assert rows_of(sums, "position") == [(i, sum(r[3] for r in want[:i])) for i in range(1000)]
    assert ordinal.numbered(df.limit(0), ["a", "b"], "position").count() == 0


@pytest.mark.parametrize("chunk_seconds", [1200, 5000, 86_400])
def test_state_at_any_moment(spark, chunk_seconds, monkeypatch):
    rng = random.Random(2)
    written = [(e, i, t, float(i), rng.choice(K.STATUSES)) for e in "abc" for i, t in enumerate(sorted(rng.randint(-3000, 20_000) for _ in range(40)))]
    asked = [(rng.choice("abcd"), None, rng.randint(-5000, 25_000)) for _ in range(400)] + [(e, i, t) for e, i, t, *_ in written]
    asked += [(e, None, t + d) for e, _, t, *_ in written for d in (0, 1199, 1200)]
    as_of = lambda *args: ordinal.as_of(*args, chunk_seconds=chunk_seconds)
    monkeypatch.setattr(edge_state, "as_of", as_of)
    history = spark.createDataFrame(written, "edge_id string, event_id long, t long, speed double, status string")
    probes = spark.createDataFrame(asked, "edge_id string, event_id long, t long").withColumn("event_id", F.col("event_id"))
    got = edge_state.prev_state_asof(probes.withColumn("n", F.lit(1)), history).select("edge_id", "t", "prev_speed", "prev_status", "prev_t").collect()
    want = []
    for edge, tie, t in asked:
        before = [(w[2], w[1], w[3], w[4]) for w in written if w[0] == edge and (w[2], w[1]) < (t, 2**62 if tie is None else tie)]
        at, _, speed, status = max(before) if before else (None,) * 4
        want.append((edge, t, *((speed, status, at) if before and t - at < 1200 else (None, None, None))))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_prior_states_of_a_fold(spark):
    rng = random.Random(3)
    series = [("e", 400 * i + rng.choice([0, 0, 900]), i, rng.uniform(3, 50), 50.0) for i in range(60)]
    df = spark.createDataFrame(series, "edge_id string, t long, event_id long, raw_speed double, free_flow double")
    speeds = edge_state.speed_and_status(df)
    state, want = None, []
    for _, t, i, raw, flow in sorted(series, key=lambda r: (r[1], r[2])):
        state, out = smooth_step(state, t, raw, flow)
        want.append((i, *out[:3]))
    found = edge_state.prev_state_asof(df, speeds).select("event_id", "prev_speed", "prev_status", "prev_t")
    assert rows_of(found, "event_id") == sorted(want)


def marked(queue, known, batch_size):
    """The worker's loop: batches of the next items, counts reset after a batch that holds a marker."""
    out, ok, fail, batches, start = [], 0, 0, 0, queue[0][2]
    for at in range(0, len(queue), batch_size):
        batch = queue[at : at + batch_size]
        judged = [cam in known and fetched for item, cam, _, fetched in batch if item != K.CYCLE_SENTINEL]
        ok, fail, batches = ok + sum(judged), fail + len(judged) - sum(judged), batches + 1
        end = max(t for _, _, t, _ in batch)
        ended = any(item == K.CYCLE_SENTINEL for item, *_ in batch)
        if ended or at + batch_size >= len(queue):
            out.append((len(out), ok, fail, ok + fail, batches, ended, end - start))
            ok, fail, batches, start = 0, 0, 0, end
    return out


@pytest.mark.parametrize("size, markers, stretch", [(100, 9, 3), (10, 60, 1000), (7, 1, 2), (50, 400, 4), (1, 30, 10), (2000, 3, 5)])
def test_cycles_end_with_the_batch_of_their_marker(spark, size, markers, stretch):
    rng = random.Random(size)
    queue = [(str(c := rng.randint(0, 30)), c, None, rng.random() < 0.9) for _ in range(900)] + [(K.CYCLE_SENTINEL, None, None, None)] * markers
    rng.shuffle(queue)
    queue = [(item, cam, 100 + 3 * i // 2, fetched) for i, (item, cam, _, fetched) in enumerate(queue)]
    known = set(range(25))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(queue)], "seq long, item string, cam long, t long, fetched boolean").repartition(5)
    cameras = spark.createDataFrame([(c,) for c in known], "cam long")
    stats = report.marked_cycle_stats(df, ["seq"], cameras, spark.createDataFrame([], "cam long"), size, stretch)
    assert rows_of(stats, "cycle_id") == marked(queue, known, size)
