"""Ordered folds: status table, brute force, and hot keys split over chunks."""

import pickle
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadpulse.operators import accident, edge_state, scan
from roadpulse.operators.edge_state import next_status, smooth_step
from __spark_entry__ import QUERIES

EDGE_SCHEMA = "edge_id string, t bigint, event_id bigint, raw_speed double, free_flow double, batch_id bigint"
CAM_SCHEMA = "cam bigint, t bigint, event_id bigint, class_name string, conf double, hit boolean"

# previous status -> status for slowdowns just below and at each bound
SLOWDOWNS = [-0.5, 0.2999, 0.30, 0.3999, 0.40, 0.5999, 0.60, 0.7499, 0.75, 1.0]
EXPECTED = {
    None: "G G G G Y Y Y Y R R",
    "GREEN": "G G G G Y Y Y Y Y Y",
    "YELLOW": "G G Y Y Y Y Y Y R R",
    "RED": "G G Y Y Y Y R R R R",
}


@pytest.mark.parametrize("previous", EXPECTED)
def test_status_table(previous):
    assert " ".join(next_status(d, previous)[0] for d in SLOWDOWNS) == EXPECTED[previous]


def test_state_expires_at_exactly_the_limit():
    state, _ = smooth_step(None, 0, 10.0, 50.0)
    assert smooth_step(state, 1199, 50.0, 50.0)[1][0] == 10.0
    assert smooth_step(state, 1200, 50.0, 50.0)[1][:3] == (None, None, None)


@given(st.lists(st.tuples(st.integers(0, 2000), st.floats(3.0, 60.0)), min_size=1, max_size=40))
@settings(max_examples=100, deadline=None)
def test_smoothed_speed_stays_within_raw_speeds(rows):
    state, t = None, 0
    for gap, raw in rows:
        t += gap
        state, out = smooth_step(state, t, raw, 60.0)
        assert min(r for _, r in rows) - 0.05 <= out[4] <= max(r for _, r in rows) + 0.05


def edge_rows(spark, hot=1500, seed=1):
    """One edge with most of the rows, some of them constant for long, and several small ones."""
    rng = random.Random(seed)
    rows, t = [], 0
    for i in range(hot):
        t += rng.choice([0, 1, 20, 20, 20, 1100, 1199, 1200, 1300]) if i % 400 < 100 else 20
        steady = 600 < i < 1100
        rows.append(("hot", t, i, 50.0 if steady else rng.choice([3.0, 12.5, 20.0, 47.3, 50.0]), 50.0, t // 20))
    for k in range(6):
        rows += [(f"e{k}", 20 * j, 10_000 + 100 * k + j, float(rng.randint(3, 40)), 40.0, j) for j in range(30)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, EDGE_SCHEMA).repartition(5)


def brute_force(rows, step, inputs):
    out, key, state = [], None, None
    for row in sorted(rows, key=lambda r: (r[0], r.t, r.event_id)):
        if row[0] != key:
            key, state = row[0], None
        state, result = step(state, row.t, *[row[i] for i in inputs])
        out.append((row[0], row.event_id, *result))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows", [10**6, 100, 37])
def test_edge_fold_equals_brute_force(spark, hot_rows):
    series = edge_rows(spark)
    want = brute_force(series.collect(), smooth_step, ["raw_speed", "free_flow"])
    got = edge_state.speed_and_status(series, hot_rows=hot_rows)
    names = ["edge_id", "event_id", "prev_speed", "prev_status", "prev_t", "ema", "speed", "status"]
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == want


def incident_rows(spark, hot=1200, seed=2):
    rng = random.Random(seed)
    rows, t = [], 1000
    for i in range(hot):
        t += rng.choice([0, 5, 10, 10, 10, 49, 50, 51, 300])
        rows.append((1, t, i, "human_incident", 0.9, rng.random() < (0.97 if i % 300 < 200 else 0.5)))
    for cam in range(2, 6):
        rows += [(cam, 1000 + 10 * j, 5000 + 100 * cam + j, "vehicle_incident", 0.8, rng.random() < 0.8) for j in range(40)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, CAM_SCHEMA)


@pytest.mark.parametrize("hot_rows", [10**6, 90, 25])
def test_streak_and_cooldown_equal_brute_force(spark, hot_rows):
    series = incident_rows(spark)
    want = brute_force(series.collect(), accident.streak_step, ["hit"])
    streaks = accident.incident_streak(series, 7 * hot_rows)
    got = streaks.select("cam", "event_id", "streak").collect()
    assert sorted((tuple(r) for r in got), key=repr) == want

    alerts = accident.alert_cooldown(streaks, hot_rows).select("cam", "event_id", "t").collect()
    expected, last = [], {}
    for row in sorted(streaks.filter("streak >= 3").collect(), key=lambda r: (r.cam, r.t, r.event_id)):
        if row.cam not in last or row.t - last[row.cam] >= 300:
            last[row.cam] = row.t
            expected.append((row.cam, row.event_id, row.t))
    assert sorted(map(tuple, alerts)) == sorted(expected)


def test_batch_mode_folds_the_last_row_of_each_batch(spark):
    series = edge_rows(spark)
    last = {}
    for r in sorted(series.collect(), key=lambda r: (r.t, r.event_id)):
        last[r.edge_id, r.batch_id] = r.event_id
    got = edge_state.speed_and_status(series, "batch").select("event_id").collect()
    assert sorted(r.event_id for r in got) == sorted(last.values())


@pytest.mark.parametrize("hot_rows", [10**6, 100])
def test_resumed_fold_equals_one_run(spark, hot_rows):
    series = edge_rows(spark)
    whole = edge_state.speed_and_status(series)
    middle = series.selectExpr("percentile(t, 0.5)").first()[0]
    first = edge_state.speed_and_status(series.filter(f"t <= {middle}"), hot_rows=hot_rows)
    state = edge_state.expire_state(edge_state.latest_state(first))
    second = edge_state.speed_and_status(series.filter(f"t > {middle}"), hot_rows=hot_rows, previous=state)
    key = lambda df: sorted(map(repr, df.select(*whole.columns).collect()))
    assert key(first.unionByName(second)) == key(whole)


@pytest.mark.parametrize("name", ["speed_ema_hot", "speed_ema_resumed_hot"])
def test_hot_queries_take_the_hot_way(spark, monkeypatch, name):
    shares, split = [], scan.split_hot

    def watched(df, key, *rest):
        ordinary, hot, rows = split(df, key, *rest)
        shares.append(0 if hot is None else hot.select(key).distinct().count() / df.select(key).distinct().count())
        return ordinary, hot, rows

    monkeypatch.setattr(scan, "split_hot", watched)
    assert QUERIES[name](spark, "/root/testdata/sf0.01").count() > 0
    assert len(shares) == (1 if name == "speed_ema_hot" else 6) and min(shares) > 0.5


def test_only_the_first_key_of_a_chunk_is_folded_from_many_states():
    schema = pa.schema([("edge_id", pa.string()), ("chunk", pa.int32()), ("first", pa.int64()), ("exits", pa.binary())])
    rows = {"edge_id": ["a", "a", "b", "b"], "t": [0, 20, 0, 20], "chunk": [3] * 4, "raw_speed": [9.0, 8.0, 7.0, 6.0], "free_flow": [50.0] * 4, "key_bound": [9.0, 9.0, 7.0, 7.0]}
    run = scan._chunk_exits(edge_state.EDGE_FOLD, "edge_id", "t", schema, False)
    exits = {r["edge_id"]: pickle.loads(r["exits"]) for batch in run(iter([pa.RecordBatch.from_pydict(rows)])) for r in batch.to_pylist()}
    assert len(exits["a"]) > 100 and exits["b"] == {None: (6.7, "RED", 20)}
