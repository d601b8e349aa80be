import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import vector_codes as V
from roadpulse.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, parts=16, entries=64, rounds=2):
    """{row: (code, error)} and codebooks of (vec_id, vector) rows by plain loops over Python integers."""
    size = len(rows[0][1])
    width = -(-size // parts)
    cut = []
    for _, v in rows:
        q = [math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in v] + [0] * (parts * width - size)
        cut.append([q[p * width : (p + 1) * width] for p in range(parts)])
    firsts = {}
    for (i, v), c in zip(rows, cut):
        if i not in firsts or v < firsts[i][0]:
            firsts[i] = (v, c)
    order = sorted(firsts, key=lambda i: (i is None, i or 0))[:entries]
    books = [[list(firsts[i][1][p]) for i in order] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(x) // len(members[j]) for x in zip(*members[j])] if j in members else e for j, e in enumerate(books[p])]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    return [("".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f)) for f in found], books


@pytest.mark.parametrize("width", [1, 2, 3, 4, 7, 16])
def test_nearest_equals_plain_distances(width):
    rng = np.random.default_rng(width)
    for top in (2, 300, 2**39, 2**70):
        draw = lambda n: np.array([[int(x * top) for x in r] for r in rng.uniform(-1, 1, (n, width))], object)
        a, b = draw(300), draw(64)
        if top < 2**60:
            a, b = a.astype(np.int64), b.astype(np.int64)
        place, error = V.nearest(a, b)
        plain = [[sum((int(x) - int(y)) ** 2 for x, y in zip(r, e)) for e in b] for r in a]
        assert place.tolist() == [min(range(64), key=lambda j: (d[j], j)) for d in plain]
        assert [int(e) for e in error] == [min(d) for d in plain]


def test_coefficients_by_sequency():
    for width in (1, 2, 4, 8, 32):
        rows = V.hadamard(np.eye(width, dtype=np.int64))
        assert [(np.diff(rows[:, k]) != 0).sum() for k in range(width)] == list(range(width))


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=20).tolist(), i % 3 if i % 5 else None) for i in range(150)]
    good += [(3, good[3][1], 1), (4, rng.normal(size=20).tolist(), 0), (None, rng.normal(size=20).tolist(), 2), (500, [0.0] * 20, 2), (501, [-0.001] * 20, None)]
    bad = [(900, None, 1), (901, [None] * 20, 1), (902, [float("nan")] + [0.0] * 19, 1), (903, [0.0] * 19 + [float("-inf")], None), (904, [1.0] * 8, 1), (905, [], 2)]
    docs = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<double>, label int").withColumn("CODE", F.lit("x")).withColumn("vector", F.lit(1)).repartition(3)
    for entries, rounds in ((64, 2), (5, 3), (200, 1)):
        coded, books = V.compress(docs, entries=entries, rounds=rounds)
        want, entries_want = brute([(i, v) for i, v, _ in good], entries=entries, rounds=rounds)
        assert books.entries == entries_want
        labels = {}
        for (_, _, label), (_, error) in zip(good, want):
            labels[label] = labels.get(label, 0) + error
        got = sorted(map(repr, (tuple(r) for r in coded.select("vec_id", "label", "code", "error", "label_error").collect())))
        assert got == sorted(repr((i, label, code, error, labels[label])) for (i, _, label), (code, error) in zip(good, want))
    back = books.decode(want[0][0])
    assert len(back) == 20 and sum((math.floor(256 * x) - math.floor(256 * y)) ** 2 for x, y in zip(back, good[0][1])) == want[0][1]


def test_huge_components_are_exact(spark):
    rng = np.random.default_rng(6)
    good = [(i, (rng.normal(size=8) * 10.0 ** (i % 20)).tolist()) for i in range(90)] + [(91, [1e308, -1e308] * 4), (92, [1e-300] * 8)]
    coded, books = V.compress(spark.createDataFrame(good, "vec_id bigint, embedding array<double>"), parts=4, entries=10)
    want, entries = brute(good, parts=4, entries=10)
    assert books.entries == entries
    got = {r["vec_id"]: (r["code"], r["error"]) for r in coded.collect()}
    assert got == {i: (code, min(error, 2**63 - 1)) for (i, _), (code, error) in zip(good, want)}


def test_many_labels_and_none(spark, monkeypatch):
    docs = spark.createDataFrame([(i, [float(i), 1.0], None if i < 30 else i) for i in range(60)], "vec_id bigint, embedding array<double>, label int")
    want = sorted(map(tuple, V.compress(docs, parts=2, entries=4)[0].collect()))
    monkeypatch.setattr(V, "SMALL_ROWS", 3)
    assert sorted(map(tuple, V.compress(docs, parts=2, entries=4)[0].select("vec_id", "label", "code", "error", "label_error").collect())) == want
    for none in (docs.limit(0), docs.filter("vec_id < 0"), docs.withColumn("embedding", F.array().cast("array<double>"))):
        rows, books = V.compress(none)
        assert rows.count() == 0 and books is None


def test_query_equals_check(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = QUERIES["op13_vector_codes"](spark, SF).toPandas()
    want = con.execute(ORACLES["op13_vector_codes"]).df()
    assert len(got) == 500 and sorted(map(tuple, got[sorted(got)].values.tolist())) == sorted(map(tuple, want[sorted(got)].values.tolist()))
