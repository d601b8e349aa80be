import math

import numpy as np
from pyspark.sql import functions as F

from roadpulse.llm import nearest as N
from roadpulse.llm.queries import QUERIES


def brute(ids, vectors, every, k):
    """Nearest lists by plain cosines."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = unit @ unit[i]
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def recall(found, want):
    got = {}
    for r in found:
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    assert set(got) == set(want)
    for q, best in want.items():
        assert all(math.isclose(got[q][v], s, abs_tol=1e-9) for v, s in best if v in got[q])
    return sum(v in got[q] for q, best in want.items() for v, _ in best) / sum(map(len, want.values()))


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    want = brute(rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float), 50, 5)
    found = QUERIES["op6_nearest"](spark, sf).collect()
    assert recall(found, want) >= 0.9
    assert all(sorted(r["rank"] for r in found if r["query_id"] == q) == [1, 2, 3, 4, 5] for q in want)


def test_error_bound_and_codes():
    points = N.unit(np.random.default_rng(1).standard_normal((3000, 64)))
    centroids, cells, turn = N.unit(points[:8]), (points @ N.unit(points[:8]).T).argmax(1), N.rotation(64)
    asked = N.unit(np.random.default_rng(2).standard_normal((50, 64)))
    inside = []
    for c in range(8):
        own = points[cells == c]
        codes, length, inner = N.encode(own, centroids, np.full(len(own), c), turn)
        near, width = N.estimate(codes, length, inner, asked @ centroids[c], asked @ turn.T)
        inside.append((np.abs(near - asked @ own.T) <= width + 1e-9).mean())
    assert min(inside) > 0.99


def test_copies_and_odd_rows(spark):
    rnd = np.random.default_rng(3)
    vectors = [rnd.standard_normal(8).tolist() for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(100 + i, vectors[0]) for i in range(60)] + [(0, vectors[0])] + [(200, [2 * x for x in vectors[1]])]
    odd = [(10_000, None), (10_010, [0.0] * 8), (10_020, [float("nan")] * 8), (10_030, [None] * 8), (10_040, [1.0]), (None, vectors[3]), (10_050, [float("inf")] + [1.0] * 7), (10_060, [])]
    docs = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").withColumn("Score", F.lit("old"))
    found = N.nearest(docs, every=10, k=5).collect()
    ids = np.array([i for i, _ in dict(rows).items()])
    want = brute(ids, np.array([dict(rows)[i] for i in ids.tolist()]), 10, 5)
    assert recall(found, want) >= 0.9
    # A vector that is stored often: the nearest are its copies with the smallest ids.
    assert [r["vec_id"] for r in sorted((r for r in found if r["query_id"] == 100), key=lambda r: r["rank"])] == [0, 101, 102, 103, 104]
    assert N.nearest(docs.limit(0), every=10).count() == 0
    assert N.nearest(docs.filter("vec_id in (1, 2)"), every=10).count() == 0
    few = N.nearest(docs.filter("vec_id in (10, 11)"), every=10).collect()
    assert [(r["query_id"], r["vec_id"]) for r in few] == [(10, 11)]


def test_every_query_gets_its_neighbours(spark):
    """Tiny clusters whose cells hold too few rows, and norms whose squares over- or underflow."""
    rnd = np.random.default_rng(8)
    centers = rnd.standard_normal((120, 16))
    rows = [(c, i) for c in range(60) for i in range(200)] + [(c, i) for c in range(60, 120) for i in range(2)]
    vectors = [(centers[c] + 0.05 * rnd.standard_normal(16)) * 10.0 ** (n % 5 * 100 - 200) for n, (c, _) in enumerate(rows)]
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>").repartition(4)
    found = N.nearest(docs, every=20, k=5).collect()
    want = brute(np.arange(len(rows)), np.stack([v / np.abs(v).max() for v in vectors]), 20, 5)
    per_query = {}
    for r in found:
        per_query.setdefault(r["query_id"], []).append(r["rank"])
    assert len(per_query) == len(want) and all(sorted(v) == [1, 2, 3, 4, 5] for v in per_query.values())
    assert all(-1.000001 <= r["score"] <= 1.000001 for r in found)
    assert recall(found, want) >= 0.95
