"""Approximate nearest neighbours by cosine, with randomly rotated one-bit codes.

Vectors are dealt to cells around centroids fitted on a bounded sample. In its cell a vector is stored as the signs of
its rotated, normalised offset from the centroid, packed into bits, and two scalars. A query looks into the cells
nearest to it: inner products are estimated from the bits, and only vectors whose error bound reaches the best ones
found are reranked by their exact cosine. How many cells to look into is fitted on the sample, for a recall of
``TARGET`` there. Every row is indexed; equal vectors are stored once with their smallest ids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadpulse.llm.common import stored

# Vectors that the index is fitted on, at most about.
SAMPLE = 20_000
MAX_CELLS = 4096
ROUNDS = 8
TARGET = 0.98
# Width of the error bound, in standard deviations.
WIDTH = 3.0
BLOCK_ROWS, BLOCK_QUERIES = 4096, 2048
SEED = 11


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near one, so that no square over- or underflows."""
    vectors = vectors.astype(np.float64)
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -power)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.maximum(np.sqrt((vectors * vectors).sum(1, keepdims=True)), 1e-300)


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def fit(sample: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, int]:
    """Centroids for an index of ``rows`` vectors, and how many cells a query has to look into."""
    points = unit(sample)
    cells = int(np.clip(np.sqrt(rows), 1, min(MAX_CELLS, max(1, len(points) // 8))))
    random = np.random.default_rng(SEED)
    centroids = points[random.choice(len(points), cells, replace=False)]
    for _ in range(ROUNDS):
        own = (points @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        filled = np.linalg.norm(sums, axis=1) > 0
        centroids[filled] = unit(sums[filled])
    own = (points @ centroids.T).argmax(1)
    asked = random.choice(len(points), min(400, len(points)), replace=False)
    near = points[asked] @ points.T
    near[np.arange(len(asked)), asked] = -2
    best = np.argsort(-near, axis=1)[:, :k]
    order = np.argsort(-(points[asked] @ centroids.T), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(cells)[None, :], axis=1)
    needed = np.take_along_axis(rank, own[best], axis=1) + 1  # cells to look into until each neighbour is met
    probes = int(np.quantile(needed, TARGET, method="higher")) if needed.size else 1
    return centroids, min(cells, max(1, probes))


def encode(vectors: np.ndarray, centroids: np.ndarray, cells: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, length of the offset, and inner product of code and offset, of unit vectors in their cells."""
    offset = (vectors - centroids[cells]) @ turn.T
    length = np.sqrt((offset * offset).sum(1))
    bits = offset > 0
    inner = np.abs(offset).sum(1) / np.sqrt(offset.shape[1]) / np.maximum(length, 1e-300)
    return np.packbits(bits, axis=1), length, np.where(length > 0, inner, 1.0)


def estimate(codes: np.ndarray, length: np.ndarray, inner: np.ndarray, base: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (query, vector) and the half width of their error bound.

    ``base`` holds the inner products of queries and centroid, ``turned`` the rotated unit queries.
    """
    dims = turned.shape[1]
    signs = np.unpackbits(codes, axis=1)[:, :dims].astype(np.float64) * 2 - 1
    scale = length / inner
    rough = (turned @ signs.T) / np.sqrt(dims)
    spread = np.sqrt(np.maximum(0, 1 - inner**2)) * scale / np.sqrt(max(1, dims - 1))
    return base[:, None] + rough * scale, np.broadcast_to(WIDTH * spread, rough.shape)


def search_block(data: dict[str, np.ndarray], queries: np.ndarray, centroid: np.ndarray, turn: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query row, data row, exact cosine) of the ``k`` best of a block for each query."""
    asked = unit(queries)
    near, width = estimate(data["codes"], data["length"], data["inner"], asked @ centroid, asked @ turn.T)
    lower = near - width
    keep = min(k, lower.shape[1])
    bar = np.partition(lower, lower.shape[1] - keep, axis=1)[:, lower.shape[1] - keep]
    q, v = np.nonzero(near + width >= bar[:, None])
    # Sums go row by row, so equal vectors get equal scores wherever they stand.
    asked, held = scaled(queries), scaled(data["vectors"])
    size_asked, size_held = (np.sqrt((x * x).sum(1)) for x in (asked, held))
    out = []
    for a in range(0, len(q), 100_000):
        qa, va = q[a : a + 100_000], v[a : a + 100_000]
        score = (asked[qa] * held[va]).sum(1) / (size_asked[qa] * size_held[va])
        out.append(np.rec.fromarrays([qa, va, score, data["first"][va]], names="q,v,s,i"))
    found = np.concatenate(out)
    found = found[np.lexsort((found["i"], -found["s"], found["q"]))]
    place = np.arange(len(found)) - np.searchsorted(found["q"], found["q"])
    return [(int(r["q"]), int(r["v"]), float(r["s"])) for r in found[place < k]]


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) of the rows that take part: an id, and a vector of the commonest length, finite and not zero."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).filter(fine)
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == common["n"]) if common else rows


def nearest(vectors: DataFrame, every: int, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for rows with an id divisible by ``every``, the ``k`` nearest other rows found.

    ``score`` is the cosine of the original vectors in double precision; ties go to the smaller id. Vectors that are
    null, zero or of another length than most, or hold null or non-finite components, take no part. Repeated rows of
    an id and vector count once. An empty table, or one without queries, gives an empty result.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, vec_id, embedding).distinct().withColumn("g", F.unhex(F.md5(F.array_join(F.transform("v", lambda x: x.cast("string")), " ")))), "vectors")
    # A query's own row may be among the smallest ids, so one more than k is kept of each.
    order = Window.partitionBy("g").orderBy("vec_id")
    firsts = rows.select("g", "vec_id").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    ids = firsts.groupBy("g").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    holders = rows.join(firsts.filter("n = 1").select("g", "vec_id"), ["g", "vec_id"])
    different = stored(holders.select("g", "v", F.col("vec_id").alias("first")), "different")
    count = different.count()
    none = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    if not count or asked.isEmpty():
        return none
    share = min(1.0, SAMPLE / count)
    drawn = different.filter(F.pmod(F.xxhash64("g"), F.lit(1_000_003)) < share * 1_000_003).orderBy("first").select("v").collect()
    sample = np.array([r["v"] for r in drawn])
    if not len(sample):
        sample = np.array([different.select("v").first()["v"]])
    centroids, probes = fit(sample, count, k + 1)
    turn = rotation(centroids.shape[1])
    shared = spark.sparkContext.broadcast((centroids, turn))

    def deal(batches):
        centroids, turn = shared.value
        for batch in batches:
            if len(batch):
                points = unit(np.stack(batch["v"].to_numpy()))
                cells = (points @ centroids.T).argmax(1)
                codes, length, inner = encode(points, centroids, cells, turn)
                yield pd.DataFrame({"cell": cells.astype("int32"), "first": batch["first"], "v": batch["v"], "code": [c.tobytes() for c in codes], "length": length, "inner": inner})

    coded = stored(different.mapInPandas(deal, "cell int, first bigint, v array<double>, code binary, length double, inner double"), "codes")

    def look(low: int, high: int, batches):
        """Each query with the cells at places ``low`` to ``high - 1`` in order of nearness."""
        centroids, _ = shared.value
        for batch in batches:
            if len(batch):
                near = unit(np.stack(batch["v"].to_numpy())) @ centroids.T
                best = np.argsort(-near, axis=1, kind="stable")[:, low:high]
                yield pd.DataFrame({"q": np.repeat(batch["q"].to_numpy(), best.shape[1]), "v": batch["v"].repeat(best.shape[1]), "cell": best.ravel().astype("int32")})

    queries = asked.select("g").distinct().join(different, "g").select(F.col("first").alias("q"), "v")
    def run(key, data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        centroids, turn = shared.value
        if not len(data) or not len(asked):
            return pd.DataFrame({"q": [], "first": [], "score": []})
        block = {
            "codes": np.frombuffer(b"".join(data["code"]), np.uint8).reshape(len(data), -1), "length": data["length"].to_numpy(),
            "inner": data["inner"].to_numpy(), "vectors": np.stack(data["v"].to_numpy()), "first": data["first"].to_numpy(),
        }
        found = search_block(block, np.stack(asked["v"].to_numpy()), centroids[key[0]], turn, k + 1)
        ids, names = asked["q"].to_numpy(), block["first"]
        return pd.DataFrame([(ids[q], names[v], s) for q, v, s in found], columns=["q", "first", "score"])

    groups = ["cell", "part", "load"]
    sizes = coded.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("parts"))

    def search(some: DataFrame, low: int, high: int) -> DataFrame:
        """(q, first, score) of the best vectors of those cells for each query."""
        sent = some.mapInPandas(lambda batches: look(low, high, batches), "q bigint, v array<double>, cell int")
        loads = sent.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("loads"))
        plan = stored(sizes.join(loads, "cell"), "plan")
        left = coded.join(plan, "cell").withColumn("part", F.pmod(F.xxhash64("first"), "parts").cast("int")).withColumn("load", F.explode(F.sequence(F.lit(0), F.col("loads") - 1)))
        right = sent.join(plan, "cell").withColumn("load", F.pmod(F.xxhash64("q"), "loads").cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        pairs = left.select(*groups, "first", "v", "code", "length", "inner").groupBy(*groups).cogroup(right.select(*groups, "q", "v").groupBy(*groups)).applyInPandas(run, "q bigint, first bigint, score double")
        return stored(pairs, "pairs")

    # A query whose cells hold too few rows looks into four times as many, until it has enough or has seen all.
    pairs, reach, held = search(queries, 0, probes), probes, different.join(ids, "g").select("first", F.size("ids").alias("n"))
    while reach < len(centroids):
        got = pairs.join(held, "first").groupBy("q").agg(F.sum("n").alias("n"))
        short = stored(queries.join(got, "q", "left").filter(F.coalesce("n", F.lit(0)) < k + 1).select("q", "v"), "short")
        if short.isEmpty():
            break
        pairs, reach = pairs.unionByName(search(short, reach, 4 * reach)), 4 * reach
    top = Window.partitionBy("q").orderBy(F.desc("score"), "first")
    best = pairs.withColumn("n", F.row_number().over(top)).filter(F.col("n") <= k + 1).select("q", "first", "score")
    # From different vectors back to rows, for every query with that vector.
    group = different.select("g", "first")
    found = best.join(group.withColumnRenamed("g", "found"), "first").join(ids.withColumnRenamed("g", "found"), "found").select("q", "score", F.explode("ids").alias("vec_id"))
    wide = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(wide)).filter(F.col("n") <= k + 1).drop("n")
    whose = asked.select(F.col("vec_id").alias("query_id"), "g").join(group.withColumnRenamed("first", "q"), "g").select("query_id", "q")
    out = whose.join(found, "q").filter("vec_id <> query_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
