"""N-gram Jaccard join: links between texts whose sets of word shingles are similar.

1. Every text gets a MinHash signature; bands of it name buckets. Only band keys and text ids are shuffled.
2. Texts that share a bucket are candidates. Their signatures are compared some hashes at a time, and a pair is
   dropped as soon as the posterior probability of reaching the threshold (uniform prior) falls below ``TOLERANCE``.
3. The kept pairs join texts into loose groups. Within a group all pairs are verified exactly on their shingle sets;
   counts of links and the verified components come out, never the pairs.

Equal texts are one text throughout. Buckets and groups of any size are split into blocks, and every pair of blocks
is one unit of work, so no task holds more than two blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.bloom import possible
from roadpulse.llm.common import byte_class, hash_words, mix, shingles, stored, text_slices
from roadpulse.llm.components import connected_components

WORDS = 5
# Similarity from which texts are linked, as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
# A pair at the threshold shares a bucket but for (1 - 0.8**ROWS)**BANDS = 3e-6 of cases.
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
TOLERANCE = 1e-6
STEP = 32
REMEMBERED_TEXTS = 200_000
BLOCK_TEXTS = 256
BLOCK_SHINGLES = 500_000


def posterior(matches: int, hashes: int, threshold: float = NUMERATOR / DENOMINATOR) -> float:
    """Probability that the similarity reaches ``threshold``, after ``matches`` of ``hashes`` values agreed.

    With a uniform prior the posterior is Beta(matches + 1, hashes - matches + 1); its upper tail is a binomial sum.
    """
    n = hashes + 1
    terms = (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(threshold) + (n - k) * math.log(1 - threshold) for k in range(matches + 1))
    return sum(map(math.exp, terms))


def fewest_matches(hashes: int) -> int:
    """Fewest agreeing values of ``hashes`` with which a pair stays a candidate."""
    return next(m for m in range(hashes + 1) if posterior(m, hashes) >= TOLERANCE)


def _hash_functions() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds[:HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[HASHES:] >> np.uint64(32)).astype(np.uint32)


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values, a row per text with at least one shingle."""
    factors, shifts = _hash_functions()
    filled = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(filled), HASHES), np.uint32)
    if len(filled):
        low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
        for i in range(HASHES):
            value = (low ^ shifts[i]) * factors[i]
            value = (value ^ (value >> np.uint32(15)) ^ high) * np.uint32(0x2C1B3C6D)
            out[:, i] = np.minimum.reduceat(value ^ (value >> np.uint32(13)), bounds[filled])
    return out


def sketched(docs: DataFrame) -> DataFrame:
    """(text_id, sizes, band keys, low bytes of the signature) of rows (text_id, text); bands are null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = byte_class(letters_only=False)
        for batch in batches:
            sizes, bands, bytes_ = [], [], []
            for _, part in text_slices(batch.column("text")):
                hashes, bounds = shingles(*hash_words(pc.utf8_lower(part), word), WORDS)
                found = signatures(hashes, bounds)
                keys = np.zeros((len(found), BANDS), np.uint64)
                for i in range(ROWS):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + found[:, i::ROWS] + np.arange(1, BANDS + 1, dtype=np.uint64))
                at = 0
                for n in np.diff(bounds).tolist():
                    sizes.append(n)
                    bands.append(keys[at].view(np.int64) if n else None)
                    bytes_.append(found[at].astype(np.uint8).tobytes() if n else None)
                    at += n > 0
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_id"), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(bytes_, pa.binary())],
                    names=["doc_id", "text_id", "n_shingles", "bands", "signature"],
                )

    return docs.mapInArrow(run, "doc_id bigint, text_id binary, n_shingles bigint, bands array<bigint>, signature binary")


def in_blocks(members: DataFrame, group: str, blocks: str) -> DataFrame:
    """Each member once for every pair of blocks that its own block is in; ``side`` tells the first block from the second."""
    own = F.pmod(F.xxhash64("text_id"), F.col(blocks)).cast("int")
    others = F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)
    spread = members.withColumn("own", own).withColumn("other", F.explode(others)).drop(blocks)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return spread.select(group, low.alias("low"), high.alias("high"), (F.col("own") == high).alias("side"), *[c for c in members.columns if c not in (group, blocks)])


def _groups(batches: Iterator[pa.RecordBatch], payload: str, limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Whole groups of sorted rows, many at a time: (rows, where groups begin, plus the end)."""
    held: list[pa.RecordBatch] = []

    def cut(rows: pa.RecordBatch) -> np.ndarray:
        keys = [np.asarray(rows.column(c)) for c in (0, 1, 2)]
        new = np.zeros(max(0, rows.num_rows - 1), bool)
        for k in keys:
            new |= k[1:] != k[:-1]
        return np.concatenate(([0], np.flatnonzero(new) + 1, [rows.num_rows])).astype(np.int64)

    for batch in batches:
        held.append(batch)
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()
        if not rows:
            held = []
            continue
        rows = rows[0]
        bounds = cut(rows)
        if len(bounds) > 2:  # the last group may go on
            yield rows.slice(0, bounds[-2]), bounds[:-1]
            held = [rows.slice(bounds[-2])]
        else:
            held = [rows]
    if held and held[0].num_rows:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        yield rows, cut(rows)


def _pairs(bounds: np.ndarray, same: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs within groups: all of them where the blocks are the same, else those across the two sides."""
    first, second = [], []
    sizes = np.diff(bounds)
    two = np.flatnonzero(sizes == 2)
    two = two[same[bounds[two]] | (side[bounds[two]] != side[bounds[two] + 1])]
    first.append(bounds[two])
    second.append(bounds[two] + 1)
    for g in np.flatnonzero(sizes > 2).tolist():
        a, n = bounds[g], sizes[g]
        if same[a]:
            i, j = np.triu_indices(n, 1)
        else:
            left, right = np.flatnonzero(~side[a : a + n]), np.flatnonzero(side[a : a + n])
            i, j = np.repeat(left, len(right)), np.tile(right, len(left))
        first.append(a + i)
        second.append(a + j)
    return np.concatenate(first).astype(np.int64), np.concatenate(second).astype(np.int64)


def _forest(rows: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row that each row is joined with by the pairs."""
    root = np.arange(rows)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def likely_edges(candidates: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the candidates which pass the Bayesian pruning; at most one per row of a block pair."""
    needed = [(n, fewest_matches(n)) for n in range(STEP, HASHES + 1, STEP)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in _groups(batches, "signature", 0):
            same = np.asarray(rows.column("low")) == np.asarray(rows.column("high"))
            side = np.asarray(rows.column("side").to_numpy(zero_copy_only=False), bool)
            flat = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(-1, HASHES)
            # A slice of groups at a time, by how many pairs they have.
            sizes = np.diff(bounds)
            part = np.cumsum(sizes * sizes) // 400_000
            for p in np.unique(part).tolist():
                own = np.flatnonzero(part == p)
                at = bounds[own[0] : own[-1] + 2]
                a, b = _pairs(at, same, side)
                matches = np.zeros(len(a), np.int32)
                for n, least in needed:
                    matches += (flat[a, n - STEP : n] == flat[b, n - STEP : n]).sum(1, dtype=np.int32)
                    kept = matches >= least
                    a, b, matches = a[kept], b[kept], matches[kept]
                root = _forest(at[-1], a, b)
                rest = at[0] + np.flatnonzero(root[at[0] :] != np.arange(at[0], at[-1]))
                if len(rest):
                    ids = rows.column("text_id")
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(rest)), ids.take(pa.array(root[rest]))], names=["a", "b"])

    return candidates.mapInArrow(run, "a binary, b binary")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(text_id, set): the different shingle hashes of rows (text_id, text), sorted, eight bytes each.

    A task makes the set of a text once, however many copies it meets, as long as it remembers the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, met = byte_class(letters_only=False), set()
        for batch in batches:
            fresh = []
            for i, text_id in enumerate(batch.column("text_id").to_pylist()):
                if text_id not in met:
                    fresh.append(i)
                    met.add(text_id)
            if len(met) > REMEMBERED_TEXTS:
                met = set()
            if not fresh:
                continue
            ids, texts = (batch.column(c).take(pa.array(fresh, pa.int64())) for c in ("text_id", "text"))
            for first, part in text_slices(texts):
                hashes, bounds = shingles(*hash_words(pc.utf8_lower(part), word), WORDS)
                sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(sets)), pa.array(sets, pa.binary())], names=["text_id", "set"])

    return texts.mapInArrow(run, "text_id binary, set binary")


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Shingles that each two sets share, from products of bounded slices of the incidence matrix."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[0, both], [both, 0]])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    keep = count[column] > 1
    row, column = row[keep], (np.cumsum(count > 1) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((n, n), np.float64)
    width = max(256, 4_000_000 // n)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        slab = np.zeros((n, width), np.float32)
        slab[row[a:b], column[a:b] - start] = 1
        out += slab @ slab.T
    return np.rint(out).astype(np.int64)


def verified_links(members: DataFrame) -> DataFrame:
    """(text_id, links to texts, links to rows, a text of the same verified component within the block pair)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in _groups(batches, "set", 0):
            same = np.asarray(rows.column("low")) == np.asarray(rows.column("high"))
            side = np.asarray(rows.column("side").to_numpy(zero_copy_only=False), bool)
            copies = np.asarray(rows.column("n_rows"))
            packed = rows.column("set")
            texts, linked, root = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64), np.arange(rows.num_rows)
            for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                if b - a < 2:
                    continue
                sets = [np.frombuffer(packed[i].as_py(), np.uint64) for i in range(a, b)]
                size = np.array([len(s) for s in sets])
                # common / union >= 4 / 5, in whole numbers
                link = (NUMERATOR + DENOMINATOR) * _common(sets) >= NUMERATOR * (size[:, None] + size[None, :])
                np.fill_diagonal(link, False)
                if not same[a]:
                    link &= side[a:b][:, None] != side[a:b][None, :]
                texts[a:b] = link.sum(1)
                linked[a:b] = link @ copies[a:b]
                root[a:b] = a + _forest(b - a, *np.nonzero(np.triu(link)))
            ids = rows.column("text_id")
            yield pa.RecordBatch.from_arrays([ids, pa.array(texts), pa.array(linked), ids.take(pa.array(root))], names=["text_id", "texts", "linked", "with"])

    return members.mapInArrow(run, "text_id binary, texts bigint, linked bigint, `with` binary")


def _dealt(df: DataFrame, group: str) -> DataFrame:
    """Rows of a block pair together, smallest text first, so that the blocks of a group tend to name the same root."""
    return df.repartition(group, "low", "high").sortWithinPartitions(group, "low", "high", "text_id")


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links, n_text_links, first_copy), a row per row of ``docs``.

    Texts are lower-cased and cut at ASCII white space; a text of fewer than five words is one shingle, and one
    without words is linked with its copies alone. Two rows are linked if their texts are equal or the Jaccard
    similarity of their shingle sets is at least 0.8. ``class_id`` is the smallest doc_id in a row's component,
    ``n_links`` counts linked rows, ``n_text_links`` the different other texts among them, ``first_copy`` is the
    smallest doc_id with an equal text. A null text has no links and is its own class; repeated rows count as copies;
    rows with a null doc_id are compared like all others. An empty table gives an empty table.
    """
    return _linked(docs, doc_id, text).select("doc_id", "class_id", "n_links", "n_text_links", "first_copy")


def _linked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The columns of ``jaccard_join``, ``text_id``, and ``leads``: whether no other text of the class has a smaller text_id."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    keyed = rows.select("doc_id", F.unhex(F.md5(F.col("text"))).alias("text_id"), "text")
    sketches = stored(sketched(keyed.filter("text is not null")), "sketches")
    light = sketches.select("doc_id", "text_id", "n_shingles")
    texts = light.groupBy("text_id").agg(F.min("doc_id").alias("first_copy"), F.count(F.lit(1)).alias("n_rows"), F.max("n_shingles").alias("n_shingles"))
    texts = stored(texts, "texts")

    buckets = sketches.filter("bands is not null").select("text_id", F.explode("bands").alias("bucket")).distinct()
    crowded = buckets.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    shared = stored(buckets.join(crowded, "bucket"), "buckets")
    wanted = sketches.select("text_id", "signature").join(shared.select("text_id").distinct(), "text_id", "left_semi")
    sketch_of = wanted.groupBy("text_id").agg(F.max("signature").alias("signature"))
    candidates = in_blocks(shared, "bucket", "blocks").join(sketch_of, "text_id")
    order = ["bucket", "low", "high", "side", "text_id", "signature"]
    edges = likely_edges(_dealt(candidates.select(*order), "bucket")).distinct()

    loose = connected_components(edges)
    members = loose.withColumnRenamed("node", "text_id").join(texts, "text_id")
    per_block = [F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)]
    groups = members.groupBy("root").agg(F.greatest(*per_block, F.lit(1)).cast("int").alias("blocks"))
    members = stored(members.join(groups, "root").select("root", "text_id", "n_rows", "blocks"), "members")
    # Sets are made where the texts are read, of those that the filter lets through, so that no text is ever shuffled.
    wanted = members.select("text_id")
    found = possible(keyed.filter("text is not null"), "text_id", wanted, wanted.count())
    sets = shingle_sets(found.select("text_id", "text")).groupBy("text_id").agg(F.max("set").alias("set"))
    spread = in_blocks(members.select("root", "text_id", "n_rows", "blocks"), "root", "blocks")
    order = ["root", "low", "high", "side", "text_id", "n_rows", "set"]
    units = F.xxhash64("root").alias("root")
    links = stored(verified_links(_dealt(spread.join(sets, "text_id").select(units, *order[1:]), "root")), "links")

    counts = links.groupBy("text_id").agg(F.sum("texts").alias("texts"), F.sum("linked").alias("linked"))
    tied = connected_components(links.select(F.col("text_id").alias("a"), F.col("with").alias("b")))
    of_class = tied.withColumnRenamed("node", "text_id").join(texts.select("text_id", "first_copy"), "text_id")
    least = of_class.groupBy("root").agg(F.min("first_copy").alias("class_id"), F.min("text_id").alias("least"))
    classes = of_class.select("text_id", "root").join(least, "root").select("text_id", "class_id", (F.col("text_id") == F.col("least")).alias("leads"))
    facts = texts.join(counts, "text_id", "left").join(classes, "text_id", "left").select(
        "text_id", F.coalesce("class_id", "first_copy").alias("class_id"),
        (F.col("n_rows") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_text_links"), "first_copy",
        F.coalesce("leads", F.lit(True)).alias("leads"),
    )
    linked = light.select("doc_id", "text_id").join(facts, "text_id")
    alone = rows.filter("text is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), F.lit(0).cast("bigint").alias("n_text_links"), F.col("doc_id").alias("first_copy"),
        F.lit(None).cast("binary").alias("text_id"), F.lit(True).alias("leads"),
    )
    return linked.unionByName(alone)


def one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with only one document of each class of ``jaccard_join``: the one with the smallest doc_id.

    Of rows that share that doc_id, one is kept for each different text. A class without any doc_id keeps one text.
    """
    links = _linked(docs, doc_id, text).filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("doc_id").isNotNull() | F.col("leads")))
    # Rows without an id are told apart by their texts.
    kept = links.groupBy(F.col("doc_id").alias("__kept"), F.when(F.col("doc_id").isNull(), F.col("text_id")).alias("__text")).agg(F.count(F.lit(1)).alias("__rows"))
    own = F.col(f"`{doc_id}`").cast("bigint")
    own_text = F.when(own.isNull(), F.unhex(F.md5(F.col(f"`{text}`"))))
    found = docs.join(kept, own.eqNullSafe(F.col("__kept")) & own_text.eqNullSafe(F.col("__text")))
    single, several = found.filter("__rows = 1"), found.filter("__rows > 1").dropDuplicates([doc_id, text])
    return single.unionByName(several).select(*[F.col(f"`{c}`") for c in docs.columns])
