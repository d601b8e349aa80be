"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed terms over all passages of all documents.
2. A randomised SVD of the TF-IDF matrix of all passages: with a fixed random matrix R, every task adds up its part of
   Y = A'AR and G = (AR)'(AR), both of a fixed size; the sums give right singular vectors and values (Nystrom).
3. Every window of every document, and every passage of the benchmark, is folded into that space. Pairs with a cosine
   of at least ``COSINE`` that share enough words go on to a word-by-word check: the longest common subsequence of the
   item and the words about the window, and for paraphrases also the item's answer, must be there.
4. Whole copies don't depend on that space: every item, however short, is also looked for as a run of words, and one in
   a script that may be written without spaces as a run of bytes.

The benchmark is worked on in blocks of bounded size, each broadcast to one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import byte_class, hash_words, text_slices

TERMS, RANK = 1 << 14, 64
HALF = 16  # windows of two halves, one half apart
PASSAGE_STEP = 8
COSINE = 0.4
SHARED = 0.5
# An item is in a document if this share of its words is there in order; from PARAPHRASE on if its answer is, too.
VERBATIM, PARAPHRASE = 0.8, 0.6
MIN_WORDS, ANSWER_WORDS = 8, 3
# Runs are looked up by so many first words or bytes. Lead bytes of UTF-8 from UNSPACED on: U+0800 and later.
KEY_WORDS, KEY_BYTES, UNSPACED = 8, 12, 0xE0
BLOCK_ITEMS, BLOCK_CHARS = 2048, 1_000_000
PART_TERMS = 256
SLICE = 1_000_000


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return hash_words(pc.utf8_lower(texts), byte_class(letters_only=True))


def _cuts(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``size`` words begin in each text (the last may be short), and how many a text has."""
    count = -(-np.diff(bounds) // size)
    first = np.repeat(bounds[:-1] - size * (np.cumsum(count) - count), count)
    return first + size * np.arange(count.sum()), count


def _folded(table: np.ndarray, terms: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the table's rows over runs of ``size`` words, where the runs begin, and how many a text has.

    The table ends with a row of zeros, which stands for the words that a short run lacks.
    """
    starts, count = _cuts(bounds, size)
    ends = np.minimum(starts + size, np.repeat(bounds[1:], count))
    padded = np.append(terms, np.full(size, TERMS)).astype(np.int32)
    total = np.zeros((len(starts), table.shape[1]), np.float32)
    for i in range(size):
        total += table[np.where(starts + i < ends, padded[starts + i], TERMS)]
    return total, starts, count


def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sums of the arrays of each part, added up as they stream by; as many parts come back as there are kinds of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data")):
                values = np.frombuffer(data.as_buffer(), np.float64)
                total[part] = total[part] + values if part in total else values.copy()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()])], names=["part", "data"])

    rows = parts.repartition("part").mapInArrow(run, parts.schema).collect()
    return {r["part"]: np.frombuffer(r["data"], np.float64) for r in rows}


def _parts(table: np.ndarray, rest: np.ndarray) -> pa.RecordBatch:
    """A table with a row per term, cut into parts, and one more array as part -1."""
    data = [table[i : i + PART_TERMS].astype(np.float64).tobytes() for i in range(0, TERMS, PART_TERMS)]
    return pa.RecordBatch.from_arrays([pa.array([*range(len(data)), -1], pa.int32()), pa.array([*data, rest.astype(np.float64).tobytes()])], names=["part", "data"])


def term_weights(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of each hashed term, over the passages of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, passages = np.zeros(TERMS), 0
        for batch in batches:
            for _, part in text_slices(batch.column("text"), SLICE):
                hashes, bounds = _words(part)
                starts, _ = _cuts(bounds, 2 * HALF)
                owner = np.zeros(len(hashes), np.int64)
                owner[starts] = 1
                keys = (np.cumsum(owner) << 14) | (hashes & np.uint64(TERMS - 1)).astype(np.int64)
                keys = np.sort(keys.astype(np.uint32) if len(starts) < 1 << 17 else keys)
                fresh = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
                found += np.bincount(keys[fresh] & (TERMS - 1), minlength=TERMS)
                passages += len(starts)
        yield _parts(found, np.array([passages]))

    sums = _summed(docs.select("text").mapInArrow(run, "part int, data binary"))
    if not sums:
        return np.ones(TERMS)
    found = np.concatenate([sums[i] for i in range(TERMS // PART_TERMS)])
    return np.log((sums[-1][0] + 1) / (found + 1)) + 1e-6


def latent_basis(docs: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Terms folded into the latent space: weight times right singular vector over singular value, a row per term and one of zeros."""
    random = np.random.default_rng(20).standard_normal((TERMS, RANK))
    shared = docs.sparkSession.sparkContext.broadcast((np.vstack((weights[:, None] * random, np.zeros(RANK))).astype(np.float32), weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projected, weights = shared.value
        total, inner = np.zeros((RANK, TERMS)), np.zeros((RANK, RANK))
        for batch in batches:
            for _, part in text_slices(batch.column("text"), SLICE):
                hashes, bounds = _words(part)
                if not len(hashes):
                    continue
                terms = (hashes & np.uint64(TERMS - 1)).astype(np.int64)
                rows, starts, _ = _folded(projected, terms, bounds, 2 * HALF)
                inner += rows.T @ rows
                owner = np.searchsorted(starts, np.arange(len(terms)), side="right") - 1
                for sums, column in zip(total, np.ascontiguousarray(rows.T)):
                    sums += np.bincount(terms, column[owner], TERMS)
        yield _parts(total.T * weights[:, None], inner.ravel())

    sums = _summed(docs.select("text").mapInArrow(run, "part int, data binary"))
    shared.unpersist()
    if not sums or not sums[-1].any():
        return np.zeros((TERMS + 1, RANK), np.float32)
    total = np.concatenate([sums[i].reshape(-1, RANK) for i in range(TERMS // PART_TERMS)])
    inner = sums[-1].reshape(RANK, RANK)
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    kept = values > values[-1] * 1e-9
    left, singular, _ = np.linalg.svd(total @ vectors[:, kept] / np.sqrt(values[kept]), full_matrices=False)
    basis = np.zeros((TERMS + 1, RANK), np.float32)
    basis[:-1, : len(singular)] = weights[:, None] * left / np.maximum(singular, singular[0] * 1e-9)
    return basis


def longest_common(item: dict[int, int], length: int, words: list[int]) -> int:
    """Length of the longest common subsequence of ``words`` and an item of ``length`` words, whose places of
    each word are bits of ``item[word]``: the bits of ``row`` that are clear mark where the length grows."""
    full = (1 << length) - 1
    row = full
    for w in words:
        at = item.get(w, 0)
        if at:
            hit = row & at
            row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


def _answer(text: str) -> str:
    """The last sentence of an item, or its last words if that is shorter."""
    sentences = [s for s in text.replace("?", ".").replace("!", ".").replace("\n", " ").split(".") if s.strip()]
    last = sentences[-1].split() if sentences else []
    return " ".join(last if len(last) >= ANSWER_WORDS else text.split()[-ANSWER_WORDS - 2 :])


def _prepared(items: list[tuple[int, str]]) -> dict:
    """Words, word places, answers and passages of a block of items; those of fewer than MIN_WORDS words are only in the runs."""
    hashes, bounds = _words(pa.array([t for _, t in items], pa.large_string()))
    answers, answer_bounds = _words(pa.array([_answer(t) for _, t in items], pa.large_string()))
    out = {"ids": [], "places": [], "lengths": [], "answers": [], "owner": [], "passages": [], "words": []}
    runs, bytewise = [], []
    for k, (item_id, text) in enumerate(items):
        words = hashes[bounds[k] : bounds[k + 1]]
        if len(words):
            runs.append((item_id, words))
            raw = np.frombuffer(_lowered(pa.array([text.strip()], pa.large_string()))[0], np.uint8)
            if raw.max() >= UNSPACED:
                bytewise.append((item_id, raw.astype(np.uint64)))
        if len(words) < MIN_WORDS:
            continue
        places: dict[int, int] = {}
        for i, w in enumerate(words.tolist()):
            places[w] = places.get(w, 0) | 1 << i
        starts = range(0, max(1, len(words) - 2 * HALF + PASSAGE_STEP), PASSAGE_STEP)
        for s in sorted({min(s, max(0, len(words) - 2 * HALF)) for s in starts}):
            passage = words[s : s + 2 * HALF]
            out["passages"].append(np.pad(passage, (0, 2 * HALF - len(passage)), constant_values=passage[0]))
            out["words"].append(len(set(passage.tolist())))
            out["owner"].append(len(out["ids"]))
        out["ids"].append(item_id)
        out["places"].append(places)
        out["lengths"].append(len(words))
        out["answers"].append(answers[answer_bounds[k] : answer_bounds[k + 1]].tolist())
    return out | {"runs": _run_index(runs, KEY_WORDS), "bytes": _run_index(bytewise, KEY_BYTES)}


def _lowered(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """All bytes of ``texts`` in lower case, end to end, and where each text begins, plus the end."""
    raw = [t.as_buffer().to_pybytes() for t in pc.utf8_lower(texts).cast(pa.large_binary())]
    return b"".join(raw), np.cumsum([0, *map(len, raw)])


def _run_keys(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` values from each place on."""
    n = max(0, len(values) - size + 1)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total = (total + values[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
    return total


def _run_index(runs: list[tuple[int, np.ndarray]], size: int) -> dict:
    """Per length of key: marks of the keys' upper bits, and the runs (id, values) of each key."""
    out: dict = {}
    for item_id, values in runs:
        n = min(size, len(values))
        key = _run_keys(values[:n], n)[0]
        marks, by_key = out.setdefault(n, (np.zeros(1 << 16, bool), {}))
        marks[int(key) >> 48] = True
        by_key.setdefault(int(key), []).append((item_id, values))
    return out


def _held_runs(index: dict, values: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
    """(text, item id) of the runs that stand whole in a text; ``bounds`` tells where texts begin in ``values``."""
    held = set()
    for size, (marks, by_key) in index.items():
        keys = _run_keys(values, size)
        at = np.flatnonzero(marks[(keys >> np.uint64(48)).astype(np.int64)])
        at = at[np.argsort(keys[at], kind="stable")]
        different, first = np.unique(keys[at], return_index=True)
        for key, places in zip(different.tolist(), np.split(at, first[1:])):
            for item_id, run in by_key.get(key, ()):
                owner = np.searchsorted(bounds, places, side="right") - 1
                here = places[places + len(run) <= bounds[owner + 1]]
                for j, value in enumerate(run):
                    here = here[values[here + j] == value]
                held.update((int(d), item_id) for d in np.unique(np.searchsorted(bounds, here, side="right") - 1))
    return held


def _holds(words: list[int], answer: list[int]) -> bool:
    return any(words[i : i + len(answer)] == answer for i in range(len(words) - len(answer) + 1))


def _search(docs: DataFrame, items: dict, basis: np.ndarray) -> DataFrame:
    """(doc_id, item_id, lcs, answer): items found in rows (doc_id, text)."""
    passages = np.array(items["passages"], np.uint64).reshape(-1, 2 * HALF)
    folded = np.zeros((len(passages), RANK), np.float32)
    for i, (p, n) in enumerate(zip(passages, (min(items["lengths"][o], 2 * HALF) for o in items["owner"]))):
        folded[i] = basis[(p[:n] & np.uint64(TERMS - 1)).astype(np.int64)].sum(0)
    folded /= np.maximum(np.linalg.norm(folded, axis=1, keepdims=True), 1e-12)
    shared = docs.sparkSession.sparkContext.broadcast((items, passages, folded, basis))

    def found(hashes: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], tuple[float, bool]]:
        items, passages, folded, basis = shared.value
        if not len(passages):
            return {}
        terms = (hashes & np.uint64(TERMS - 1)).astype(np.int64)
        halves, starts, count = _folded(basis, terms, bounds, HALF)
        owner = np.repeat(np.arange(len(count)), count)
        joined = np.concatenate((owner[1:] == owner[:-1], [False]))
        windows = halves.copy()
        windows[:-1][joined[:-1]] += halves[1:][joined[:-1]]
        # A text's last half is in the window before it, unless the text has no other.
        use = np.flatnonzero(joined | (np.repeat(count, count) == 1))
        windows = windows[use]
        windows /= np.maximum(np.linalg.norm(windows, axis=1, keepdims=True), 1e-12)
        cosines = windows @ folded.T
        rows = np.flatnonzero(cosines.max(1) >= COSINE)
        w, p = np.nonzero(cosines[rows] >= COSINE)
        w = rows[w]
        best: dict[tuple[int, int], tuple[float, bool]] = {}
        if not len(w):
            return best
        padded = np.concatenate((hashes, np.zeros(2 * HALF, np.uint64)))
        need = np.array(items["words"]) * SHARED
        done: set[tuple[int, int, int]] = set()
        for a in range(0, len(w), 20_000):
            cw, cp = use[w[a : a + 20_000]], p[a : a + 20_000]
            own = padded[starts[cw][:, None] + np.arange(2 * HALF)]
            wanted = np.sort(passages[cp], axis=1)
            fresh = np.concatenate((np.ones((len(cp), 1), bool), wanted[:, 1:] != wanted[:, :-1]), axis=1)
            shared_words = ((wanted[:, :, None] == own[:, None, :]).any(2) & fresh).sum(1)
            for i in np.flatnonzero(shared_words >= need[cp]).tolist():
                doc, item, at = int(owner[cw[i]]), items["owner"][cp[i]], int(starts[cw[i]])
                if (doc, item, at) in done:
                    continue
                done.add((doc, item, at))
                length = items["lengths"][item]
                region = hashes[max(bounds[doc], at - length) : min(bounds[doc + 1], at + 2 * HALF + length)].tolist()
                ratio = longest_common(items["places"][item], length, region) / length
                if ratio >= PARAPHRASE:
                    answer = _holds(region, items["answers"][item])
                    if ratio >= VERBATIM or answer:
                        best[doc, item] = max(best.get((doc, item), (0.0, False)), (ratio, answer))
        return best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value[0]["ids"]
        for batch in batches:
            for first, part in text_slices(batch.column("text"), SLICE):
                hashes, bounds = _words(part)
                pairs = {(d, ids[i]): v for (d, i), v in found(hashes, bounds).items()} if len(hashes) else {}
                held = _held_runs(shared.value[0]["runs"], hashes, bounds)
                if shared.value[0]["bytes"]:
                    raw, ends = _lowered(part)
                    held |= _held_runs(shared.value[0]["bytes"], np.frombuffer(raw, np.uint8).astype(np.uint64), ends)
                pairs.update(dict.fromkeys(held, (1.0, True)))
                if pairs:
                    docs = batch.column("doc_id").take(pa.array([first + d for d, _ in pairs]))
                    columns = [pa.array([i for _, i in pairs], pa.int64()), pa.array([v[0] for v in pairs.values()]), pa.array([v[1] for v in pairs.values()])]
                    yield pa.RecordBatch.from_arrays([docs, *columns], names=["doc_id", "item_id", "lcs", "answer"])

    return docs.mapInArrow(run, "doc_id bigint, item_id bigint, lcs double, answer boolean")


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, lcs, answer): one row for each document id and benchmark item found in it.

    Words are lower-cased runs of letters and digits. Texts that are null or have no word hold nothing; items without a
    text or a word are found nowhere, those of fewer than ``MIN_WORDS`` words only as whole copies; rows that share a doc_id count as one document, and
    items that share an id as one item, with the best match counting. Empty tables give an empty result.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter("text is not null")
    tests = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text is not null").distinct()
    count, chars = tests.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    none = rows.select("doc_id", F.lit(0).cast("bigint").alias("item_id"), F.lit(0.0).alias("lcs"), F.lit(False).alias("answer")).limit(0)
    if not count:
        return none
    blocks = max(-(-count // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    basis = latent_basis(rows, term_weights(rows))
    out = none
    for block in range(blocks):
        own = tests.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        items = _prepared([(r["item_id"], r["text"]) for r in own])
        if items["runs"]:
            out = out.unionByName(_search(rows, items, basis))
    return out.groupBy("doc_id", "item_id").agg(F.max("lcs").alias("lcs"), F.max("answer").alias("answer"))


def without_items(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows with a null doc_id are kept only if none of them does."""
    found = contaminated(docs, benchmark, doc_id, text).select(F.col("doc_id").alias("__found")).distinct()
    return docs.join(found, F.col(f"`{doc_id}`").cast("bigint").eqNullSafe(F.col("__found")), "left_anti")
