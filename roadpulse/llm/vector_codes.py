"""Compressed vectors: each part of a vector becomes the index of its nearest codebook entry, found without floating point.

Components are integers floor(256 x). Parts and entries are padded with zeros to a power of two and put through the
integer Walsh-Hadamard transform, which multiplies squared distances by its size. Squared differences of coefficients
are added up in order of sequency, where the first ones tell most; an entry whose sum so far is above the full
distance of a part's first guess is out, so most entries are seen for a few coefficients only. All sums are integers,
hence the nearest entry is exact and ties go to the lower index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import stored
from roadpulse.session import broadcast_if_small

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
# Rows of a batch whose distances are looked at together.
ROWS = 2048
# Integers up to this are held as 64-bit numbers, larger ones as Python's own; so are those whose distances could pass the second bound.
PLAIN, SAFE = 2**40, 2**55
# Sums are shipped in limbs of this many bits.
LIMB = 31
SMALL_ROWS = 100_000
# Copies of a label's sum when there are too many labels to broadcast; a common label's rows are spread over them.
SALTS = 32


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of finite components: 64-bit integers, or Python's where these wouldn't do."""
    scaled = np.floor(vectors * SCALE)
    if not len(scaled) or np.abs(scaled).max() <= PLAIN:
        return scaled.astype(np.int64)
    # Beyond the range of doubles 256 x is taken as an integer.
    return np.array([[int(s) if np.isfinite(s) else int(x) * SCALE for s, x in zip(*row)] for row in zip(scaled, vectors)], object).reshape(vectors.shape)


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the last axis (zero-padded to a power of two), coefficients by sequency."""
    width = 1 << max(0, rows.shape[-1] - 1).bit_length()
    out = np.zeros((*rows.shape[:-1], width), rows.dtype)
    out[..., : rows.shape[-1]] = rows
    step = 1
    while step < width:
        pairs = out.reshape(*out.shape[:-1], width // (2 * step), 2, step)
        out = np.stack((pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]), axis=-2).reshape(out.shape)
        step *= 2
    return out[..., sequency(width)]


def sequency(width: int) -> np.ndarray:
    """Rows of the natural transform matrix by their number of sign changes."""
    i, j = np.arange(width)[:, None], np.arange(width)[None, :]
    signs = np.bitwise_count((i & j).astype(np.uint64)) & 1
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of, and squared distance to, the nearest of ``entries`` (m x d integers) for each of ``parts`` (n x d)."""
    width = 1 << max(0, parts.shape[1] - 1).bit_length()
    top = max((int(abs(v).max()) for v in (parts, entries) if v.size), default=0)
    kind = np.int64 if 4 * top**2 * width**3 < SAFE else object
    a, b = hadamard(parts.astype(kind)), hadamard(entries.astype(kind))
    index = np.zeros(len(a), np.int64)
    error = np.zeros(len(a), kind)
    for start in range(0, len(a), ROWS):
        part = a[start : start + ROWS]
        n = np.arange(len(part))
        sums = (part[:, None, 0] - b[None, :, 0]) ** 2
        # The nearest by the first coefficient is the guess whose full distance the others have to beat.
        bound = ((part - b[sums.argmin(axis=1)]) ** 2).sum(axis=1)
        row, entry = np.nonzero(sums <= bound[:, None])
        sums = sums[row, entry]
        for k in range(1, width):
            sums = sums + (part[row, k] - b[entry, k]) ** 2
            left = sums <= bound[row]
            row, entry, sums = row[left], entry[left], sums[left]
        # Left are entries no farther than the guess, by row and index: the first of the least sums wins.
        least = np.minimum.reduceat(sums, np.searchsorted(row, n))
        hit = np.flatnonzero(sums == least[row])
        index[start : start + ROWS] = entry[hit[np.searchsorted(row[hit], n)]]
        error[start : start + ROWS] = least // width
    return index, error


@dataclass(frozen=True)
class Codebooks:
    """Entries of each part: ``entries[p][i]`` is a list of integers. ``size`` is the number of components of a vector."""

    entries: list[list[list[int]]]
    size: int

    def arrays(self) -> list[np.ndarray]:
        top = max((abs(v) for part in self.entries for entry in part for v in entry), default=0)
        return [np.array(part, np.int64 if top <= PLAIN else object) for part in self.entries]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position."""
        return hashlib.sha256(",".join(str(v) for part in self.entries for entry in part for v in entry).encode()).hexdigest()

    def decode(self, code: str) -> list[float]:
        """Vector that a code stands for: the middle of each integer's components."""
        places = [int(code[i : i + 2], 16) for i in range(0, len(code), 2)]
        values = [v for part, place in zip(self.entries, places) for v in part[place]]
        return [(v + 0.5) / SCALE for v in values[: self.size]]


def kept(rows: DataFrame, vector: str) -> Column:
    """Whether a row's vector is there and all its components are finite."""
    v = F.col(f"`{vector}`").cast("array<double>")
    return v.isNotNull() & ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))


def _matrix(column: pa.Array, size: int, parts: int) -> np.ndarray:
    """Integers of the vectors of ``column``, rows x parts x components of a part."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    own = whole(flat.reshape(len(column), size))
    width = -(-size // parts)
    padded = np.zeros((len(own), parts * width), own.dtype)
    padded[:, :size] = own
    return padded.reshape(len(own), parts, width)


def _starting(rows: DataFrame, size: int, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest ids; of an id's several vectors the least one, null ids last."""
    ids = rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()
    wanted = [r["vec_id"] for r in ids]
    first = rows.filter(F.col("vec_id").isin([i for i in wanted if i is not None]) | (F.lit(None in wanted) & F.col("vec_id").isNull()))
    found = first.groupBy("vec_id").agg(F.min("vector").alias("vector")).collect()
    found = sorted(found, key=lambda r: (r["vec_id"] is None, r["vec_id"]))
    vectors = _matrix(pa.array([r["vector"] for r in found], pa.list_(pa.float64())), size, parts)
    return Codebooks([[[int(v) for v in one[p]] for one in vectors] for p in range(parts)], size)


def _moved(rows: DataFrame, books: Codebooks, limbs: int) -> Codebooks:
    """Each entry replaced by the floor of the mean of its parts; an entry without any stays.

    Tasks add up their own parts; Spark adds up one row per part, entry and limb of the tasks.
    """
    size, parts = books.size, len(books.entries)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = books.arrays()
        totals: dict[tuple[int, int], tuple[list[int], int]] = {}
        for batch in batches:
            cut = _matrix(batch.column("vector"), size, parts)
            for p in range(parts):
                place, _ = nearest(cut[:, p], tables[p])
                order = np.argsort(place, kind="stable")
                used, starts, counts = np.unique(place[order], return_index=True, return_counts=True)
                sums = np.add.reduceat(cut[order, p], starts, axis=0) if len(order) else []
                for entry, one, n in zip(used.tolist(), sums, counts.tolist()):
                    old, seen = totals.get((p, entry), ([0] * cut.shape[2], 0))
                    totals[p, entry] = ([a + int(b) for a, b in zip(old, one)], seen + n)
        mask = 2**LIMB - 1
        rows = [(p, e, k, [(v >> LIMB * k) & mask if k < limbs - 1 else v >> LIMB * k for v in sums], n)
                for (p, e), (sums, n) in totals.items() for k in range(limbs)]
        if rows:
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=["part", "entry", "limb", "sums", "n"])

    added = rows.select("vector").mapInArrow(add, "part int, entry int, limb int, sums array<bigint>, n bigint")
    cells = added.select("part", "entry", "limb", "n", F.posexplode("sums").alias("i", "v"))
    cells = cells.groupBy("part", "entry", "i", "limb").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    new = [[list(e) for e in part] for part in books.entries]
    sums: dict[tuple[int, int, int], tuple[int, int]] = {}
    for r in cells.collect():  # parts x entries x components x limbs
        key = (r["part"], r["entry"], r["i"])
        sums[key] = (sums.get(key, (0, 0))[0] + (r["v"] << LIMB * r["limb"]), r["n"])
    for (p, e, i), (total, n) in sums.items():
        new[p][e][i] = total // n
    return Codebooks(new, size)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``rows`` (vec_id, vector), whose vectors all have the same size; None when there are none."""
    top = rows.agg(F.max(F.size("vector")).alias("size"), F.max(F.array_max(F.transform("vector", F.abs))).alias("top"), F.count(F.lit(1)).alias("n")).first()
    if not top["n"]:
        return None
    # Bits of the largest sum there may be, cut into limbs whose own sums stay below 63 bits.
    bits = int(top["top"] or 0).bit_length() + 9 + top["n"].bit_length()
    limbs = 1 if bits <= 62 else -(-bits // LIMB) + 1
    books = _starting(rows, top["size"], parts, entries)
    for _ in range(rounds):
        books = _moved(rows, books, limbs)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` (any columns, ``vector`` among them) with ``code`` and ``error`` in place of ``vector``."""
    size, parts = books.size, len(books.entries)
    names = [c for c in rows.columns if c != "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = books.arrays()
        for batch in batches:
            cut = _matrix(batch.column("vector"), size, parts)
            code = np.zeros((len(cut), parts), np.uint8)
            error = 0
            for p in range(parts):
                place, distance = nearest(cut[:, p], tables[p])
                code[:, p], error = place, error + distance
            raw = code.tobytes().hex()
            codes = [raw[i : i + 2 * parts] for i in range(0, len(raw), 2 * parts)]
            errors = [min(int(e), 2**63 - 1) for e in error]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=[*names, "code", "error"])

    kinds = dict(rows.dtypes)
    return rows.select(*names, "vector").mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in names] + ["code string", "error bigint"]))


def _label_sums(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the errors of all rows of equal label, null ones together."""
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    sums = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(28,0)")).cast("decimal(38,0)"), most).cast("bigint").alias("label_error"))
    sums = stored(sums.withColumnRenamed("label", "sum_label"), "label-errors")
    small = broadcast_if_small(sums, SMALL_ROWS)
    if small is not sums:
        return coded.join(small, F.col("label").eqNullSafe(F.col("sum_label"))).drop("sum_label")
    sums = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = coded.withColumn("own_salt", F.pmod(F.xxhash64("code", "vec_id"), F.lit(SALTS)).cast("int"))
    return salted.join(sums, F.col("label").eqNullSafe(F.col("sum_label")) & (F.col("own_salt") == F.col("salt"))).drop("sum_label", "salt", "own_salt")


def compress(
    docs: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks | None]:
    """((vec_id, label, code, error, label_error), codebooks) of the rows whose vector is whole and finite.

    ``code`` has two hex digits per part; ``error`` is the squared distance to what the code stands for, in 1/256,
    and ``label_error`` its sum over the rows of equal label. Rows with a null vector or one that holds null, NaN or an
    infinite component go, and so do vectors of another size than most have (the larger size on a tie). A size that the parts
    don't divide is filled up with zeros. Repeated rows and null ids are coded like others; a codebook starts from the
    smallest ids, null last, and of several vectors of one id from the least. Fewer ids make shorter codebooks. Errors
    that no 64-bit number holds are given as the largest. Other columns are left out; an empty table gives an empty one.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits stands for at most 256 entries")
    labels = F.col(f"`{label}`") if label.lower() in {c.lower() for c in docs.columns} else F.lit(None).cast("int")
    whole_rows = docs.filter(kept(docs, vector)).select(
        F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), labels.alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    sizes = whole_rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = whole_rows.filter(F.size("vector") == (sizes["size"] if sizes else 0))
    books = fit(rows.select("vec_id", "vector"), parts, entries, rounds) if sizes and sizes["size"] else None
    if books is None:
        kinds = f"vec_id bigint, label {dict(rows.dtypes)['label']}, code string, error bigint, label_error bigint"
        return docs.sparkSession.createDataFrame([], kinds), None
    return _label_sums(stored(encode(rows, books), "codes")), books
