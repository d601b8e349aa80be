"""Helpers shared by the operators: tables, bounded slices of a batch, and words hashed in bulk."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import scratch_path

# Texts of at most this many bytes are worked on together (a longer text is worked on alone).
SLICE_BYTES = 2_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWER = 0x100000001B3


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: a columnar cut of the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Path of a public tokenizer file, in ``folder`` or where the tokenizer package keeps it."""
    if folder is not None:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of consecutive slices of about ``limit`` bytes; nulls become empty texts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // limit if len(sizes) else sizes
    bounds = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            yield a, texts.slice(a, b - a)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values; a one-to-one map."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def byte_class(letters_only: bool) -> np.ndarray:
    """Which bytes belong to a word: all but ASCII white space, or only ASCII alphanumerics and bytes from 128."""
    word = np.ones(256, bool)
    if letters_only:
        word[:128] = [chr(c).isalnum() for c in range(128)]
    else:
        word[[9, 10, 11, 12, 13, 32]] = False
    return word


def hash_words(texts: pa.Array, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` (lower-cased, no nulls) and where each text's words begin, plus the end.

    A word's hash is a polynomial in its bytes modulo 2**64, taken from running sums over the whole slice.
    """
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = word[raw]
    before = np.concatenate(([False], inside[:-1]))
    cut = offsets[:-1][offsets[:-1] < len(raw)]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate((inside[1:], [False]))
    after[cut[cut > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    powers, back = _powers(_POWER, len(raw) + 1), _powers(pow(_POWER, -1, 2**64), len(raw) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw + np.uint64(1)) * powers[:-1], dtype=np.uint64)))
    hashes = mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _ODD)
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and where each text's runs begin, plus the end.

    A text with fewer words, but at least one, has a single run of all its words.
    """
    counts = np.diff(bounds)
    out = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    ends = np.concatenate(([0], np.cumsum(out)))
    place = np.repeat(bounds[:-1] - ends[:-1], out) + np.arange(ends[-1])
    padded = np.concatenate((hashes, np.zeros(size, np.uint64)))
    width = np.repeat(np.minimum(counts, size), out)
    total = np.zeros(len(place), np.uint64)
    for i in range(size):
        total = mix(total * _ODD + np.where(i < width, padded[np.minimum(place + i, len(padded) - 1)], np.uint64(i + 1)))
    return total, ends


def replaced(df: DataFrame, **columns) -> DataFrame:
    """``df`` with ``columns`` set, in place of any of the same name in whatever case."""
    taken = {c.lower() for c in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken], *[v.alias(k) for k, v in columns.items()])
