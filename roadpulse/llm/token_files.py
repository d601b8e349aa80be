"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits, the lowest first. Level 0 of a file holds the lowest chunk of every id; level
L holds chunk L of just those ids that have one. A level's continuation bitmap says which of its ids go on to the next
level, and its rank directory holds the number of set bits before every block of 512. The place of an id in the next
level is its rank, so any token is found by one look into each of its levels, and no block is ever decoded.

Writing: documents are dealt to ranges of ascending doc_id by splitters from a quantile sketch, each range is sorted
and cut into files of whole documents, and Spark's text sink writes one file per row. A range of equal doc_ids is
split further. Reading: Spark's binary source deals out the files.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadpulse.llm.common import stored, text_slices, tokenizer_path
from roadpulse.session import broadcast_if_small

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
MAGIC = b"PACKIDS1"
# File header after the magic: range, file within the range, documents, tokens, levels.
HEADER = "<8sqqqqq"
HEADER_BYTES = struct.calcsize(HEADER)
BLOCK = 512
# A file ends after the document that fills it.
FILE_TOKENS = 2_000_000
# Documents in a range, and the most ranges there may be.
RANGE_ROWS = 20_000
MAX_RANGES = 20_000
# Error of the quantile sketch as a share of a range: ranges differ by a few hundredths.
SKETCH = 20
TABLE_CHUNKS = 1_000_000
LONG_CHUNK = 64
SMALL_ROWS = 100_000
_BREAK = "\x00"
POINTS = ".,;:!?()[]{}\"*-_/|$%&#@+=<>~^"
# Words whose pre-tokens are known without the library: letters that no normalisation changes but for capitals, then points.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_OTHER_BYTES = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
# Characters of a byte-level vocabulary: printable Latin-1 for itself, the other bytes in order from 256.
_BYTE_LETTERS = [chr(256 + _OTHER_BYTES.index(b)) if b in _OTHER_BYTES else chr(b) for b in range(256)]


class WordIds:
    """Ids of texts, put together from a table of the distinct words between blanks that were met.

    Pre-tokens of this vocabulary hold no white space and nothing around a blank changes them, so a text's ids are those
    of its words in order. A new word of plain letters with punctuation behind is two pre-tokens: the letters go straight
    to the library's merges, once for all spellings in capitals. Other words are encoded by the library, many in one text,
    with a character between them that is a token by itself. A full table keeps only the words at hand, so its memory is bounded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.model.get_vocab_size() <= 2**16 else "<u4")
        self.table: dict[str, bytes] = {"": b""}
        self.letters: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        self.merge = self.model.model.tokenize
        (self.split,) = self.ids(_BREAK)

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text, add_special_tokens=False).ids

    def plain(self, word: str) -> bytes | None:
        """Ids of a word of plain letters and punctuation behind, else None."""
        head = word.rstrip(POINTS)
        if LETTERS.fullmatch(head) is None:
            return None
        lower, tail = head.lower(), word[len(head) :]
        found, end = self.letters.get(lower), self.tails.get(tail)
        if found is None:
            # Each byte of a letter has its own character in the vocabulary; those of ASCII stand for themselves.
            spelled = lower if lower.isascii() else "".join(map(_BYTE_LETTERS.__getitem__, lower.encode()))
            found = self.letters[lower] = np.array([t.id for t in self.merge(spelled)], self.type).tobytes()
        if end is None:
            end = self.tails[tail] = np.array(self.ids(tail), self.type).tobytes()
        return found + end

    def meet(self, words: set[str]) -> dict[str, bytes]:
        """Ids of ``words``, as bytes."""
        new = words - self.table.keys()
        alone = [w for w in new if len(w) > LONG_CHUNK or _BREAK in w]
        new.difference_update(alone)
        if len(self.table) + len(new) > TABLE_CHUNKS:
            self.table = {"": b""} | {w: self.table[w] for w in words if w in self.table}
            self.letters, self.tails = {}, {"": b""}
        ordered = []
        for word in new:
            found = self.plain(word)
            if found is None:
                ordered.append(word)
            else:
                self.table[word] = found
        for a in range(0, len(ordered), 4096):
            part = ordered[a : a + 4096]
            flat = np.array(self.ids(f" {_BREAK} ".join(part)), self.type)
            ends = np.append(np.flatnonzero(flat == self.split), len(flat)).tolist()
            raw, size, start = flat.tobytes(), self.type.itemsize, 0
            for word, end in zip(part, ends, strict=True):
                self.table[word] = raw[start * size : end * size]
                start = end + 1
        if not alone:
            return self.table
        return {w: self.table[w] for w in words if w in self.table} | {w: np.array(self.ids(w), self.type).tobytes() for w in alone}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        table = self.meet(set().union(*split))
        return [b"".join(map(table.__getitem__, words)) for words in split]


# ---- the file format ----
def pack(ids: np.ndarray) -> list[bytes]:
    """Levels of ``ids``, each as count, chunks, continuation bitmap and rank directory."""
    levels, ids = [], ids.astype(np.uint32)
    while True:
        more = ids > 255
        bitmap = np.packbits(more, bitorder="little")
        bitmap = np.concatenate((bitmap, np.zeros(-len(bitmap) % (BLOCK // 8) + BLOCK // 8, np.uint8)))
        ones = np.bitwise_count(bitmap.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.uint64)
        ranks = np.cumsum(ones, dtype=np.uint64) - ones
        chunks = (ids & 255).astype(np.uint8)
        levels.append(struct.pack("<q", len(ids)) + chunks.tobytes() + bitmap.tobytes() + ranks.astype("<u8").tobytes())
        if not more.any():
            return levels
        ids = ids[more] >> 8


def build_file(part: int, number: int, doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """A file of whole documents: header, doc_ids, which are null, ends of the documents, levels."""
    ends = np.cumsum([len(i) for i in ids], dtype="<i8")
    levels = pack(np.concatenate(ids))
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    null = np.array([d is None for d in doc_ids], np.uint8)
    head = struct.pack(HEADER, MAGIC, part, number, len(ids), int(ends[-1]), len(levels))
    return b"".join([head, known.tobytes(), null.tobytes(), ends.tobytes(), *levels])


class TokenFile:
    """One file's documents and tokens, read in place."""

    def __init__(self, raw: bytes):
        magic, self.part, self.number, self.docs, self.tokens, levels = struct.unpack_from(HEADER, raw)
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        at = HEADER_BYTES
        self.known = np.frombuffer(raw, "<i8", self.docs, at)
        self.null = np.frombuffer(raw, np.uint8, self.docs, at + 8 * self.docs)
        self.ends = np.frombuffer(raw, "<i8", self.docs, at + 9 * self.docs)
        at += 17 * self.docs
        self.levels = []
        for _ in range(levels):
            (n,) = struct.unpack_from("<q", raw, at)
            blocks = -(-(-(-n // 8)) // (BLOCK // 8)) + 1
            chunks = np.frombuffer(raw, np.uint8, n, at + 8)
            bitmap = np.frombuffer(raw, np.uint8, blocks * (BLOCK // 8), at + 8 + n)
            ranks = np.frombuffer(raw, "<u8", blocks, at + 8 + n + len(bitmap))
            self.levels.append((chunks, bitmap, ranks))
            at += 8 + n + len(bitmap) + 8 * blocks

    @staticmethod
    def _rank(level: tuple, i: int) -> int:
        """Set bits before bit ``i``."""
        _, bitmap, ranks = level
        first = i // BLOCK * (BLOCK // 8)
        inside = int(np.bitwise_count(bitmap[first : i // 8]).sum())
        return int(ranks[i // BLOCK]) + inside + (int(bitmap[i // 8]) & ((1 << i % 8) - 1)).bit_count()

    def token(self, i: int) -> int:
        """Id number ``i``."""
        value, shift = 0, 0
        for level in self.levels:
            chunks, bitmap, _ = level
            value |= int(chunks[i]) << shift
            if not bitmap[i // 8] >> (i % 8) & 1:
                break
            i, shift = self._rank(level, i), shift + 8
        return value

    def between(self, a: int, b: int, depth: int = 0) -> np.ndarray:
        """Ids ``a`` to ``b - 1``: a stretch of one level goes on in a stretch of the next."""
        chunks, bitmap, _ = self.levels[depth]
        out = chunks[a:b].astype("<u4")
        more = np.unpackbits(bitmap[a // 8 : b // 8 + 1], bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)
        if more.any():
            low = self._rank(self.levels[depth], a)
            out[more] |= self.between(low, low + int(more.sum()), depth + 1) << np.uint32(8)
        return out

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first token within the file, ids) of each document."""
        start = 0
        for known, null, end in zip(self.known.tolist(), self.null.tolist(), self.ends.tolist()):
            yield None if null else known, start, self.between(start, end)
            start = end


# ---- writing and reading on Spark ----
def _splitters(docs: DataFrame) -> np.ndarray:
    """doc_ids that cut the rows into ranges of about equal numbers; a common doc_id may be there several times."""
    count = docs.count()
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(max(least, -(-count // RANGE_ROWS)), MAX_RANGES)
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)]) if parts > 1 else F.array(F.lit(0.5))
    found = docs.agg(F.percentile_approx("k", shares, F.lit(parts * SKETCH)).alias("s")).first()["s"] if count else None
    return np.array(found if found and parts > 1 else [], np.int64)


def write_ids(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Ids of every whole text, each with ``end_id`` behind, in files below ``path`` in ascending order of doc_id.

    A null text counts as empty: its only id is the end id. Null doc_ids come first. Repeated rows and rows of one
    doc_id are all kept; the order among the latter follows the order of the input's rows and isn't defined beyond that.
    Other columns are left out. An empty table gives no file that holds documents.
    """
    file = vocabulary or tokenizer_path(VOCABULARY)
    id_column = F.col(f"`{doc_id}`").cast("bigint")
    rows = docs.select(
        id_column.alias("doc_id"), F.col(f"`{text}`").alias("text"), F.coalesce(id_column, F.lit(-(2**63))).alias("k"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"),
    )
    splitters = _splitters(rows.select("k"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(file)
        end = np.array([end_id], words.type).tobytes()
        for batch in batches:
            k, tie = (np.asarray(batch.column(c)) for c in ("k", "tie"))
            low, high = np.searchsorted(splitters, k, "left"), np.searchsorted(splitters, k, "right")
            # The rows of a common doc_id are dealt over all its ranges, in the order of their ties.
            share = (tie.astype(np.float64) + 2.0**63) / 2.0**64
            part = low + np.minimum((share * (high - low)).astype(np.int64), np.maximum(high - low - 1, 0))
            for start, texts in text_slices(batch.column("text")):
                packed = [i + end for i in words.encode(texts.to_pylist())]
                cut = slice(start, start + len(packed))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(packed)), pa.array(part[cut], pa.int32()), pa.array(k[cut]), pa.array(tie[cut]), pa.array(packed, pa.binary())],
                    names=["doc_id", "part", "k", "tie", "ids"],
                )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = WordIds(file).type
        part, number, held, doc_ids, ids = None, 0, 0, [], []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([build_file(part, number, doc_ids, ids)], pa.binary())], names=["file"])

        for batch in batches:
            for own, d, raw in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids")):
                if ids and (own != part or held >= FILE_TOKENS):
                    yield done()
                    number, held, doc_ids, ids = number + 1, 0, [], []
                if own != part:
                    part, number = own, 0
                doc_ids.append(d)
                ids.append(np.frombuffer(raw.as_buffer(), kind))
                held += len(ids[-1])
        if ids:
            yield done()

    encoded = rows.mapInArrow(encode, "doc_id bigint, part int, k bigint, tie bigint, ids binary")
    dealt = encoded.repartitionById(len(splitters) + 1, F.col("part")).sortWithinPartitions("k", "tie")
    files = dealt.mapInArrow(build, "file binary")
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).filter("length > 1").select("path", "content")


def _with_start(rows: DataFrame, name: str) -> DataFrame:
    """Adds to ``name`` (tokens before a row within its file) the tokens of all files before.

    Sums per file run within each range; only one sum per range, of which there are at most ``MAX_RANGES``, meets the driver.
    """
    spark = rows.sparkSession
    files = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    files = stored(files.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))), "files")
    totals = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n").alias("n")).collect())
    starts = np.cumsum([0, *[n for _, n in totals]])[:-1].tolist()
    before = spark.createDataFrame(pd.DataFrame({"part": [p for p, _ in totals], "before": starts}), "part bigint, before bigint")
    files = files.join(F.broadcast(before), "part").select("part", "number", (F.col("inside") + F.col("before")).alias("before"))
    joined = rows.join(broadcast_if_small(files, SMALL_ROWS), ["part", "number"])
    return joined.withColumn(name, F.col(name) + F.col("before")).drop("part", "number", "before")


def read_ids(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32 and, unless left out, ids) of every document in the files below ``path``.

    ``start`` is the number of ids in all documents before; ``ids_crc32`` the checksum of the ids as little-endian
    32-bit integers.
    """
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.list_(pa.uint32())}
    names = list(kinds)[: 5 if keep_ids else 4]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, " + ("ids array<bigint>, " if keep_ids else "") + "part bigint, number bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                file = TokenFile(raw.as_buffer())
                rows = [(d, start, len(ids), zlib.crc32(ids), *([ids] if keep_ids else [])) for d, start, ids in file.documents()]
                arrays = [pa.array(list(c), kinds[n]) for n, c in zip(names, zip(*rows))]
                if keep_ids:
                    arrays[-1] = arrays[-1].cast(pa.list_(pa.int64()))
                place = [pa.array([v] * len(rows), pa.int64()) for v in (file.part, file.number)]
                yield pa.RecordBatch.from_arrays([*arrays, *place], names=[*names, "part", "number"])

    rows = read_files(spark, path).mapInArrow(read, schema)
    return _with_start(stored(rows, "read-ids") if not keep_ids else rows, "start")


def tokens_at(spark: SparkSession, path: str, positions: list[int]) -> DataFrame:
    """(position, token) for positions counted over all files; positions outside are left out.

    Only headers and the looked-up bytes of a file are read from its content, no list of ids is made.
    """
    wanted = np.unique(np.array(positions, np.int64))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [struct.unpack(HEADER, raw.as_py()) for raw in batch.column("head")]
            arrays = [pa.array([h[i] for h in heads], pa.int64()) for i in (1, 2, 4)]
            yield pa.RecordBatch.from_arrays([batch.column("path"), *arrays], names=["path", "part", "number", "n_tokens"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, start in zip(batch.column("content"), batch.column("start").to_pylist()):
                file = TokenFile(raw.as_buffer())
                own = wanted[np.searchsorted(wanted, start) : np.searchsorted(wanted, start + file.tokens)]
                tokens = [file.token(int(i) - start) for i in own]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(tokens, pa.int64())], names=["position", "token"])

    content = read_files(spark, path)
    heads = content.select("path", F.substring("content", 1, HEADER_BYTES).alias("head"))
    heads = stored(heads.mapInArrow(sizes, "path string, part bigint, number bigint, n_tokens bigint"), "heads")
    starts = _with_start(heads.withColumn("start", F.lit(0).cast("bigint")), "start").select("path", "start")
    return content.join(broadcast_if_small(starts, SMALL_ROWS), "path").select("content", "start").mapInArrow(look, "position bigint, token bigint")
