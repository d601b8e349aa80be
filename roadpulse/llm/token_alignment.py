"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids meet.

Each batch lays the tokens of its documents end to end for both sides. ``pandas.merge_asof``, keyed by document, finds
for every token start of one side the covering token of the other; both directions together give all overlapping
pairs, since one of two overlapping tokens begins within the other. Overlapping tokens with equal ends close a group.
All pairs of a group are links, and the documents that hold an id pair linked are counted over the corpus.

Counts come back to the documents in two ways: the few pairs that make up most of all links are sent to every task, and
their number is bounded by the threshold that chooses them; links of other pairs meet their counts by a join, in which
no pair has more rows than that threshold.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadpulse.llm.common import stored, text_slices, tokenizer_path
from roadpulse.llm.token_files import LETTERS, POINTS

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARK = "▁"
TABLE_CHUNKS = 200_000
# Bytes of text whose tokens are laid out together; a token takes some two hundred bytes meanwhile.
SLICE_BYTES = 400_000
LONG_CHUNK = 64
# Id pairs sent to every task; a pair is among them if it takes part in more than 1 / COMMON_PAIRS of all (document, pair).
COMMON_PAIRS = 200_000
# Groups with more links than this are counted by their distinct ids.
LARGE_GROUP = 4096
# A place between two tokens of either side: before a single blank between characters that are neither blanks nor marks.
_BORDER = re.compile(rf"(?<=[^\s{MARK}])(?=[ \n][^\s{MARK}])")
_BYTE = re.compile("<0x([0-9A-F]{2})>")
_SIMPLE = re.compile(r"[ \n]\S*")

SPANS = {"a_ids": "int", "a_ends": "int", "b_ids": "int", "b_ends": "int", "overlap_a": "int", "overlap_b": "int", "a_groups": "int", "b_groups": "int"}


def chunks_of(text: str) -> list[str]:
    """Pieces of space + text that both tokenizers treat alone; each begins with its blank."""
    whole = " " + text
    if whole[-1] in " \n" or any(odd in whole for odd in ("  ", " \n", "\n ", "\n\n", MARK, "\x00")):
        return _BORDER.split(whole)
    return whole.replace("\n", "\x00\n").replace(" ", "\x00 ").split("\x00")[1:]


def byte_letters() -> dict[str, int]:
    """Byte that each character of a byte-level vocabulary stands for: printable Latin-1 as it is, the others in order from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenTable:
    """Tokens of both sides for every distinct chunk met; a full table keeps only the chunks at hand."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        entries = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.bytes_a = [bytes(letters[c] for c in entries[i]) if all(c in letters for c in entries.get(i, "?\n")) else b"" for i in range(self.a.get_vocab_size())]
        self.bytes_b = []
        for piece in map(self.b.id_to_piece, range(self.b.get_piece_size())):
            byte = _BYTE.fullmatch(piece)
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace(MARK, " ").encode())
        self.size_a, self.size_b = (np.array(list(map(len, v)), np.int64) for v in (self.bytes_a, self.bytes_b))
        # Ids are held as bytes.
        self.code = "H" if max(len(self.size_a), len(self.size_b)) <= 2**16 else "I"
        self.type = np.dtype(self.code)
        (self.line,) = self.encode_a(["\n"])[0]
        self.merge = self.a.model.tokenize
        self.letter_of = {b: c for c, b in letters.items()}
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.merged: dict[str, bytes] = {}
        self.ids_a: list[bytes] = []
        self.ids_b: list[bytes] = []
        self.good: list[bool] = []
        self.long: list[str] = []

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _bulk(self, chunks: list[str], glue: str) -> list[bytes]:
        """Ids of chunks without inner white space, encoded together; a line end before each marks where it begins."""
        out, keep = [], 1 if glue else 0
        for start in range(0, len(chunks), 2048):
            part = chunks[start : start + 2048]
            flat = np.array(self.encode_a([glue + glue.join(part)])[0], self.type)
            cuts = [*np.flatnonzero(flat == self.line).tolist(), len(flat)]
            raw, size = flat.tobytes(), flat.itemsize
            out += [raw[(a + keep) * size : b * size] for a, b in zip(cuts, cuts[1:])]
        return out

    def _words(self, chunks: list[str]) -> list[bytes]:
        """First side's ids of blank + word chunks: plain letters go straight to the merges, as do points behind them."""
        out, rest = [b""] * len(chunks), []
        for i, chunk in enumerate(chunks):
            head = chunk.rstrip(POINTS)
            if LETTERS.fullmatch(head, 1) is None:
                rest.append(i)
                continue
            letters, points = self.merged.get(head), self.merged.get(chunk[len(head) :])
            if letters is None:
                letters = self.merged[head] = self._merge(head)
            if points is None:
                points = self.merged[chunk[len(head) :]] = self._merge(chunk[len(head) :])
            out[i] = letters + points
        for i, ids in zip(rest, self._bulk([chunks[i] for i in rest], "\n"), strict=True):
            out[i] = ids
        return out

    def _merge(self, part: str) -> bytes:
        """Ids of one pre-token; in the vocabulary's spelling of bytes printable ASCII stands for itself."""
        if part.isascii() and " " not in part[1:]:
            spelled = self.letter_of[32] + part[1:] if part[:1] == " " else part
        else:
            spelled = "".join(map(self.letter_of.__getitem__, part.encode()))
        return array(self.code, [t.id for t in self.merge(spelled)]).tobytes() if part else b""

    def add(self, chunks: list[str]) -> None:
        """Brings new chunks in."""
        simple, odd = [], []
        for c in chunks:
            (simple if _SIMPLE.fullmatch(c) else odd).append(c)
        spaced, lined = [c for c in simple if c[0] == " "], [c for c in simple if c[0] != " "]
        order = spaced + lined + odd
        ids_a = self._words(spaced) + self._bulk(lined, "") + [array(self.code, i).tobytes() for i in (self.encode_a(odd) if odd else [])]
        # The library puts the mark for the blank cut off a chunk; before a line end it stands alone and is taken away.
        ids_b = self.b.encode([c[1:] if c[0] == " " else c for c in order], num_threads=1) if order else []
        ids_b = [array(self.code, i if c[0] == " " else i[1:]).tobytes() for c, i in zip(order, ids_b)]
        # Compared all at once; only when some chunk isn't spelled as it is are they looked at alone.
        every = "".join(order).encode()
        flat_a, flat_b = (np.frombuffer(b"".join(ids), self.type).tolist() for ids in (ids_a, ids_b))
        good = b"".join(map(self.bytes_a.__getitem__, flat_a)) == every == b"".join(map(self.bytes_b.__getitem__, flat_b))
        for chunk, a, b in zip(order, ids_a, ids_b, strict=True):
            if len(chunk) > LONG_CHUNK:
                self.long.append(chunk)
            self.place[chunk] = len(self.ids_a)
            self.ids_a.append(a)
            self.ids_b.append(b)
            self.good.append(good or self._spells(chunk, a, b))

    def _spells(self, text: str, *sides: bytes) -> bool:
        """Whether the ids of both sides stand for the bytes of ``text``."""
        spelled = [b"".join(map(names.__getitem__, np.frombuffer(ids, self.type).tolist())) for names, ids in zip((self.bytes_a, self.bytes_b), sides)]
        return all(s == text.encode() for s in spelled)

    def look_up(self, split: list[list[str]]) -> list[np.ndarray]:
        """Places of the chunks of each text."""
        words = set().union(*split)
        new = [c for c in words if c not in self.place]
        if len(self.ids_a) + len(new) > TABLE_CHUNKS:
            merged = self.merged if len(self.merged) <= TABLE_CHUNKS else {}
            self.clear()
            self.merged, new = merged, list(words)
        self.add(new)
        return [np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks)) for chunks in split]

    def forget_long(self) -> None:
        """Long chunks stay for the slice that holds them only, so that the table's memory is bounded."""
        for chunk in self.long:
            at = self.place.pop(chunk)
            self.ids_a[at], self.ids_b[at] = b"", b""
        self.long = []

    def joined(self, places: np.ndarray, text: str) -> bool:
        """Whether both sides spell a text's bytes, for a text with chunks that they don't."""
        return self._spells(" " + text, *(b"".join(held[p] for p in places.tolist()) for held in (self.ids_a, self.ids_b)))


def _gather(held: list[bytes], kind: np.dtype, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids held at ``places`` one after another, and how many each place has."""
    used, inverse = np.unique(places, return_inverse=True)
    own = [held[i] for i in used.tolist()]
    sizes = np.fromiter(map(len, own), np.int64, len(own)) // kind.itemsize
    flat = np.frombuffer(b"".join(own), kind)
    starts, counts = (np.cumsum(sizes) - sizes)[inverse], sizes[inverse]
    return flat[np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())].astype(np.int64), counts


def covering(starts: np.ndarray, docs: np.ndarray, other_starts: np.ndarray, other_docs: np.ndarray) -> np.ndarray:
    """For each start the number of the other side's token that covers it, within the same document."""
    left = pd.DataFrame({"start": starts, "doc": docs})
    right = pd.DataFrame({"start": other_starts, "doc": other_docs, "token": np.arange(len(other_starts))})
    return pd.merge_asof(left, right, on="start", by="doc")["token"].to_numpy(np.int64)


class Aligned:
    """Tokens of both sides of several documents laid end to end, their overlaps and groups."""

    def __init__(self, a: np.ndarray, doc_a: np.ndarray, size_a: np.ndarray, b: np.ndarray, doc_b: np.ndarray, size_b: np.ndarray):
        self.a, self.b, self.doc_a, self.doc_b = a, b, doc_a, doc_b
        self.end_a, self.end_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        self.start_a, self.start_b = self.end_a - size_a[a], self.end_b - size_b[b]
        by_a = covering(self.start_a, doc_a, self.start_b, doc_b)
        by_b = covering(self.start_b, doc_b, self.start_a, doc_a)
        # A pair with equal starts is found from both sides.
        twice = self.start_a[by_b] == self.start_b
        self.over_a = np.concatenate((np.arange(len(a)), by_b[~twice]))
        self.over_b = np.concatenate((by_a, np.flatnonzero(~twice)))
        closing = self.end_a[self.over_a] == self.end_b[self.over_b]
        closed_a, closed_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        closed_a[self.over_a[closing]] = True
        closed_b[self.over_b[closing]] = True
        self.closed_a, self.closed_b = closed_a, closed_b
        self.group_a, self.group_b = np.cumsum(closed_a) - closed_a, np.cumsum(closed_b) - closed_b
        self.groups = int(closed_a.sum())
        self.many_a, self.many_b = (np.bincount(g, minlength=self.groups) for g in (self.group_a, self.group_b))
        self.doc = doc_a[closed_a]

    def spelled(self, docs: int) -> list[bytes]:
        """Each document's groups, as ``a1,a2|b1;a3|b2,b3``."""
        before_a, before_b = np.cumsum(self.many_a) - self.many_a, np.cumsum(self.many_b)
        place_a = np.arange(len(self.a)) + (before_b - self.many_b)[self.group_a]
        place_b = np.arange(len(self.b)) + (before_a + self.many_a)[self.group_b]
        ids, mark = np.zeros(len(self.a) + len(self.b), np.int64), np.zeros(len(self.a) + len(self.b), np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        mark[place_a] = np.where(self.closed_a, ord("|"), ord(","))
        mark[place_b] = np.where(self.closed_b, ord(";"), ord(","))
        width = len(str(int(ids.max(initial=0))))
        digits = np.zeros((len(ids), width + 1), np.uint8)
        rest = ids
        for k in range(width - 1, -1, -1):
            digits[:, k], rest = rest % 10 + ord("0"), rest // 10
        digits[:, width] = mark
        length = np.searchsorted(10 ** np.arange(1, width), ids, "right") + 1
        shown = np.arange(width + 1)[None, :] >= (width - length)[:, None]
        text = digits[shown].tobytes()
        owner = np.zeros(len(ids), np.int64)
        owner[place_a], owner[place_b] = self.doc_a, self.doc_b
        sizes = np.bincount(owner, weights=length + 1, minlength=docs).astype(np.int64)
        ends = np.cumsum(sizes)
        return [text[e - n : e - 1] if n else b"" for e, n in zip(ends.tolist(), sizes.tolist())]

    def links(self, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, id pair, links) of each document's distinct pairs in order; a pair is ``a * base + b``."""
        size = self.many_a * self.many_b
        small = size <= LARGE_GROUP
        docs, pairs, counts = [], [], []
        # Each token of a small group beside all of the other side.
        own = small[self.group_a]
        n = self.many_b[self.group_a[own]]
        first = (np.cumsum(self.many_b) - self.many_b)[self.group_a[own]]
        other = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        docs.append(np.repeat(self.doc_a[own], n))
        pairs.append(np.repeat(self.a[own], n) * base + self.b[other])
        counts.append(np.ones(len(other), np.int64))
        last_a, last_b = np.cumsum(self.many_a), np.cumsum(self.many_b)
        for g in np.flatnonzero(~small).tolist():
            ids_a, times_a = np.unique(self.a[last_a[g] - self.many_a[g] : last_a[g]], return_counts=True)
            ids_b, times_b = np.unique(self.b[last_b[g] - self.many_b[g] : last_b[g]], return_counts=True)
            pairs.append((ids_a[:, None] * base + ids_b[None, :]).ravel())
            counts.append((times_a[:, None] * times_b[None, :]).ravel())
            docs.append(np.full(len(pairs[-1]), self.doc[g]))
        doc, pair, count = np.concatenate(docs), np.concatenate(pairs), np.concatenate(counts)
        order = np.lexsort((pair, doc))
        doc, pair, count = doc[order], pair[order], count[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
        at = np.flatnonzero(new)
        return doc[at], pair[at], np.add.reduceat(count, at) if len(at) else count


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None, spans: bool = False) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row of ``docs``.

    Both sides tokenize space + text without special tokens. ``pairs`` are the distinct linked id pairs of a document,
    as A id times the number of B ids plus B id, and ``times`` their links. ``spans`` adds the tokens themselves: ids
    and byte ends of both sides, overlapping token pairs by position, and the group of every token. A text that is
    null or empty, or that either side's bytes don't spell, has no tokens: zeros, empty lists and an empty digest.
    Repeated rows are kept, other columns are left out, and an empty table gives an empty table.
    """
    path_a, path_b = path_a or tokenizer_path(VOCABULARY_A), path_b or tokenizer_path(VOCABULARY_B)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kinds = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string()}
    schema = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"
    schema += "".join(f", {n} array<{t}>" for n, t in SPANS.items()) if spans else ""
    names = ["row", "doc_id", *kinds, "pairs", "times", *(SPANS if spans else [])]

    def lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
        ends = np.searchsorted(owner, np.arange(n + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TokenTable(path_a, path_b)
        base = len(table.size_b)
        for batch in batches:
            for start, part in text_slices(batch.column("text"), SLICE_BYTES):
                texts, n = part.to_pylist(), len(part)
                places = table.look_up([chunks_of(t) if t else [] for t in texts])
                good = np.array(table.good, bool)
                bad = [i for i, p in enumerate(places) if not good[p].all() and not table.joined(p, texts[i])]
                for i in bad:
                    places[i] = places[i][:0]
                held, doc = np.concatenate(places), np.repeat(np.arange(n), list(map(len, places)))
                (a, n_a), (b, n_b) = _gather(table.ids_a, table.type, held), _gather(table.ids_b, table.type, held)
                found = Aligned(a, np.repeat(doc, n_a), table.size_a, b, np.repeat(doc, n_b), table.size_b)
                spelled = [hashlib.sha256(s).hexdigest() if s else "" for s in found.spelled(n)]
                owner, pair, times = found.links(base)
                count = lambda d, w=None: np.bincount(d, weights=w, minlength=n).astype(np.int64)
                columns = [count(found.doc_a), count(found.doc_b), count(found.doc), count(owner, times), spelled]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds.values())]
                arrays += [lists(pair, owner, n, pa.int64()), lists(times, owner, n, pa.int64())]
                if spans:
                    first = np.concatenate(([0], found.end_a))[np.searchsorted(found.doc_a, np.arange(n))]
                    token = lambda d: np.searchsorted(d, np.arange(n))[d]
                    at_a, at_b, groups = token(found.doc_a), token(found.doc_b), np.searchsorted(found.doc, np.arange(n))
                    order = np.lexsort((found.over_b, found.over_a))
                    over_a, over_b = found.over_a[order], found.over_b[order]
                    over_doc = found.doc_a[over_a]
                    for values, d in [
                        (found.a, found.doc_a), (found.end_a - first[found.doc_a], found.doc_a), (found.b, found.doc_b), (found.end_b - first[found.doc_b], found.doc_b),
                        (over_a - at_a[over_a], over_doc), (over_b - at_b[over_b], over_doc),
                        (found.group_a - groups[found.doc_a], found.doc_a), (found.group_b - groups[found.doc_b], found.doc_b),
                    ]:
                        arrays.append(lists(values, d, n, pa.int32()))
                own = [batch.column(c).slice(start, n) for c in ("row", "doc_id")]
                yield pa.RecordBatch.from_arrays([*own, *arrays], names=names)
                table.forget_long()

    return rows.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, base: int) -> DataFrame:
    """(pair, n, best): documents that hold each pair linked, and whether no pair of its A id is held by more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    # An A id has at most as many pairs as there are B ids.
    of_a = Window.partitionBy(F.expr(f"pair div {base}"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def link_statistics(aligned: DataFrame, base: int) -> DataFrame:
    """``aligned`` (stored) with ``n_best`` and ``count_sum``, from the documents in which each link's id pair is linked."""
    counts = stored(pair_counts(aligned, base), "pair-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = total // COMMON_PAIRS
    common = counts.filter(F.col("n") > least).toPandas().sort_values("pair")  # n > total / COMMON_PAIRS holds for fewer than that
    pair, n, best = (common[c].to_numpy(k) for c, k in (("pair", np.int64), ("n", np.int64), ("best", np.bool_)))
    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, times = batch.column("pairs").flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            sizes = np.diff(batch.column("pairs").offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(pair, found), max(len(pair) - 1, 0))
            hit = pair[at] == found if len(pair) else np.zeros(len(found), bool)
            place, own, many = at[hit], owner[hit], times[hit]
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for out, value in zip(sums, (best[place] * many, n[place] * many) if len(pair) else ()):
                np.add.at(out, own, value)
            ends = np.searchsorted(owner[~hit], np.arange(batch.num_rows + 1))
            rest = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v[~hit])) for v in (found, times)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *map(pa.array, sums), *rest], names=[*kept, "n_best", "count_sum", "pairs", "times"])

    kinds = dict(aligned.dtypes)
    rows = aligned.select(*kept, "pairs", "times").mapInArrow(add, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>")
    rare = counts.filter(F.col("n") <= least)
    if rare.isEmpty():
        return rows.drop("pairs", "times")
    rows = stored(rows, "link-sums")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    more = links.join(rare, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )
    joined = rows.drop("pairs", "times").join(more, "row", "left")
    added = {"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}
    return joined.withColumns(added).drop("more_best", "more_sum")


def align_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row; see ``align``.

    ``n_best`` counts the links whose id pair is held by as many documents as any pair of its A id, and ``count_sum`` adds
    up the documents of every link's pair.
    """
    import sentencepiece

    base = sentencepiece.SentencePieceProcessor(model_file=path_b or tokenizer_path(VOCABULARY_B)).get_piece_size()
    return link_statistics(stored(align(docs, doc_id, text, path_a, path_b), "aligned", "zstd"), base)
