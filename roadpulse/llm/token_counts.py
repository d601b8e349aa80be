"""Token counts that follow edits.

A text is cut into segments at places where the tokenizer's pre-tokens always end: before a single space between two
characters that aren't white space. The segments' token counts are the leaves of a tree of sums kept beside the text.
An edit re-encodes only the segments it touches, together with neighbours whose border it may have made unsafe, and
updates the sums above them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import replaced, text_slices, tokenizer_path

VOCABULARY = "byte_bpe_50k.tiktoken"
# Pattern of the vocabulary's pre-tokens (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEGMENT = 512
_BORDER = re.compile(r"\S \S")
COLUMNS = ("n_tokens", "token_starts", "token_sums")
EDIT = "array<struct<start:int,end:int,text:string>>"


def load_counter(path: str) -> Callable[[str], int]:
    """Function that counts the tokens of a text."""
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encode = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda text: len(encode(text))


def cut(text: str) -> list[int]:
    """Where segments of at least ``SEGMENT`` characters begin."""
    starts, at = [0], 0
    while (border := _BORDER.search(text, at + SEGMENT)) is not None:
        at = border.start() + 1
        starts.append(at)
    return starts


def build_sums(counts: list[int]) -> list[int]:
    """Tree of sums as an array: node i has children 2i+1 and 2i+2, and the leaves come last, filled up with zeros."""
    width = 1 << max(0, len(counts) - 1).bit_length()
    sums = [0] * (width - 1) + counts + [0] * (width - len(counts))
    for i in range(width - 2, -1, -1):
        sums[i] = sums[2 * i + 1] + sums[2 * i + 2]
    return sums


def set_leaf(sums: list[int], leaf: int, count: int) -> None:
    """Sets one leaf and updates the sums above it."""
    i = len(sums) // 2 + leaf
    change = count - sums[i]
    while change:
        sums[i] += change
        if i == 0:
            break
        i = (i - 1) // 2


def plant(text: str, count: Callable[[str], int]) -> tuple[list[int], list[int]]:
    """Segment starts and sums of a text."""
    starts = cut(text)
    return starts, build_sums([count(text[a:b]) for a, b in zip(starts, [*starts[1:], len(text)])])


def _safe(text: str, at: int) -> bool:
    return at in (0, len(text)) or (0 < at < len(text) - 1 and text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace())


def make_edits(text: str, starts: list[int], sums: list[int], edits: list[tuple[int, int, str]], count: Callable[[str], int]) -> tuple[str, list[int], list[int], int]:
    """(new text, starts, sums, characters re-encoded) after ``text[start:end]`` becomes the new one in each edit.

    Edits are in ascending order and don't overlap. The text is put together once, segments touched by several edits are
    encoded once, and the sums above all changes are brought up to date together.
    """
    pieces, at, ends, shifts = [], 0, [], [0]
    for start, end, new in edits:
        pieces += [text[at:start], new]
        at = end
        ends.append(end)
        shifts.append(shifts[-1] + len(new) - (end - start))
    after, last = "".join([*pieces, text[at:]]), len(starts) - 1

    def moved(place: int) -> int:
        """Where a border between segments that no edit touches has come to."""
        return place + shifts[bisect_left(ends, place)]

    # From the segment that holds the character before an edit to the one that holds the character after it, and on to safe borders.
    regions: list[list[int]] = []
    for start, end, _ in edits:
        low, high = bisect_right(starts, max(0, start - 1)) - 1, bisect_right(starts, min(end, max(0, len(text) - 1))) - 1
        done = regions[-1][1] if regions else -1
        if high <= done:
            continue
        while low > done + 1 and not _safe(after, moved(starts[low])):
            low -= 1
        while high < last and not _safe(after, moved(starts[high + 1])):
            high += 1
        if regions and low <= done:
            regions[-1][1] = high
        else:
            regions.append([low, high])

    leaves = sums[len(sums) // 2 : len(sums) // 2 + len(starts)]
    new_starts: list[int] = []
    new_leaves: list[int] = []
    changed, kept, encoded, at = [], [], 0, 0
    for low, high in regions:
        new_starts += map(moved, starts[at:low])
        new_leaves += leaves[at:low]
        left, right = moved(starts[low]), moved(starts[high + 1]) if high < last else len(after)
        region = after[left:right]
        cuts = cut(region) if len(region) > 2 * SEGMENT else [0]
        kept.append(len(cuts) == high - low + 1)
        changed += range(len(new_leaves), len(new_leaves) + len(cuts))
        new_starts += (left + c for c in cuts)
        new_leaves += (count(region[a:b]) for a, b in zip(cuts, [*cuts[1:], len(region)]))
        encoded, at = encoded + len(region), high + 1
    new_starts += map(moved, starts[at:])
    new_leaves += leaves[at:]
    # Leaves that keep their places need no new tree.
    if all(kept) and len(changed) * len(sums).bit_length() < len(sums):
        for i in changed:
            set_leaf(sums, i, new_leaves[i])
        return after, new_starts, sums, encoded
    return after, new_starts, build_sums(new_leaves), encoded


def apply_edit(text: str, starts: list[int], sums: list[int], start: int, end: int, new: str, count: Callable[[str], int]) -> tuple[str, list[int], list[int], int]:
    """(new text, starts, sums, characters re-encoded) after ``text[start:end]`` becomes ``new``."""
    return make_edits(text, starts, sums, [(start, end, new)], count)


def count_tokens(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, ``token_starts`` and ``token_sums``, in place of columns so named.

    A null text counts as empty, with no token. Rows are treated alone, so repeated rows stay; an empty table stays empty.
    """
    path = vocabulary or tokenizer_path(VOCABULARY)
    added = {"n_tokens": F.lit(0).cast("bigint"), "token_starts": F.array(F.lit(0)), "token_sums": F.array(F.lit(0))}
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added])
    schema = replaced(rows, **added).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load_counter(path)
        for batch in batches:
            trees = [plant(t, count) for _, part in text_slices(batch.column(batch.schema.get_field_index(text))) for t in part.to_pylist()]
            if batch.num_rows:
                totals, starts, sums = [s[0] for _, s in trees], [s for s, _ in trees], [s for _, s in trees]
                arrays = [pa.array(totals, pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array(sums, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *COLUMNS])

    return rows.mapInArrow(run, schema)


def apply_edits(counted: DataFrame, edits: str = "edits", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``counted`` (of ``count_tokens``) with its edits made: text, counts and trees brought up to date.

    ``edits`` is an array of (start, end, text) in characters of the old text. They are made from the last to the
    first; one that overlaps a later one, lies outside the text, or holds a null is left out. Null or empty edits
    change nothing, and a null text stays null and takes none. Added are ``n_edits``, those made, and ``n_reencoded``, the characters
    that were encoded anew.
    """
    path = vocabulary or tokenizer_path(VOCABULARY)
    names = [c for c in counted.columns if c.lower() not in ("n_edits", "n_reencoded")]
    rows = counted.select(*[F.col(f"`{c}`") for c in names])
    schema = replaced(rows, n_edits=F.lit(0), n_reencoded=F.lit(0).cast("bigint")).schema

    def edited(value: str | None, starts: list[int], sums: list[int], wanted: list[dict] | None, count: Callable[[str], int]) -> tuple:
        usable = [] if value is None else [e for e in wanted or () if e and None not in e.values() and 0 <= e["start"] <= e["end"] <= len(value)]
        limit, chosen = len(value or ""), []
        for e in sorted(usable, key=lambda e: (e["start"], e["end"]), reverse=True):
            if e["end"] <= limit:
                chosen.append((e["start"], e["end"], e["text"]))
                limit = e["start"]
        encoded = 0
        if chosen:
            value, starts, sums, encoded = make_edits(value, starts, sums, chosen[::-1], count)
        return value, sums[0], starts, sums, len(chosen), encoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load_counter(path)
        for batch in batches:
            for start, part in text_slices(batch.column(batch.schema.get_field_index(text))):
                own = batch.slice(start, len(part))
                columns = dict(zip(own.schema.names, own.columns))
                rows = zip(*(columns[c].to_pylist() for c in (text, "token_starts", "token_sums", edits)))
                values = list(zip(*(edited(*row, count) for row in rows)))
                types = [columns[text].type, pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.int64()]
                for name, v, t in zip((text, *COLUMNS, "n_edits", "n_reencoded"), values, types):
                    columns[name] = pa.array(v, t)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return rows.mapInArrow(run, schema)
