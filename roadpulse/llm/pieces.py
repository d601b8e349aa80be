"""SentencePiece encoding and decoding over a table of distinct chunks.

No piece of the model crosses from another character into a white-space marker, so a text falls into marked words:
a run of markers and the characters up to the next marker. Each task keeps a table of the distinct marked words
it has met, has the library segment each of them once, and puts ids together by the words' positions. A full table
keeps only the words of the slice at hand, which bounds a task's memory and changes no result.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import replaced, text_slices, tokenizer_path

MODEL = "piece_bpe_32k.model"
TABLE_CHUNKS = 500_000
# Words longer than this are segmented anew each time, so that the table's memory is bounded too.
LONG_CHUNK = 64
MARK = "▁"
_CHUNK = re.compile(f"[ {MARK}]+[^ {MARK}]*")


def chunks_of(text: str) -> list[str]:
    """Marked words of ``text``; the library puts one marker before a text that isn't empty."""
    return _CHUNK.findall(" " + text) if text else []


class ChunkTable:
    """Ids (as decimal text) of distinct marked words, and decoded text where it isn't the word itself."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if any(MARK in p.lstrip(MARK) for p in map(self.model.id_to_piece, range(self.model.get_piece_size()))):
            raise ValueError("pieces of this model cross white-space markers")
        self.end, self.mark = self.model.eos_id(), self.model.piece_to_id(MARK)
        self.names = [str(i) for i in range(self.model.get_piece_size())]
        # A lone marker in front keeps the library from taking away a word's own marker.
        self.lead = self.model.encode("a")[0]
        self.lead_text = self.model.decode([self.lead])
        self.ids: dict[str, str] = {}
        self.texts: dict[str, str] = {}

    def segment(self, chunks: list[str]) -> tuple[list[str], list[str]]:
        """Ids and decoded text of each chunk, as the library gives them."""
        ids = self.model.encode([c[1:] for c in chunks], num_threads=1)
        # The marker that the library adds stands for the one cut off here; an empty rest gets none.
        ids = [i if len(c) > 1 else [self.mark] for i, c in zip(ids, chunks)]
        spelled = [" ".join(map(self.names.__getitem__, i)) for i in ids]
        # Decoding all at once shows whether each word comes back as it was; only else are they decoded alone.
        if self.model.decode([self.lead, *chain.from_iterable(ids)]) == self.lead_text + "".join(chunks):
            return spelled, chunks
        decoded = self.model.decode([[self.lead, *i] for i in ids], num_threads=1)
        return spelled, [d[len(self.lead_text) :] for d in decoded]

    def meet(self, chunks: set[str]) -> None:
        """Brings ``chunks`` into the table; words not met lately make room when it is full."""
        new = [c for c in chunks if c not in self.ids]
        if len(self.ids) + len(new) > TABLE_CHUNKS:
            self.ids = {c: self.ids[c] for c in chunks if c in self.ids}
            self.texts = {c: self.texts[c] for c in chunks if c in self.texts}
        # Words holding a literal marker come back with a space, so they are kept from the others.
        for part in ([c for c in new if MARK not in c], [c for c in new if MARK in c]):
            if part:
                ids, texts = self.segment(part)
                self.ids.update(zip(part, ids))
                self.texts.update((c, t) for c, t in zip(part, texts) if c != t)

    def encode(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """(ids as text, without the end id; decoded text) of each text."""
        split = [chunks_of(t) for t in texts]
        words = set().union(*split)
        self.meet({c for c in words if len(c) <= LONG_CHUNK})
        if long := [c for c in words if len(c) > LONG_CHUNK]:
            ids, decoded = self.segment(long)
            ids, changed = {**self.ids, **dict(zip(long, ids))}, {**self.texts, **dict(zip(long, decoded))}
        else:
            ids, changed = self.ids, self.texts
        for chunks in split:
            spelled = map(changed.get, chunks, chunks) if changed else chunks
            yield " ".join(map(ids.__getitem__, chunks)), "".join(spelled)[1:]


def encode_pieces(docs: DataFrame, text: str = "text", model_file: str | None = None, keep_ids: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``token_ids`` (the end id last), ``decoded`` and both SHA-256 digests.

    These take the place of columns so named. A null text counts as empty: its only id is the end id. Rows are
    treated alone, so repeated rows are kept, and an empty table gives an empty table. ``keep_ids=False`` leaves
    out ids and text and keeps the digests.
    """
    path = model_file or tokenizer_path(MODEL)
    added = {"n_tokens": F.lit(0).cast("bigint"), "ids_sha256": F.lit(""), "decoded_sha256": F.lit("")}
    if keep_ids:
        added |= {"token_ids": F.array(F.lit(0)), "decoded": F.lit("")}
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added])
    schema, names = replaced(rows, **added).schema, list(added)

    def run(batches):
        gc.disable()  # the many lists of ids hold no cycles, and looking for some takes a fifth of the time
        table = ChunkTable(path)
        for batch in batches:
            # Given out slice by slice: the ids of a whole batch take ten times the memory of its texts.
            for first, part in text_slices(batch.column(batch.schema.get_field_index(text))):
                columns: list[list] = [[] for _ in names]
                for ids, decoded in table.encode(part.to_pylist()):
                    ids = f"{ids} {table.end}" if ids else str(table.end)
                    row = [ids.count(" ") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()]
                    for column, v in zip(columns, [*row, np.fromstring(ids, np.int32, sep=" "), decoded] if keep_ids else row):
                        column.append(v)
                types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([*batch.slice(first, len(part)).columns, *arrays], names=[*batch.schema.names, *names])

    return rows.mapInArrow(run, schema)
