"""Language identification by cross-parsing entropy.

A bounded sample of labelled text per language is turned into a suffix automaton. A text is cut, for each
language, into phrases that are the longest matches found in that language's sample; the language that needs
the fewest bits (phrases times the bits that name a place in its sample) per character wins.

The automata are laid out as one table of transitions, so a task walks many texts and all languages at a time.
Texts are walked in blocks of ``BLOCK`` symbols, each beginning a new phrase; all of every text counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import replaced, text_slices

# Characters of labelled text per language, in all, and per sampled row: the documented bound of the fitted model.
SAMPLE_CHARS = 24_000
MODEL_CHARS = 240_000
ROW_CHARS = 400
# The sample holds this many times the rows that are needed, as their number is random.
OVERSAMPLE = 3
BLOCK = 1024
UNKNOWN = "und"
_COUNT = 28  # bits for a place in the table; phrases ended by a transition stand above
_SPACE, _OTHER, _PAD = 0, 1, 2
# Letters that are symbols of their own. Where the samples have more, only the commonest are, and any other letter is
# spelled by three digits of six bits, so that scripts with thousands of letters keep them all apart.
LETTERS, COMMON, DIGITS = 250, 186, 64
_SPELLED = 255


@dataclass(frozen=True)
class LanguageModel:
    """``symbols``: symbol of each code point; ``moves``: next row, plus ended phrases, for each row and symbol."""

    labels: tuple[str, ...]
    bits: np.ndarray
    roots: np.ndarray
    symbols: np.ndarray
    moves: np.ndarray


def labelled_sample(docs: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """At most about ``OVERSAMPLE * SAMPLE_CHARS / ROW_CHARS`` different pieces of text for each label.

    Rows are chosen by a hash of their text, so copies are chosen together and then count once; the piece
    begins at a place that the hash names. A label's different texts are counted first, so the share to take is known;
    the text with the smallest hash is always taken.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(label).alias("label")).filter("text is not null and label is not null")
    rows = rows.withColumn("h", F.xxhash64("text"))
    unit = F.pmod("h", F.lit(1_000_003)) / F.lit(1_000_003.0)
    different = rows.select("label", "h").distinct().groupBy("label").agg(F.count(F.lit(1)), F.min(unit))
    counts = {r[0]: r[1:] for r in different.collect()}  # one row per label
    if not counts:
        return rows.select("label", "h", F.col("text").alias("piece")).limit(0)
    wanted = OVERSAMPLE * SAMPLE_CHARS // ROW_CHARS
    share = F.create_map(*[x for k, (n, least) in counts.items() for x in (F.lit(k), F.lit(min(1.0, max(wanted / n, least + 5e-7))))])
    start = F.pmod(F.shiftright("h", 20), F.greatest(F.length("text") - ROW_CHARS, F.lit(0)) + 1) + 1
    chosen = rows.filter(unit < share[F.col("label")])
    piece = F.substring("text", start.cast("int"), F.lit(ROW_CHARS))
    return chosen.groupBy("label", "h").agg(F.min(piece).alias("piece"))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that knows every substring of ``symbols``; the root is 0."""
    moves, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and c not in moves[at]:
            moves[at][c] = new
            at = link[at]
        if at >= 0:
            target = moves[at][c]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                link.append(link[target])
                length.append(length[at] + 1)
                while at >= 0 and moves[at].get(c) == target:
                    moves[at][c] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    return moves


def symbol_table(alphabet: list[str]) -> np.ndarray:
    """Symbol of each code point: letters of the alphabet in either case, other letters, all else as space."""
    table = np.zeros(0x110000, np.uint8)
    other = _OTHER if len(alphabet) <= LETTERS else _SPELLED
    alphabet = alphabet if len(alphabet) <= LETTERS else alphabet[:COMMON]
    own = {c: i + 3 for i, c in enumerate(alphabet)}
    for code in range(0x110000):
        if (c := chr(code)).isalpha():
            low = c.lower()
            table[code] = own.get(low, other)
    return table


def encode(symbols: np.ndarray, text: str) -> np.ndarray:
    """Symbols of ``text``, with runs of spaces made one."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = symbols[points]
    spelled = np.flatnonzero(codes == _SPELLED)
    if len(spelled):
        letters, which = np.unique(points[spelled], return_inverse=True)
        low = np.array([ord(chr(c).lower()[0]) for c in letters.tolist()])[which]
        first = spelled + 2 * np.arange(len(spelled))
        codes = np.repeat(codes, np.where(codes == _SPELLED, 3, 1))
        for digit in range(3):
            codes[first + digit] = 3 + COMMON + (low >> 6 * (2 - digit)) % DIGITS
    return codes[(codes != _SPACE) | np.concatenate(([True], codes[:-1] != _SPACE))] if len(codes) else codes


def train(docs: DataFrame, text: str = "text", label: str = "lang") -> LanguageModel:
    """Model of the labels in ``docs``. With no labelled text there are no labels, and every text is ``und``.

    The sample that reaches the driver is bounded by the constants above, whatever the size of ``docs``.
    """
    pieces: dict[str, list[tuple[int, str]]] = {}
    for row in labelled_sample(docs, text, label).collect():
        pieces.setdefault(row["label"], []).append((row["h"], row["piece"]))
    quota = min(SAMPLE_CHARS, MODEL_CHARS // max(1, len(pieces)))
    samples = {k: " ".join(p for _, p in sorted(v))[:quota].lower() for k, v in sorted(pieces.items())}
    samples = {k: v for k, v in samples.items() if any(c.isalpha() for c in v)}
    seen: dict[str, int] = {}
    for s in samples.values():
        for c in filter(str.isalpha, s):
            seen[c] = seen.get(c, 0) + 1
    alphabet = sorted(seen, key=lambda c: (-seen[c], c))
    table = symbol_table(sorted(alphabet) if len(alphabet) <= LETTERS else alphabet)
    width, blocks, roots, bits = 3 + (len(alphabet) if len(alphabet) <= LETTERS else COMMON + DIGITS), [], [], []
    for s in samples.values():
        symbols = encode(table, s).tolist()
        automaton = suffix_automaton(symbols)
        base = sum(map(len, blocks))
        root = np.full(width, 2 << _COUNT, np.int64) + base * width
        for c, t in automaton[0].items():
            root[c] = (base + t) * width + (1 << _COUNT)
        rows = np.tile(root, (len(automaton), 1))
        for state, moves in enumerate(automaton):
            for c, t in moves.items():
                rows[state, c] = (base + t) * width
            rows[state, _PAD] = (base + state) * width
        rows[0] -= 1 << _COUNT  # no phrase is open at the root
        rows[0, [*automaton[0], _PAD]] = [*((base + t) * width for t in automaton[0].values()), base * width]
        blocks.append(rows)
        roots.append(base * width)
        bits.append(np.log2(max(2, len(symbols))))
    moves = np.concatenate(blocks).ravel() if blocks else np.zeros(0, np.int64)
    return LanguageModel(tuple(samples), np.array(bits), np.array(roots, np.int64), table, moves)


def phrases(model: LanguageModel, texts: list[np.ndarray]) -> np.ndarray:
    """Phrases that each language (row) needs for each text (column), given as symbols."""
    sizes = np.array([len(t) for t in texts])
    blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    grid = np.full((len(owner), BLOCK), _PAD, np.uint8)
    at = 0
    for t, n in zip(texts, blocks):
        grid[at : at + n].reshape(-1)[: len(t)] = t
        at += n
    lengths = np.full(len(owner), BLOCK)
    ends = np.cumsum(blocks)[blocks > 0] - 1
    lengths[ends] = (sizes - (blocks - 1) * BLOCK)[blocks > 0]
    order = np.argsort(-lengths, kind="stable")
    columns = np.ascontiguousarray(grid[order].T)
    active = len(owner) - np.searchsorted(lengths[order][::-1], np.arange(BLOCK), side="right")
    state = np.repeat(model.roots[:, None], len(owner), 1)
    count = np.zeros(state.shape, np.int64)
    mask = (1 << _COUNT) - 1
    for step in range(BLOCK):
        n = active[step]
        if n == 0:
            break
        move = model.moves[state[:, :n] + columns[step, :n]]
        count[:, :n] += move >> _COUNT
        state[:, :n] = move & mask
    count += state != model.roots[:, None]
    total = np.zeros((len(model.labels), len(texts)))
    for row in range(len(model.labels)):
        total[row] = np.bincount(owner[order], count[row], len(texts))
    return total


def predict(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Label and score (how far the best is ahead of the next, 0 to 1) of each text."""
    codes = [encode(model.symbols, t or "") for t in texts]
    known = np.array([bool((c != _SPACE).any()) for c in codes], bool)
    if not model.labels or not len(texts):
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    cost = phrases(model, codes) * model.bits[:, None] / np.maximum(1, [len(c) for c in codes])
    best = cost.argmin(0)
    two = np.sort(cost, axis=0)[:2]
    ahead = 1 - two[0] / np.maximum(two[-1], 1e-12) if len(two) > 1 else 1 / (1 + two[0])
    labels = [model.labels[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
    return labels, np.where(known, np.clip(ahead, 0, 1), 0.0)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, which take the place of columns so named.

    A text that is null or has no letter is ``und`` with score 0, as is every text when the model has no label.
    Equal texts have equal results; ties go to the label first in order. An empty table gives an empty table.
    """
    # Plain values, as workers need no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast(dict(vars(model)))
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = replaced(rows, lang_pred=F.lit(""), score=F.lit(0.0)).schema

    def run(batches):
        model = SimpleNamespace(**shared.value)
        for batch in batches:
            labels, scores = [], []
            for _, part in text_slices(batch.column(batch.schema.get_field_index(text))):
                found, score = predict(model, part.to_pylist())
                labels += found
                scores.append(score)
            if batch.num_rows:
                added = [pa.array(labels, pa.string()), pa.array(np.concatenate(scores))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
