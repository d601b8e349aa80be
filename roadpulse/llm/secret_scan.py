"""Secrets in texts: fixed patterns, and strings of high Shannon entropy in a sliding window. SQL expressions only.

Patterns give the base spans. The entropy scan takes maximal runs of token characters as candidates, after allow-listed
words within them were blanked out, and moves a window of ``WINDOW`` characters over each. The window's character counts and
the sum of c * log2(c) over them are carried along: a step takes one count down and one up and changes the sum by what
that adds, looked up by count. A candidate whose highest window entropy reaches the limit of its character class is a
span, unless it overlaps a base span or is of an allow-listed form as a whole.

Limits are set for random strings of 24 characters: of these at most one in twenty is missed in any class (at most one in
eight of 20 characters). Letter-only strings count when they have at least ``MIXED`` letters of either case, since long
words have few capitals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import replaced

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
MIXED = 4
# Class of a candidate, by the first pattern that fits, and the entropy in bits from which it is a secret.
CLASSES = (
    ("^[0-9]+$", 9.0), ("^[0-9a-fA-F]+$", 3.1), ("^[a-z]+$|^[A-Z]+$", 9.0), ("^[a-z0-9]+$|^[A-Z0-9]+$", 3.6),
    ("[0-9]", 3.8), (f"(?:[A-Z][^A-Z]*+){{{MIXED}}}", 3.75),
)
# A letter-only candidate needs as many small letters too.
SMALL = f"(?:[a-z][^a-z]*+){{{MIXED}}}"
# Never secrets: spelled-out alphabets and digits, placeholders, one character eight times over. They are blanked out where
# they stand, so that the rest of a run still counts.
WORDS = ("abcdefgh", "01234567", "12345678", "example", "placeholder", "changeme", "dummy", "redacted")
REPEATED = r"([A-Za-z0-9+/_=-])\1{7}"
# Nor are UUIDs and paths of words, as whole runs. No group in here may be given back, or long runs overflow the stack.
ALLOWED = ("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$", "^/?(?:[A-Za-z]+/)++[A-Za-z]*$")
MASK = "[SECRET]"


# Matches that are laid end to end in one go: appending to one list for all of a text's matches would copy it each time.
BLOCK = 256


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, also where ``use`` names it inside a loop."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def in_blocks(items: Column) -> Column:
    """``items`` in slices of ``BLOCK``; one empty slice if there are none."""
    last = F.greatest(F.floor((F.size(items) - 1) / BLOCK), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * BLOCK + 1, BLOCK))


def _running(items: Column, start: Column, size, make, kind: str) -> Column:
    """``make(item, offset)`` of each item, its offset being ``start`` plus the ``size`` of all items before."""

    def step(done: Column, item: Column) -> Column:
        return F.struct((done["at"] + size(item)).alias("at"), F.concat(done["out"], F.array(make(item, done["at"]))).alias("out"))

    none = F.struct(start.alias("at"), F.expr(f"cast(array() as array<{kind}>)").alias("out"))
    return F.aggregate(items, none, step, lambda done: done["out"])


def _in_blocks(items: Column, size, make, kind: str) -> Column:
    """As ``_running`` from 0, over blocks of ``BLOCK`` items, so that the work grows with the number of items."""

    def placed(cut: Column) -> Column:
        whole = lambda block: F.aggregate(block, F.lit(0), lambda sum_, i: sum_ + size(i))
        starts = _running(cut, F.lit(0), whole, lambda _, at: at, "int")
        return F.flatten(F.zip_with(cut, starts, lambda block, at: _running(block, at, size, make, kind)))

    return bound(bound(items, in_blocks), placed)


def pattern_spans(text: Column, pattern: str, kind: int = 0) -> Column:
    """Spans of all matches: array of (start, kind, end, match), in code points, end exclusive."""
    shape = "struct<start:int,kind:int,end:int,match:string>"
    between = lambda found: F.slice(F.split(text, pattern, -1), 1, F.size(found))
    pair = lambda f, b: F.struct(f.alias("found"), b.alias("before"))
    items = bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.zip_with(found, between(found), pair))

    def span(item: Column, at: Column) -> Column:
        start = at + F.length(item["before"])
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(item["found"])).alias("end"), item["found"].alias("match"))

    spans = _in_blocks(items, lambda i: F.length(i["found"]) + F.length(i["before"]), span, shape)
    return F.when(text.rlike(pattern), spans).otherwise(F.expr(f"cast(array() as array<{shape}>)"))


def window_entropy(run: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy, in bits, of the windows of an ASCII string of at least ``window`` characters."""
    # What the c-th like character adds to the sum of c * log2(c).
    gain = F.array(*[F.lit(c * math.log2(c) - (c - 1) * math.log2(c - 1) if c > 1 else 0.0) for c in range(1, window + 2)])
    byte = F.lit(bytes(range(window + 2)))

    def bits(total: Column) -> Column:
        return math.log2(window) - total / window

    def count(counts: Column, code: Column) -> Column:
        return F.ascii(F.substring(counts, code + 1, F.lit(1)).cast("string"))

    def moved(state: Column, raw: Column, i: Column) -> Column:
        """One more character in, and the one ``window`` before it out; one byte of ``counts`` per character code."""
        code = lambda at: F.ascii(F.substring(raw, at, F.lit(1)).cast("string"))

        def change(counts: Column, at: Column, by: int, sum_: Column) -> Column:
            held = F.struct(code(at).alias("code"), count(counts, code(at)).alias("n"))
            put = lambda h: F.overlay(counts, F.substring(byte, h["n"] + by + 1, F.lit(1)), h["code"] + 1, 1)
            return bound(held, lambda h: F.struct(put(h).alias("counts"), (sum_ + by * F.get(gain, h["n"] - (1 if by < 0 else 0))).alias("sum")))

        same = F.struct(state["counts"].alias("counts"), state["sum"].alias("sum"))
        left = F.when(i > window, change(state["counts"], i - window, -1, state["sum"])).otherwise(same)
        after = bound(left, lambda s: change(s["counts"], i, 1, s["sum"]))
        best = F.when(i > window, F.greatest(state["best"], bits(state["sum"]))).otherwise(state["best"])
        return bound(after, lambda s: F.struct(s["counts"].alias("counts"), s["sum"].alias("sum"), best.alias("best")))

    start = F.struct(F.lit(bytes(128)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
    walk = lambda raw: F.aggregate(F.sequence(F.lit(1), F.octet_length(raw)), start, lambda s, i: moved(s, raw, i), lambda s: F.greatest(s["best"], bits(s["sum"])))
    return bound(run.cast("binary"), walk)


def blanked(text: Column) -> Column:
    """``text`` with blanks in place of allow-listed words; places stay as they are."""
    out = F.when(text.rlike(REPEATED), F.regexp_replace(text, REPEATED, " " * 8)).otherwise(text)
    for word in WORDS:
        out = F.regexp_replace(out, f"(?i){word}", " " * len(word))
    return F.when(text.rlike("(?i)" + "|".join(WORDS)) | text.rlike(REPEATED), out).otherwise(text)


def _suspicious(span: Column) -> Column:
    run = span["match"]
    limit = F.lit(9.0)
    for pattern, bits in reversed(CLASSES):
        limit = F.when(run.rlike(pattern), F.lit(bits)).otherwise(limit)
    allowed = run.rlike("|".join(f"(?:{p})" for p in ALLOWED))
    told = run.rlike("[0-9]") | run.rlike(SMALL)
    return F.when((limit < 9) & told & ~allowed, window_entropy(run) >= limit).otherwise(F.lit(False))


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``secret_spans``, arrays of (start, kind, end) by start, then kind.

    ``kind`` is an index into ``KINDS``. A null text counts as empty and has no spans. Rows are treated alone:
    repeated rows stay, an empty table stays empty, and columns of the new names are replaced.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = docs.withColumn("__assign", F.filter(pattern_spans(whole, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 6))
    found = found.withColumn("__base", F.array_sort(F.concat("__assign", pattern_spans(whole, ACCESS, 1), pattern_spans(whole, HEX, 2))))

    def blocks(base: Column) -> Column:
        """Base spans in blocks, each with the stretch of text it lies in."""
        low = lambda block: F.array_min(F.transform(block, lambda s: s["start"]))
        high = lambda block: F.array_max(F.transform(block, lambda s: s["end"]))
        return F.transform(in_blocks(base), lambda block: F.struct(low(block).alias("start"), high(block).alias("end"), block.alias("spans")))

    def overlaps(some: Column, span: Column) -> Column:
        return (some["start"] < span["end"]) & (span["start"] < some["end"])

    def more(base_blocks: Column) -> Column:
        inside = lambda span: F.exists(base_blocks, lambda b: overlaps(b, span) & F.exists(b["spans"], lambda s: overlaps(s, span)))
        return F.filter(pattern_spans(blanked(whole), CANDIDATE, 3), lambda span: ~F.coalesce(inside(span), F.lit(False)) & _suspicious(span))

    found = found.withColumn("__more", bound(bound(F.col("__base"), blocks), more))

    def short(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    out = replaced(found, base_spans=short(F.col("__base")), secret_spans=short(F.array_sort(F.concat("__base", "__more"))))
    return out.drop("__assign", "__base", "__more")


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each run of overlapping spans replaced by ``MASK``; null stays null."""

    def run(start: Column, end: Column) -> Column:
        return F.array(F.struct(start.alias("start"), end.alias("end")))

    def of_block(some: Column) -> Column:
        def step(done: Column, s: Column) -> Column:
            last = F.element_at(done, -1)
            longer = F.concat(F.slice(done, 1, F.size(done) - 1), run(last["start"], F.greatest(last["end"], s["end"])))
            return F.when(s["start"] < last["end"], longer).otherwise(F.concat(done, run(s["start"], s["end"])))

        first = F.get(some, F.lit(0))
        return F.aggregate(F.slice(some, 2, F.size(some)), run(first["start"], first["end"]), step)

    def joined(done: Column, block: Column) -> Column:
        last = F.element_at(done, -1)
        met = F.transform(F.filter(block, lambda r: r["start"] < last["end"]), lambda r: r["end"])
        return F.concat(F.slice(done, 1, F.size(done) - 1), run(last["start"], F.greatest(last["end"], F.array_max(met))), F.filter(block, lambda r: r["start"] >= last["end"]))

    def runs(some: Column) -> Column:
        each = F.transform(in_blocks(some), of_block)
        return bound(each, lambda e: F.aggregate(F.slice(e, 2, F.size(e)), F.get(e, F.lit(0)), joined))

    def kept(v: Column) -> Column:
        # Characters are found by counting from the front, bytes at once; in ASCII they are the same.
        def cut(start: Column, size: Column) -> Column:
            return F.when(v["plain"], F.substring(v["raw"], start + 1, size).cast("string")).otherwise(F.substring(text, start + 1, size))

        before = lambda i: F.when(i > 0, F.get(v["runs"], i - 1)["end"]).otherwise(0)
        heads = F.transform(v["runs"], lambda r, i: cut(before(i), r["start"] - before(i)))
        last = F.element_at(v["runs"], -1)["end"]
        return F.array_join(F.concat(heads, F.array(cut(last, v["size"] - last))), MASK)

    facts = F.struct(
        bound(spans, runs).alias("runs"), text.cast("binary").alias("raw"), F.length(text).alias("size"), (F.octet_length(text) == F.length(text)).alias("plain")
    )
    return F.when(F.size(spans) > 0, bound(facts, kept)).otherwise(text)
