import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm_data import prose
from roadpulse.llm import token_alignment as A
from roadpulse.llm.common import tokenizer_path
from roadpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ALPHABET = list(" \n\t\r\x00\x1c\xa0  ab'sTéÉßİ日😀<|>.,-12̸́▁") + ["<|endoftext|>", "<s>", "'ll", "word ", "  ", "\n\n", "<0x41>"]


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(tokenizer_path(A.VOCABULARY_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(A.VOCABULARY_B))
    letters = A.byte_letters()
    names = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items() if all(c in letters for c in t)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        one, two = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = [[names[i] for i in one], [piece(i) for i in two]]
        if any(b"".join(r) != (" " + text).encode() for r in raw):
            return [], []
        return [(i, len(r)) for i, r in zip(one, raw[0])], [(i, len(r)) for i, r in zip(two, raw[1])]

    return tokens


def groups(one, two):
    """Groups of ids by plain loops."""
    out, i, j, at_a, at_b = [], 0, 0, 0, 0
    while i < len(one):
        ga, gb = [one[i][0]], [two[j][0]]
        at_a, at_b, i, j = at_a + one[i][1], at_b + two[j][1], i + 1, j + 1
        while at_a != at_b:
            if at_a < at_b:
                ga.append(one[i][0])
                at_a, i = at_a + one[i][1], i + 1
            else:
                gb.append(two[j][0])
                at_b, j = at_b + two[j][1], j + 1
        out.append((ga, gb))
    return out


def brute(tokens, docs):
    found = [(d, *tokens(t)) for d, t in docs]
    held = [groups(a, b) for _, a, b in found]
    links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for g in held]
    counts = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for (d, a, b), g, c in zip(found, held, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((
            d, len(a), len(b), len(g), sum(c.values()), sum(n for p, n in c.items() if counts[p] == best[p[0]]),
            sum(n * counts[p] for p, n in c.items()), hashlib.sha256(text.encode()).hexdigest() if a else "",
        ))
    return out


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())))


def odd_texts():
    rnd = random.Random(8)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(1, 60))) for _ in range(1500)] + [prose(4, 3000), "x" * 9000, "é日" * 3000, "a\nb c\n\nd", " ", "\n", "▁"]


def test_chunks_give_the_libraries_tokens(models):
    table = A.TokenTable(tokenizer_path(A.VOCABULARY_A), tokenizer_path(A.VOCABULARY_B))
    texts = odd_texts()
    a = table.encode_a([" " + t for t in texts])
    b = table.b.encode(texts)
    for text, places, one, two in zip(texts, table.look_up([A.chunks_of(t) for t in texts]), a, b):
        assert "".join(A.chunks_of(text)) == " " + text
        ids = [[i for p in places for i in np.frombuffer(held[p], table.type)] for held in (table.ids_a, table.ids_b)]
        assert ids == [one, two]


def test_equals_brute_force(spark, odd_docs, no_docs, models, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()] + list(enumerate(odd_texts()))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 n_a", "'x' PAIRS", "2 row").repartition(3)
    want = sorted(map(repr, brute(models, docs)))
    assert rows(A.align_documents(df)) == want
    # Few pairs are sent to all tasks, most come back by the join; the table of chunks overflows; groups count as large.
    monkeypatch.setattr(A, "COMMON_PAIRS", 50)
    monkeypatch.setattr(A, "TABLE_CHUNKS", 100)
    monkeypatch.setattr(A, "LARGE_GROUP", 3)
    assert rows(A.align_documents(df)) == want
    assert A.align_documents(no_docs).count() == 0


def test_spans_and_overlaps(spark, models):
    docs = list(enumerate([t for t in odd_texts() if len(t) < 400] + [None, ""]))
    base = 32_000
    for r in A.align(spark.createDataFrame(docs, "doc_id bigint, text string"), spans=True).collect():
        one, two = models(docs[r["doc_id"]][1])
        ends = [np.cumsum([n for _, n in side]).astype(int).tolist() for side in (one, two)]
        assert (r["a_ids"], r["b_ids"], [r["a_ends"], r["b_ends"]]) == ([i for i, _ in one], [i for i, _ in two], ends)
        starts = [[0, *e[:-1]] for e in ends]
        overlaps = [(i, j) for i in range(len(one)) for j in range(len(two)) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
        assert list(zip(r["overlap_a"], r["overlap_b"])) == overlaps
        held = groups(one, two)
        assert r["a_groups"] == [g for g, (x, _) in enumerate(held) for _ in x] and r["b_groups"] == [g for g, (_, y) in enumerate(held) for _ in y]
        links = Counter(x * base + y for ga, gb in held for x in ga for y in gb)
        assert dict(zip(r["pairs"], r["times"])) == links


def test_query(spark, models):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op12_token_alignment"](spark, SF)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(found) == sorted(map(repr, brute(models, docs)))
