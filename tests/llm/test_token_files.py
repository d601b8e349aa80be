import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_data import prose
from roadpulse.llm import token_files as T
from roadpulse.llm.common import tokenizer_path
from roadpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(tokenizer_path(T.VOCABULARY))


def brute(model, docs):
    """Rows by plain loops; documents in the given order."""
    start, out = 0, []
    for doc_id, text in docs:
        ids = model.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_words_equal_the_library(model):
    rnd = random.Random(3)
    alphabet = list(" \n\t\r\x00\x1c  ab'sTéÉßİ日😀<|>.,-12̸́Σς") + ["<|endoftext|>", "'ll", "word ", "  "]
    alphabet += ["ÀÖß", "Wörd,", "don't", "THE.", "x)(", "...", "Ǆ", "<", "|>"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 80))) for _ in range(3000)] + [prose(4, 5000)]
    words = T.WordIds(tokenizer_path(T.VOCABULARY))
    for raw, text in zip(words.encode(texts), texts):
        assert np.frombuffer(raw, words.type).tolist() == model.encode(text, add_special_tokens=False).ids


def test_full_table_changes_nothing(monkeypatch):
    texts = [f"word{i} and more{i % 7}, x  y\n{'z' * 70}" for i in range(200)]
    want = T.WordIds(tokenizer_path(T.VOCABULARY)).encode(texts)
    monkeypatch.setattr(T, "TABLE_CHUNKS", 20)
    small = T.WordIds(tokenizer_path(T.VOCABULARY))
    assert [small.encode([t])[0] for t in texts] == want and len(small.table) <= 40


@pytest.mark.parametrize("top", [1, 255, 256, 65_535, 70_000, 2**32 - 1])
def test_any_token_is_found_without_decoding(top):
    ids = np.random.default_rng(top).integers(0, top, 5000, dtype=np.uint32, endpoint=True)
    file = T.TokenFile(T.build_file(3, 4, [7, None], [ids[:2000], ids[2000:]]))
    assert (file.part, file.number, file.tokens) == (3, 4, 5000)
    assert [file.token(i) for i in range(5000)] == ids.tolist()
    for a, b in [(0, 5000), (0, 0), (5000, 5000), (511, 513), (1, 4999), (1023, 1024)]:
        assert file.between(a, b).tolist() == ids[a:b].tolist()
    assert [(d, s, i.tolist()) for d, s, i in file.documents()] == [(7, 0, ids[:2000].tolist()), (None, 2000, ids[2000:].tolist())]


def test_round_trip_in_order(spark, odd_docs, no_docs, model, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "FILE_TOKENS", 500)
    docs = odd_docs.withColumn("IDS", F.lit("other")).withColumn("part", F.lit(1)).repartition(3)
    T.write_ids(docs, str(tmp_path / "a"))
    got = {(r["doc_id"], r["start"]): r for r in T.read_ids(spark, str(tmp_path / "a")).collect()}
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r["doc_id"], []).append(model.encode(r["text"] or "", add_special_tokens=False).ids + [1])
    start = 0
    for doc_id, at in sorted(got, key=lambda k: k[1]):
        ids = got[doc_id, at]["ids"]
        assert at == start and ids in texts[doc_id] and got[doc_id, at]["n_tokens"] == len(ids)
        assert got[doc_id, at]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        texts[doc_id].remove(ids)
        start += len(ids)
    assert not any(texts.values())
    order = [-1 if d is None else d for d, _ in sorted(got, key=lambda k: k[1])]
    assert order == sorted(order)
    T.write_ids(no_docs, str(tmp_path / "none"))
    assert T.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_a_common_doc_id_is_split(spark, tmp_path, monkeypatch, model):
    monkeypatch.setattr(T, "RANGE_ROWS", 20)
    rows = [(5, f"same id {i}") for i in range(300)] + [(i, f"own id {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    path = str(tmp_path / "files")
    T.write_ids(docs, path)
    found = T.read_ids(spark, path).orderBy("start").collect()
    assert len(found) == 400 and [r["doc_id"] for r in found] == sorted(d for d, _ in rows)
    assert [(r["start"], r["n_tokens"]) for r in found] == list(zip(np.cumsum([0] + [r["n_tokens"] for r in found]).tolist(), [r["n_tokens"] for r in found]))
    files = [T.TokenFile(bytes(r["content"])) for r in T.read_files(spark, path).collect()]
    assert sum(5 in f.known.tolist() for f in files) > 5 and max(f.docs for f in files) < 60
    line = [i for r in found for i in r["ids"]]
    asked = [0, 7, 8, len(line) - 1, len(line), -1, 500]
    assert {r["position"]: r["token"] for r in T.tokens_at(spark, path, asked).collect()} == {i: line[i] for i in asked if 0 <= i < len(line)}


def test_query(spark, model):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = QUERIES["op11_token_files"](spark, SF).orderBy("start").collect()
    assert [tuple(r) for r in rows] == [r[:4] for r in brute(model, docs)]
    assert rows[0].asDict().keys() == {"doc_id", "start", "n_tokens", "ids_crc32"}
