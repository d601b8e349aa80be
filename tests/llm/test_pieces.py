import hashlib
import random

import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from roadpulse.llm import pieces
from roadpulse.llm.common import tokenizer_path
from roadpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def digests(model, text):
    ids = model.encode(text or "") + [model.eos_id()]
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_equals_the_library(spark, odd_docs, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))
    rnd = random.Random(5)
    odd = [(i, "".join(rnd.choice(" ▁ab\n\tzé日😀<s></s>ﬁ　.-") for _ in range(rnd.randrange(0, 150)))) for i in range(500)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id bigint, text string"))
    for r in pieces.encode_pieces(docs.withColumn("N_TOKENS", F.lit("old"))).collect():
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == digests(model, r["text"])
        assert len(r["token_ids"]) == r["n_tokens"] and model.decode(r["token_ids"]) == r["decoded"]
    assert pieces.encode_pieces(no_docs).count() == 0


def test_full_table_changes_nothing(monkeypatch):
    table = pieces.ChunkTable(tokenizer_path(pieces.MODEL))
    texts = [f"word{i} and more{i % 7} ▁x  y" for i in range(200)]
    want = list(table.encode(texts))
    monkeypatch.setattr(pieces, "TABLE_CHUNKS", 20)
    small = pieces.ChunkTable(tokenizer_path(pieces.MODEL))
    assert [next(small.encode([t])) for t in texts] == want and len(small.ids) <= 40


def test_query(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op5_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(tuple(r)[1:] == digests(model, docs[r["doc_id"]]) for r in rows)


def test_rows_are_given_out_slice_by_slice(spark):
    class Docs:
        """Stands for a table: holds on to the function that Spark would call for each task."""

        columns = ["doc_id", "text"]
        schema = None

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    texts = [f"word{i} " * 50_000 for i in range(12)]
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))
    run = pieces.encode_pieces(Docs())
    out = list(run(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(12)), "text": texts})])))
    assert len(out) > 1 and [d for b in out for d in b.column("doc_id").to_pylist()] == list(range(12))
    for i, ids in zip(range(12), (v for b in out for v in b.column("token_ids").to_pylist())):
        assert ids == [*model.encode(texts[i]), model.eos_id()]
