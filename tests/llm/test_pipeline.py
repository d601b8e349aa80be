import re

import sentencepiece
from test_ngram_join import brute as classes
from test_secrets import spans

import corpus_pipeline
from roadpulse.llm import pieces, secret_scan
from roadpulse.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"


def masked(text):
    out, at = "", 0
    for s, _, e in spans(text):
        out += text[at:s] + secret_scan.MASK if s >= at else ""
        at = max(at, e)
    return out + text[at:]


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [r for r in docs if r["text"] is not None and any(c.isalpha() for c in r["text"])]
    alone = {m[0] for m in (re.findall(r"\d+|None", x) for x in classes([(r["doc_id"], r["text"]) for r in kept])) if m[0] == m[1]}
    kept = [r for r in kept if str(r["doc_id"]) in alone and not any(i in r["text"] for i in items)]
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))
    want = {r["doc_id"]: model.encode(masked(r["text"])) + [model.eos_id()] for r in kept}
    found = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["token_ids"] for r in found} == want and len(found) == len(want)
    assert all(r["n_tokens"] == len(r["token_ids"]) and r["text"] == model.decode(r["token_ids"]) for r in found)
    assert all(r["lang"] is not None for r in found)


def test_stages_keep_the_columns_and_odd_rows(spark, odd_docs, no_docs, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secret_scan", "sentencepiece"]
    spark.createDataFrame([(1, "an item that no document holds in any way")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for case, docs in (("odd", odd_docs), ("none", no_docs)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "sentencepiece":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            out.write.parquet(str(tmp_path / f"{case}-{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{case}-{name}"))


def test_stages_keep_clashing_columns(spark, tmp_path):
    """Columns named like those of the operators, in any case, and with odd names, come through every stage as they are."""
    spark.createDataFrame([(1, "an item that no document holds in any way")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    extra = ["score", "lang_pred", "Secret_Spans", "base_spans", "decoded", "class_id", "first_copy", "leads", "text_id", "row", "a.b", "with space", "__kept", "__text", "__rows", "item_ids", "Held_Out"]
    last = ["n_tokens", "TOKEN_IDS", "ids_sha256"]
    text = "the river runs under a stone bridge and every morning an old miller walks along its bank"
    rows = [(i, f"{text} {i * 7919} {'x' * i}", "en", "a", 5, *(f"{c}-{i}" for c in extra + last)) for i in range(6)]
    names = ["doc_id", "text", "lang", "source", "n_chars", *extra, *last]
    docs = spark.createDataFrame(rows, ", ".join(f"`{c}` {'bigint' if c in ('doc_id', 'n_chars') else 'string'}" for c in names))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        kept = names if name != "sentencepiece" else names[: -len(last)] + ["n_tokens", "token_ids", "ids_sha256"]
        assert out.columns == kept, name
        out.write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name)).collect()
        assert found, name
        for r in found:
            assert [r[5 + i] for i in range(len(extra))] == [f"{c}-{r['doc_id']}" for c in extra], name
