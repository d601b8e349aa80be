import random
import re

from pyspark.sql import functions as F

from roadpulse.llm import queries as Q
from roadpulse.llm import token_counts as C

SF = "/root/testdata/sf0.001"
COUNT = C.load_counter(C.tokenizer_path(C.VOCABULARY))
BITS = ["a", "the ", " ", "  ", "\n", "it's ", "x1 ", "é", "…", " — ", "'", "1 ", "日本 "]


def text_of(rnd, n):
    return "".join(rnd.choice(BITS) for _ in range(n))


def test_edits_equal_counting_anew():
    rnd = random.Random(6)
    for _ in range(150):
        text = text_of(rnd, rnd.randrange(0, 3000))
        starts, sums = C.plant(text, COUNT)
        for _ in range(5):
            a = rnd.randrange(len(text) + 1)
            b, new = min(len(text), a + rnd.choice([0, 1, 2, 5, 600])), text_of(rnd, rnd.choice([0, 1, 3, 800]))
            want = text[:a] + new + text[b:]
            text, starts, sums, _ = C.apply_edit(text, starts, sums, a, b, new, COUNT)
            leaves = sums[len(sums) // 2 :][: len(starts)]
            assert text == want and sums[0] == COUNT(text) and sums == C.build_sums(leaves)
            assert leaves == [COUNT(text[p:q]) for p, q in zip(starts, [*starts[1:], len(text)])]


def test_many_edits_at_once_equal_counting_anew():
    rnd = random.Random(7)
    for _ in range(200):
        text = text_of(rnd, rnd.randrange(0, 3000))
        starts, sums = C.plant(text, COUNT)
        places = sorted(rnd.randrange(len(text) + 1) for _ in range(2 * rnd.randrange(0, 30)))
        edits = [(a, b, text_of(rnd, rnd.choice([0, 1, 3, 300]))) for a, b in zip(places[::2], places[1::2])]
        edits = [e for i, e in enumerate(edits) if i == 0 or e[0] >= edits[i - 1][1]]
        want, at = "", 0
        for a, b, new in edits:
            want, at = want + text[at:a] + new, b
        want += text[at:]
        after, starts, sums, _ = C.make_edits(text, starts, sums, edits, COUNT)
        leaves = sums[len(sums) // 2 :][: len(starts)]
        assert after == want and sums[0] == COUNT(want) and sums == C.build_sums(leaves)
        assert leaves == [COUNT(want[p:q]) for p, q in zip(starts, [*starts[1:], len(want)])]


def test_crowded_and_long_texts_take_seconds(spark):
    """Forty thousand addresses in one text, and one address of a megabyte, which overflowed the matcher's stack."""
    import time

    from roadpulse.llm.secret_scan import pattern_spans

    texts = [" ".join(f"user{i}@example{i % 7}.org and" for i in range(40_000)), "a@b" + ".c" * 500_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    start = time.time()
    masks = F.transform(pattern_spans(F.col("text"), Q.ADDRESS), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("[ADDRESS]").alias("text")))
    rows = C.apply_edits(C.count_tokens(docs.withColumn("edits", masks))).orderBy("doc_id").collect()
    assert time.time() - start < 60
    for r, text in zip(rows, texts):
        assert r["text"] == re.sub(Q.ADDRESS, "[ADDRESS]", text, flags=re.A) and r["n_tokens"] == COUNT(r["text"])
        assert r["n_edits"] == (40_000 if r["doc_id"] == 0 else 1) and r["n_reencoded"] <= len(r["text"])


def test_small_edits_reencode_little():
    text = "some words and more of them follow here " * 3000
    starts, sums = C.plant(text, COUNT)
    _, _, _, encoded = C.apply_edit(text, starts, sums, 60_000, 60_004, "new", COUNT)
    assert encoded < 3 * C.SEGMENT


def test_query_equals_counting_anew(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.QUERIES["op3_token_counts"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r["doc_id"]]
        assert (r["n_before"], r["n_tokens"]) == (COUNT(text), COUNT(re.sub(Q.ADDRESS, "[ADDRESS]", text, flags=re.A)))


def test_odd_rows(spark, odd_docs, no_docs):
    edits = F.expr(f"cast(array(named_struct('start', 0, 'end', 1, 'text', 'New'), named_struct('start', 5, 'end', 3, 'text', 'x'), null, named_struct('start', 0, 'end', 2, 'text', null), named_struct('start', 999999999, 'end', 999999999, 'text', 'x')) as {C.EDIT})")
    docs = odd_docs.withColumn("edits", F.when(F.col("doc_id") != 4, edits)).withColumn("N_Edits", F.lit("old"))
    for r in C.apply_edits(C.count_tokens(docs)).join(odd_docs.select("doc_id", F.col("text").alias("was")).distinct(), "doc_id").collect():
        was = r["was"]
        want = was if was in (None, "") or r["doc_id"] == 4 else "New" + was[1:]
        assert r["text"] == want and r["n_tokens"] == COUNT(want or "")
        assert r["n_edits"] == int(want != was)
    assert C.apply_edits(C.count_tokens(no_docs.withColumn("edits", edits))).count() == 0
