import random

from pyspark.sql import functions as F

from roadpulse.llm import language
from roadpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(text, sample):
    """Phrases of a cross-parse by plain substring search, in blocks as documented."""
    count = 0
    for start in range(0, len(text), language.BLOCK):
        block, at = text[start : start + language.BLOCK], 0
        while at < len(block):
            end = at + 1
            while end <= len(block) and block[at:end] in sample:
                end += 1
            at = max(at + 1, end - 1)
            count += 1
    return count


def test_phrases_equal_brute_force(monkeypatch):
    rnd = random.Random(4)
    samples = {"x": "".join(rnd.choice("ab c") for _ in range(300)), "y": "".join(rnd.choice("bcd ") for _ in range(300))}

    class Rows:
        def collect(self):
            return [{"label": k, "h": 0, "piece": v} for k, v in samples.items()]

    monkeypatch.setattr(language, "labelled_sample", lambda *a: Rows())
    model = language.train(None)
    texts = ["".join(rnd.choice("abcd e") for _ in range(n)) for n in (0, 1, 5, 60, 1024, 1025, 3000)]
    codes = [language.encode(model.symbols, t) for t in texts]
    found = language.phrases(model, codes)
    for row, label in enumerate(model.labels):
        sample = language.encode(model.symbols, samples[label])
        known = "".join(map(chr, sample + 65))
        assert found[row].tolist() == [brute("".join(map(chr, c + 65)), known) for c in codes]


def test_held_out_accuracy(spark):
    found = QUERIES["op1_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    share = found.join(docs, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.97
    assert found.count() == docs.count()
    assert found.filter("score < 0 or score > 1").isEmpty()


def test_odd_rows(spark, odd_docs, no_docs):
    model = language.train(odd_docs)
    rows = language.identify(odd_docs.withColumn("SCORE", F.lit("old")), model)
    assert rows.count() == odd_docs.count() and [c.lower() for c in rows.columns].count("score") == 1
    und = {r["doc_id"] for r in rows.filter("lang_pred = 'und'").collect()}
    assert und == {1, 2, 6, 7, None}
    assert rows.filter("doc_id = 3").distinct().count() == 1
    assert language.identify(no_docs, model).count() == 0
    nothing = language.train(no_docs)
    assert {(r["lang_pred"], r["score"]) for r in language.identify(odd_docs, nothing).collect()} == {("und", 0.0)}


def test_copies_do_not_shrink_the_sample(spark):
    copies = spark.range(400_000).selectExpr("'the same words over and over' text", "'en' lang")
    docs = copies.unionByName(spark.range(100).selectExpr("concat('another text ', id) text", "'en' lang"))
    assert language.labelled_sample(docs).count() == 101


def test_languages_in_a_script_of_thousands_of_letters(spark):
    """Two languages that use the same three thousand letters in different words."""
    import random

    rnd = random.Random(5)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    words = {name: ["".join(rnd.choice(letters) for _ in range(2)) for _ in range(1500)] for name in ("one", "two")}
    text = lambda name, n: "".join(rnd.choice(words[name]) + ("，" if rnd.random() < 0.1 else "") for _ in range(n))
    rows = [(text(name, 150), name) for name in words for _ in range(120)] + [("the river runs under a bridge " * 5, "en")] * 3
    model = language.train(spark.createDataFrame(rows, "text string, lang string"))
    asked = [(text(name, 60), name) for name in words for _ in range(100)] + [("a bridge and the river", "en")]
    found = language.identify(spark.createDataFrame(asked, "text string, want string"), model).collect()
    assert sum(r["lang_pred"] == r["want"] for r in found) >= 0.98 * len(asked)
    assert language.encode(model.symbols, "É") .tolist() == language.encode(model.symbols, "é").tolist() and len(language.encode(model.symbols, "é")) == 3
