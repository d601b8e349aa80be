import random

from llm_data import prose
from pyspark.sql import functions as F

from roadpulse.llm import decontaminate as D
from roadpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_longest_common_subsequence():
    rnd = random.Random(8)
    for _ in range(300):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randrange(0, 30))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        places = {}
        for i, x in enumerate(a):
            places[x] = places.get(x, 0) | 1 << i
        assert D.longest_common(places, len(a), b) == table[-1][-1]


def test_query_finds_all_verbatim_items(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]}
    rows = QUERIES["op9_decontamination"](spark, SF).collect()
    assert len(rows) == len(docs)
    assert {(r["doc_id"], i) for r in rows for i in r["item_ids"]} == want
    assert all(r["contaminated"] == bool(r["item_ids"]) for r in rows)


def test_paraphrases_and_clean_texts(spark):
    items = [(i, " ".join(f"w{i}n{k}" if k % 3 else "the" for k in range(40)) + f". answer{i} is a{i} b{i}.") for i in range(30)]
    docs, want = [], set()
    for i, (item, text) in enumerate(items):
        words = text.split()
        changed = [w if k % 5 or k > 38 else "other" for k, w in enumerate(words)]  # a fifth is replaced, the answer stays
        scattered = [w if k % 2 else "other" for k, w in enumerate(words)]
        docs.append((i, prose(i, 100) + " " + " ".join(changed) + " " + prose(i + 500, 70)))
        docs.append((100 + i, prose(i + 50, 90) + " " + " ".join(scattered)))
        docs.append((200 + i, prose(i, 30) + text.upper() + prose(i, 300)))
        docs.append((300 + i, prose(i + 900, 200)))
        want |= {(i, item), (200 + i, item)}
    found = D.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want


def test_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    items = spark.createDataFrame([(1, prose(2, 40)), (1, prose(2, 40)), (2, None), (3, ""), (4, "too short"), (None, prose(99, 50)), (5, prose(77, 60))], "item_id bigint, text string")
    monkeypatch.setattr(D, "BLOCK_ITEMS", 2)
    found = {(r["doc_id"], r["item_id"]) for r in D.contaminated(odd_docs, items).collect()}
    assert found == {(3, 1), (4, 1), (8, 1), (5, None)}
    kept = D.without_items(odd_docs.withColumn("Item_ID", F.lit(1)), items)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, None, 6, 7, 9, None]))
    assert D.contaminated(no_docs, items).count() == 0 and D.contaminated(odd_docs, items.limit(0)).count() == 0


def test_short_unspaced_and_null_id_copies(spark, tmp_path):
    chinese = "水在标准大气压下的沸点是多少摄氏度答案是一百度"
    items = [(1, "Capital of Peru? Lima."), (2, chinese), (3, "東京都"), (4, "never held here"), (5, prose(31, 20))]
    rows = [
        (1, prose(1, 60) + " capital of peru: LIMA " + prose(2, 60)), (2, "前文很长" + chinese + "后文也很长"), (3, prose(3, 50) + " 私は東京都に住む"),
        (4, prose(4, 80) + " capital of peru"), (5, "limaa capital of peru lim"), (6, "capital of"), (7, "peru lima"), (None, prose(5, 50) + " " + prose(31, 20) + " " + prose(6, 50)),
    ]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = {r["doc_id"]: (r["contaminated"], r["item_ids"]) for r in QUERIES["op9_decontamination"](spark, str(tmp_path)).collect()}
    want = {1: [1], 2: [2], 3: [3], None: [5]}
    assert found == {i: (i in want, want.get(i, [])) for i, _ in rows}


def test_whole_copies_do_not_need_the_latent_space(spark, monkeypatch):
    monkeypatch.setattr(D, "COSINE", 2.0)
    items = [(i, prose(900 + i, 10 + i)) for i in range(50)]
    docs = [(i, prose(i, 7 * i + 1) + ". " + t.upper() + "; " + prose(i + 60, 90)) for i, t in items] + [(100, prose(5, 300))]
    found = D.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"], r["lcs"]) for r in found.collect()} == {(i, i, 1.0) for i, _ in items}
