import re

import pytest
from llm_data import prose

from roadpulse.llm import ngram_join as N
from roadpulse.llm.components import connected_components
from roadpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(class, links, links to other texts) of each row (doc_id, text), from all pairs of shingle sets."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^ \t\n\r\x0b\x0c]+", (text or "").lower())
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    linked = [[False] * len(rows) for _ in rows]
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows):
            if i != j and a is not None and b is not None:
                both = len(sets[i] & sets[j])
                linked[i][j] = a == b or (both > 0 and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both))
    group = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if linked[i][j]:
                    group[i] = group[j] = min(group[i], group[j])
    known = lambda i: min((rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None), default=None)
    out = []
    for i, (doc_id, text) in enumerate(rows):
        others = {rows[j][1] for j in range(len(rows)) if linked[i][j] and rows[j][1] != text}
        out.append((doc_id, known(i), sum(linked[i]), len(others)))
    return sorted(map(repr, out))


def got(df):
    return sorted(repr((r["doc_id"], r["class_id"], r["n_links"], r["n_text_links"])) for r in df.collect())


def test_odd_rows_equal_brute_force(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert got(N.jaccard_join(odd_docs)) == brute(rows)
    assert N.jaccard_join(no_docs).count() == 0
    kept = N.one_per_class(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, None, 3, 5, 6, 7, 9, None]))


def near_copies(n):
    """One text and ``n`` copies of it, each with some words replaced, so that some pairs are links and others aren't."""
    words, rows = prose(7, 150).split(), []
    for i in range(n):
        own = list(words)
        for k in range(i % 6):
            own[(i * 31 + k * 29) % 150] = f"new{i}x{k}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("blocks", [256, 16])
def test_large_group_in_blocks(spark, monkeypatch, blocks):
    monkeypatch.setattr(N, "BLOCK_TEXTS", blocks)
    rows = near_copies(90) + [(1000 + i, "a very common copy of some words in a row") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(N.jaccard_join(docs)) == brute(rows)


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op4_ngram_jaccard_join"](spark, SF)) == brute(rows)


def test_posterior():
    # Against the integral of the binomial likelihood over a fine grid.
    grid = [(i + 0.5) / 20_000 for i in range(20_000)]
    for m, n in ((10, 32), (25, 32), (100, 160)):
        like = [s**m * (1 - s) ** (n - m) for s in grid]
        assert N.posterior(m, n) == pytest.approx(sum(v for s, v in zip(grid, like) if s >= 0.8) / sum(like), rel=1e-3, abs=1e-9)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7), (200, 150), (None, 3)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 150: 150, 200: 150}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_copies_with_null_ids(spark):
    words = prose(5, 120).split()
    near = lambda *places: " ".join("new" + str(k) if k in places else w for k, w in enumerate(words))
    # 1 and 2 are linked by a text with no id alone; null ids also stand apart from all ids, and beside one.
    ends = [(1, near(10)), (None, near(10, 40, 70)), (2, near(40, 70, 100))]
    other = prose(6, 90)
    rows = ends + [(None, other), (None, other + " end"), (None, prose(8, 80)), (7, prose(8, 80)), (8, prose(8, 80) + " end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(N.jaccard_join(docs)) == brute(rows)
    assert brute(ends) != brute([r for r in ends if r[0]] + [(None, None)])
    kept = [(r["doc_id"], r["text"]) for r in N.one_per_class(docs).collect()]
    assert sorted(i for i, _ in kept if i) == [1, 7] and len(kept) == 3
    assert [t for i, t in kept if i is None][0] in (other, other + " end")
