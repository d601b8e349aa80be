import zlib

import pytest
from llm_data import prose

from roadpulse.llm import sharding
from roadpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def check(found, docs, shards=24):
    rows = found.collect()
    want = sorted((repr(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    loads = [0] * shards
    for s in range(shards):
        own = [r for r in rows if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        loads[s] = sum(r["size"] for r in own)
    assert all(0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None for r in rows)
    return loads, rows


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    loads, rows = check(QUERIES["op7_sharding"](spark, SF), docs)
    largest = max(r["size"] for r in rows)
    assert max(loads) - min(loads) <= 2 * largest


@pytest.mark.parametrize("samples", [64, 2])
def test_hot_group_is_divided(spark, monkeypatch, samples):
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", samples)
    docs = [(i, prose(1, 30)) for i in range(1500)] + [(5000, prose(1, 30))] * 300 + [(10_000 + i, prose(i, 20 + i % 30)) for i in range(1500)]
    loads, _ = check(sharding.shard(spark.createDataFrame(docs, "doc_id bigint, text string")), docs)
    assert max(loads) < 1.06 * sum(loads) / 24 and min(loads) > 0.94 * sum(loads) / 24


def test_ranges_come_from_the_sample(spark, monkeypatch):
    """About as many ranges as wanted, none overfull, and the tasks' shares are alike, with a third of all rows in one text."""
    docs = [(i, prose(1, 30)) for i in range(2000)] + [(10_000 + i, prose(i, 20 + i % 60)) for i in range(4000)]
    taken = []
    ranged = sharding._ranged

    def watched(rows, splitters):
        out = ranged(rows, splitters)
        taken.append(out)
        return out

    monkeypatch.setattr(sharding, "_ranged", watched)
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 8)
    sharding.shard(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)).count()
    found = taken[-1].groupBy("range").agg({"*": "count", "weight": "sum"}).collect()
    wanted = 24 * sharding.RANGES_PER_SHARD
    assert len(found) >= 0.8 * wanted
    weights, rows = sorted(r["sum(weight)"] for r in found), sorted(r["count(1)"] for r in found)
    assert all(r["sum(weight)"] <= sharding.OVERFULL * 2.0 / wanted or r["count(1)"] <= 16 for r in found)
    assert rows[-1] <= 4 * rows[len(rows) // 2] and weights[-1] <= 4 * weights[len(weights) // 2]


def test_odd_rows(spark, odd_docs, no_docs):
    check(sharding.shard(odd_docs), [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    empty = sharding.shard(no_docs)
    assert empty.count() == 0 and empty.columns == sharding.shard(odd_docs).columns
