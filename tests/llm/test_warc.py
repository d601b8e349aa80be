import hashlib

from roadpulse.llm import warc


def test_round_trip_with_magic_in_payloads(spark, tmp_path):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nX-Page-ID: 999\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    same = "x" * 150
    rows = [
        (1, "http://a/1", "plain"), (2, None, None), (3, "http://a/é\r\nX-Page-ID: 7", fake), (4, "u", fake + fake), (5, "u", "WARC/1.0\r\n" * 40), (6, "u", same), (7, "u", same),
        (8, "u", "y" * 99), (9, "u", "y" * 99), (10, "u", ""), (11, "u", "tail WARC/1.0\r\n"), (12, "u", "日本" * 60 + "\r\n\r\n" + fake), (6, "u", same), (None, "u", same), (13, "u", "z" * 300_000),
        # A false header whose length leads exactly to the next record.
        (14, "u", "WARC/1.0\r\nContent-Length: 5\r\n\r\nabcde"), (15, "u", "end"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # many tasks to a file
        records = warc.read_archives(spark, path)
        found = [tuple(r) for r in warc.page_records(records).collect()]
        payloads = {bytes(r["payload"]) for r in records.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        copy = html == same and page != 6
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if copy else "response", 6 if copy else None))
    assert sorted(map(repr, found)) == sorted(map(repr, want))
    assert {(h or "").encode() for _, _, h in rows} <= payloads | {same.encode()}


def test_broken_files(spark, tmp_path):
    good = b"WARC/1.0\r\nX-Page-ID: 1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(good + b"WARC/1.0\r\nX-Page-ID: 2\r\nno length\r\n\r\n" + good)
    (tmp_path / "b.warc").write_bytes(b"junk" + good)
    (tmp_path / "c.warc").write_bytes(good + good[:40])
    (tmp_path / "d.warc").write_bytes(b"")
    found = warc.read_archives(spark, str(tmp_path)).collect()
    by_file = sorted((r["file"][-6:], r["offset"], bytes(r["payload"] or b"")) for r in found if r["payload"] is not None and "Length: 2" in r["header"])
    assert by_file == [("a.warc", 0, b"ab"), ("c.warc", 0, b"ab")]


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    warc.write_archives(pages, str(tmp_path / "none"))
    assert warc.page_records(warc.read_archives(spark, str(tmp_path / "none"))).count() == 0
