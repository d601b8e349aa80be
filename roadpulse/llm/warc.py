"""WARC archives: written through Spark's text sink, read back by verifying the chain of record boundaries.

Reading splits archives at every place that holds the record magic, also inside payloads, so any number of tasks
share a file. Each piece is a candidate record whose header names its successor's offset. Runs of candidates that
follow each other are contracted, and pointer jumping from the start of each file marks the runs that the chain
reaches. Only reached candidates are records; the others are pieces of a payload and are put back into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadpulse.llm.common import stored
from roadpulse.session import broadcast_if_small

MAGIC = "WARC/1.0\r\n"
MIN_REVISIT_BYTES = 100
# Rows of a table that is broadcast after it was counted.
SMALL_ROWS = 100_000
RECORDS_PER_FILE = 50_000


def write_archives(pages: DataFrame, path: str) -> None:
    """One record per row of (page_id, url, html), in uncompressed archives below ``path``.

    The payload is the html in UTF-8, a null one being empty. Of records with equal payloads of at least 100 bytes the
    one with the smallest page_id (and every repeated row of it) is a response, the others are revisits without a
    block; smaller ones are all responses. Line breaks in a url are dropped; a null url or page_id stays out.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"), F.octet_length(payload).alias("n"), F.sha2(payload, 256).alias("digest"))
    large = rows.filter(F.col("n") >= MIN_REVISIT_BYTES).select("page_id", "digest")
    copied = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    rows = rows.join(broadcast_if_small(stored(copied, "copied"), SMALL_ROWS), "digest", "left")
    # A copy of an empty payload is never in the joined table, and a null page_id refers to no other.
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    name = F.md5(F.concat_ws(" ", F.col("page_id").cast("string"), F.col("digest"), F.col("url")))
    uuid = F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")

    def line(key: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{key}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))

    record = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))), line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", "")), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Page-ID", F.col("page_id")), line("X-Payload-Length", F.col("n")), line("X-Refers-To-Page", F.when(revisit, F.col("first"))),
        F.lit("Content-Type: text/html\r\n"), line("Content-Length", F.octet_length(block)), F.lit("\r\n"), block, F.lit("\r\n"),
    )
    rows.select(record.alias("value")).write.option("lineSep", "\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _header(name: str, header: str = "header") -> Column:
    found = F.regexp_extract(header, rf"(?mi)^{name}:[ \t]*([^\r\n]*?)[ \t]*$", 1)
    return F.when(found != "", found)


def reached(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the candidates (file, offset, successor) that a chain from offset 0 of their file reaches."""
    order = Window.partitionBy("file").orderBy("offset")
    linked = candidates.withColumn("follows", F.coalesce(F.lag("successor").over(order) == F.col("offset"), F.lit(False)))
    linked = linked.withColumn("leaves", ~F.coalesce(F.lead("offset").over(order) == F.col("successor"), F.lit(False)))
    linked = stored(linked, "linked")
    targets = linked.filter("leaves and successor is not null").select("file", F.col("successor").alias("offset"), F.lit(True).alias("target")).distinct()
    headed = linked.join(targets, ["file", "offset"], "left").withColumn("head", ~F.col("follows") | F.coalesce("target", F.lit(False)))
    headed = headed.withColumn("run", F.max(F.when(F.col("head"), F.col("offset"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    headed = stored(headed.select("file", "offset", "run", "successor"), "headed")
    # A run ends where its last candidate points.
    runs = headed.groupBy("file", "run").agg(F.max_by("successor", "offset").alias("jump"))
    state = stored(runs.select("file", "run", "jump", (F.col("run") == 0).alias("reached")), "runs")
    while True:
        marked = state.filter("reached and jump is not null").select("file", F.col("jump").alias("run"), F.lit(True).alias("hit")).distinct()
        onward = state.select("file", F.col("run").alias("jump"), F.col("jump").alias("further"))
        after = state.join(marked, ["file", "run"], "left").join(onward, ["file", "jump"], "left")
        after = stored(after.select("file", "run", F.col("further").alias("jump"), "reached", (F.col("reached") | F.coalesce("hit", F.lit(False))).alias("now")), "runs")
        done = after.filter("jump is not null or reached <> now").isEmpty()
        state = after.select("file", "run", "jump", F.col("now").alias("reached"))
        if done:
            return headed.join(state.filter("reached").select("file", "run"), ["file", "run"], "left_semi").select("file", "offset")


def read_archives(spark: SparkSession, path: str, offsets: bool = True) -> DataFrame:
    """(file, offset, header, payload) of every record in the uncompressed archives below ``path``.

    Magic bytes inside a payload never start a record. Records behind a broken one in the same file are not reached,
    and a file that doesn't begin with the magic has none. Without ``offsets`` that column is left out, which spares a
    shuffle of the payloads.
    """
    text = spark.read.option("lineSep", MAGIC).text(path)
    pieces = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"), F.col("value").cast("binary").alias("piece"),
    )
    pieces = stored(pieces, "pieces", "zstd")
    cut = F.col("piece").cast("string")
    header = F.when(F.instr(cut, "\r\n\r\n") > 0, F.substring_index(cut, "\r\n\r\n", 1))
    light = pieces.select("file", "split", "row", F.octet_length("piece").alias("n"), header.alias("header"))
    # The first piece of a file lies before any magic; each later one has its magic just before it.
    order = Window.partitionBy("file").orderBy("split", "row")
    before = F.sum(F.col("n") + len(MAGIC)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    length = F.expr("try_cast(length as bigint)")
    light = light.withColumn("length", _header("Content-Length")).select(
        "file", "row", (before - len(MAGIC)).alias("offset"), (before + F.octet_length("header") + 4 + length + 4).alias("successor"),
    )
    light = stored(light, "light")
    candidates = light.filter("offset is not null")
    records = reached(candidates.select("file", "offset", "successor")).withColumn("real", F.lit(True))
    marked = candidates.select("file", "row", "offset").join(records, ["file", "offset"], "left")
    line = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("real"), F.col("offset")), ignorenulls=True).over(line)
    marked = marked.withColumn("owner", owner)
    marked = marked.withColumn("parts", F.count(F.lit(1)).over(Window.partitionBy("file", "owner")))
    # Most records are one piece. Only the others, and pieces of no record, are told to the tasks that read the pieces.
    special = marked.filter("owner is null or parts > 1").select("file", "row", "offset", "owner")
    special = special.unionByName(light.filter("offset is null").select("file", "row", "offset", F.lit(None).cast("bigint").alias("owner")))
    special = broadcast_if_small(stored(special, "special"), SMALL_ROWS)
    whole = pieces.join(special.select("file", "row"), ["file", "row"], "left_anti")
    if offsets:
        whole = whole.join(light.select("file", "row", "offset"), ["file", "row"])
    place = ["file", "offset"] if offsets else ["file"]
    found = pieces.join(special.filter("owner is not null"), ["file", "row"]).select("file", "offset", "owner", "piece")
    glued = found.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("p"))
    magic = F.lit(MAGIC).cast("binary")
    joined = F.aggregate(F.slice("p", 2, F.size("p")), F.get("p", F.lit(0))["piece"], lambda a, x: F.concat(a, magic, x["piece"]))
    rows = whole.select(*place, "piece").unionByName(glued.withColumn("offset", F.col("owner")).select(*place, joined.alias("piece")))
    rows = rows.withColumn("header", F.substring_index(F.col("piece").cast("string"), "\r\n\r\n", 1)).withColumn("length", _header("Content-Length"))
    payload = F.substring(F.col("piece"), F.octet_length("header") + 5, F.expr("cast(length as int)"))
    return rows.select(*place, "header", payload.alias("payload"))


def page_records(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records of pages.

    Length and digest of a response are those of the payload as read; a revisit states those of the payload it stands for.
    """
    revisit = _header("WARC-Type") == "revisit"
    stated = F.regexp_replace(_header("WARC-Payload-Digest"), "^sha256:", "")
    return records.select(
        _header("X-Page-ID").cast("bigint").alias("page_id"),
        F.when(revisit, _header("X-Payload-Length").cast("bigint")).otherwise(F.octet_length("payload").cast("bigint")).alias("payload_bytes"),
        F.when(revisit, stated).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        _header("WARC-Type").alias("record_type"), _header("X-Refers-To-Page").cast("bigint").alias("refers_to"),
    )
