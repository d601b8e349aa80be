"""One query per operator over its whole table, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import decontaminate, language, nearest, ngram_join, pieces, secret_scan, sharding, token_alignment, token_counts, token_files, urls, vector_codes, warc
from roadpulse.llm.common import read_table
from roadpulse.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(check: str | None = None):
    """Register a query under the function's name."""

    def add(function):
        QUERIES[function.__name__] = function
        if check:
            ORACLES[function.__name__] = check
        return function

    return add


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that aren't held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language.train(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    found = language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


# Rules of the URL query, and words whose hosts make up its list.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
LISTED_HOSTS = "adult-x|cheap-pills|ads-track|spam-farm|casino-win|free-bets"

_URLS_SQL = f"""
with rules(rhost, rpath, rverdict) as (values {", ".join(map(str, RULES))}),
parts as (
 select page_id, url, case when contains(url, '://') then translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end host,
  case when contains(url, '://') then regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) else '' end path
 from pages),
spelled as (
 select *, regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') address from parts),
listed as (select distinct address from spelled where regexp_matches(host, '{LISTED_HOSTS}')),
urls as (select distinct url, host, path, address from spelled),
fits as (
 select url, rhost || rpath rule, rverdict from urls join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
 qualify row_number() over (partition by url order by length(rhost || rpath) desc, length(rhost) desc) = 1)
select page_id, host, path, rule, coalesce(rverdict, case when address in (select address from listed) then 'block' else 'allow' end) verdict
from spelled left join fits using (url)"""


@query(_URLS_SQL)
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL, by rules or else by the list of pages on unwanted hosts."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    listed = pages.filter(urls.host_and_path(F.col("url"))[0].rlike(LISTED_HOSTS)).select("url").distinct()
    return urls.judge(pages, rules, listed).select("page_id", "host", "path", "rule", "verdict")


# Mail and network addresses, which the edits of the token query mask.
# The group over and over must not be given back, or long addresses overflow the stack of Java's matcher.
ADDRESS = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++|\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b"


@query()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document as it is, and after its mail and network addresses were masked by edits."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.pattern_spans(F.coalesce("text", F.lit("")), ADDRESS)
    masks = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("[ADDRESS]").alias("text")))
    counted = token_counts.count_tokens(docs.withColumn("edits", masks)).withColumnRenamed("n_tokens", "n_before")
    edited = token_counts.apply_edits(counted.withColumn("n_tokens", F.col("n_before")))
    return edited.select("doc_id", "n_before", "n_tokens", "n_edits", "n_reencoded", F.size("token_starts").alias("n_segments"))


@query()
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class, and numbers of linked rows and texts, of every document."""
    return ngram_join.jaccard_join(read_table(spark, sf_dir, "documents")).drop("first_copy")


@query()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document with the end id, and the text they decode to, as digests."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode_pieces(docs, keep_ids=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query()
def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest other vectors of every fiftieth."""
    return nearest.nearest(read_table(spark, sf_dir, "embeddings"), every=50, k=5)


@query()
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, in 24 shards of near-equal bytes."""
    return sharding.shard(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


# Spans of one pattern: matches and the text between them, laid end to end.
_SPANS = """
{name} as (
 select doc_id, {kind} kind, m,
  list_sum(list_transform(p[:i], lambda v: length(v)))::bigint + coalesce(list_sum(list_transform(ms[:i - 1], lambda v: length(v))), 0)::bigint s
 from (select doc_id, ms, p, unnest(ms) m, generate_subscripts(ms, 1) i from (
  select doc_id, regexp_extract_all({text}, {pattern}) ms, string_split_regex({text}, {pattern}) p from texts where regexp_matches({text}, {pattern}))))"""


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets_sql() -> str:
    # RE2 has no possessive groups and no back-references, so those rules are spelled out.
    repeated = "|".join(f"[{c}]{{8}}" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
    assign = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    parts = [
        _SPANS.format(name=name, kind=kind, pattern=_sql(pattern), text=text)
        for kind, (name, pattern, text) in enumerate((("a", assign, "t"), ("k", secret_scan.ACCESS, "t"), ("h", secret_scan.HEX, "t"), ("c", secret_scan.CANDIDATE, "b")))
    ]
    blank = f"regexp_replace(coalesce(text, ''), {_sql(repeated)}, '        ', 'g')"
    for word in secret_scan.WORDS:
        blank = f"regexp_replace({blank}, '(?i){word}', '{' ' * len(word)}', 'g')"
    limits = [bits for _, bits in secret_scan.CLASSES]
    return f"""
with texts as (select doc_id, coalesce(text, '') t, {blank} b from documents), {','.join(parts)},
base as (
 select doc_id, s, kind, s + length(m) e from (
  select * from a where length(regexp_extract(m, {_sql(assign)}, 1)) >= 6 union all select * from k union all select * from h)),
cand as (
 select c.doc_id, c.s, c.m, c.s + length(c.m) e,
  case when regexp_matches(m, '^[0-9]+$|^[a-z]+$|^[A-Z]+$') then 9.0 when regexp_matches(m, '^[0-9a-fA-F]+$') then {limits[1]} when regexp_matches(m, '^[a-z0-9]+$|^[A-Z0-9]+$') then {limits[3]}
   when regexp_matches(m, '[0-9]') then {limits[4]} else {limits[5]} end lim
 from c where (regexp_matches(m, '[0-9]') or least(length(regexp_replace(m, '[^A-Z]', '', 'g')), length(regexp_replace(m, '[^a-z]', '', 'g'))) >= {secret_scan.MIXED})
  and not regexp_matches(m, {_sql(secret_scan.ALLOWED[0])}) and not regexp_matches(m, '^/?([A-Za-z]+/)+[A-Za-z]*$')
  and not exists (select 1 from base b where b.doc_id = c.doc_id and b.s < c.s + length(c.m) and c.s < b.e)),
windows as (select doc_id, s, e, lim, i, unnest(string_split(substr(m, i, {secret_scan.WINDOW}), '')) x
 from (select *, unnest(range(1, length(m) - {secret_scan.WINDOW} + 2)) i from cand where lim < 9)),
more as (
 select distinct doc_id, s, 3 kind, e from (
  select doc_id, s, e, i, lim, log2({secret_scan.WINDOW}) - sum(n * log2(n)) / {secret_scan.WINDOW} bits
  from (select doc_id, s, e, i, lim, x, count(*) n from windows group by all) group by all)
 where bits >= lim),
every as (
 select doc_id, s, kind, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || s || ':' || e span from (
  select * from base union all select * from more))
select t.doc_id, count(*) filter (kind = 0) n_assign, count(*) filter (kind = 1) n_access, count(*) filter (kind = 2) n_hex,
 sha256(coalesce(string_agg(span, ',' order by s, kind) filter (kind < 3), '')) base_sha256,
 coalesce(string_agg(span, ',' order by s, kind), '') spans
from texts t left join every using (doc_id) group by t.doc_id"""


@query(_secrets_sql())
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    found = secret_scan.find_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("base_spans")
    counts = [secret_scan.count_kind(base, i).alias(f"n_{k}") for i, k in enumerate(secret_scan.KINDS[:3])]
    digest = F.sha2(secret_scan.spelled(base), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), secret_scan.spelled(F.col("secret_spans")).alias("spans"))


@query()
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document; documents with any are contaminated."""
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    pairs = decontaminate.contaminated(docs, benchmark)
    found = pairs.groupBy(F.col("doc_id").alias("found")).agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"), F.max("lcs").alias("lcs"))
    rows = docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("found")), "left")
    items = F.coalesce("item_ids", F.array().cast("array<bigint>"))
    return rows.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"), items.alias("item_ids"), "lcs")


@query("""
with pay as (select page_id, coalesce(html, '') p from pages),
sized as (select page_id, strlen(p) n, sha256(p) d from pay),
firsts as (select d, min(page_id) f from sized where n >= 100 group by d)
select page_id, n payload_bytes, d payload_digest, case when f is null or f is not distinct from page_id then 'response' else 'revisit' end record_type,
 case when f is not null and f is distinct from page_id then f end refers_to
from (select s.*, case when n >= 100 then f end f from sized s left join firsts using (d))""")
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives."""
    path = scratch_path(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.read_archives(spark, path, offsets=False))


@query()
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, written to files of directly addressable codes and read back."""
    path = scratch_path(spark, "token-files")
    token_files.write_ids(read_table(spark, sf_dir, "documents"), path)
    return token_files.read_ids(spark, path, keep_ids=False)


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers, with the corpus-wide counts of its id pairs."""
    found = token_alignment.align_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _codes_sql(rounds: int = 2) -> str:
    # Nearest entry of each part, ties to the lower index; then the entries move, unused ones stay.
    assign = """
a{n} as materialized (select r, p, min(d * 64 + e) % 64 e, min(d * 64 + e) // 64 d from (
 select r, parts.p, e, ((x[1] - c[1]) ** 2 + (x[2] - c[2]) ** 2 + (x[3] - c[3]) ** 2 + (x[4] - c[4]) ** 2)::bigint d
 from parts join c{n} on parts.p = c{n}.p) group by r, p)"""
    move = """
c{m} as materialized (select c{n}.p, c{n}.e, coalesce(y, c) c from c{n} left join (
 select a{n}.p, a{n}.e, [floor(sum(x[1]) / count(*))::bigint, floor(sum(x[2]) / count(*))::bigint, floor(sum(x[3]) / count(*))::bigint, floor(sum(x[4]) / count(*))::bigint] y
 from a{n} join parts on parts.r = a{n}.r and parts.p = a{n}.p group by a{n}.p, a{n}.e) s on s.p = c{n}.p and s.e = c{n}.e)"""
    steps = [assign.format(n=n) + "," + move.format(n=n, m=n + 1) for n in range(rounds)] + [assign.format(n=rounds)]
    return f"""
with v as materialized (select row_number() over () r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) q from embeddings
 where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (select r, p, q[p * 4 + 1 : p * 4 + 4] x from v, range(16) t(p)),
c0 as materialized (select p, e, x c from parts join (select r, row_number() over (order by vec_id) - 1 e from v order by vec_id limit 64) using (r)),
{",".join(steps)}
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error,
 (select sha256(string_agg(c[1] || ',' || c[2] || ',' || c[3] || ',' || c[4], ',' order by p, e)) from c{rounds}) codebooks_sha256
from v join (select r, string_agg(printf('%02x', e), '' order by p) code, sum(d)::bigint error from a{rounds} group by r) using (r)"""


@query(_codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, the error of its label, and the digest of the codebooks."""
    coded, books = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    digest = F.lit(books.digest() if books else None).cast("string")
    return coded.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))
