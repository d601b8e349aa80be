"""URL verdicts from rules and a list of URLs, with a blocked Bloom filter ahead of an exact join. SQL expressions only.

Rules and listed URLs are keys of one table. A URL's possible keys are looked up in a filter over it, and the few that
pass are joined with the table, which removes the false ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.bloom import possible

def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of ``url``; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, pattern, 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(text, pattern, 2)


def canonical(host: Column, path: Column) -> Column:
    """One spelling of a page's address: no scheme, no ``www.``, no default port, no trailing slash, query or fragment."""
    return F.concat(F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), ":(80|443)$", ""), F.regexp_replace(path, "/+$", ""))


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``, in place of columns so named.

    ``rules`` holds (host, path, verdict), one verdict for each host and path. A rule fits its host and all subdomains
    if the path begins with its own; the longest wins, of equally long ones that with the longer host. Without a rule,
    a URL whose canonical form is among ``listed`` (url) is blocked and any other, null included, is allowed. Repeated
    rows stay, and so do rows with equal URLs, however many; empty rules or lists fit nothing.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    seen = pages.select(F.col(f"`{url}`").alias("url")).filter("url is not null").distinct()
    seen = seen.select("url", *[c.alias(n) for c, n in zip(host_and_path(F.col("url")), ("host", "path"))])
    rule_text = F.concat("host", "path")
    rule_keys = rules.select(F.concat(F.lit("rule "), "host", F.lit(" "), "path").alias("key"), rule_text.alias("rule"), "verdict", (F.length(rule_text) * 4096 + F.length("host")).alias("rank"))
    list_host, list_path = host_and_path(F.col("url"))
    list_keys = listed.filter("url is not null").select(F.concat(F.lit("url "), canonical(list_host, list_path)).alias("key")).distinct()
    keys = rule_keys.unionByName(list_keys.select("key", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict"), F.lit(-1).alias("rank")))
    # As many different lengths as rule paths have, which the length of a URL bounds.
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().orderBy(F.length("path")).collect()]
    labels = F.size(F.split("host", r"\."))
    suffixes = F.transform(F.sequence(F.lit(1), labels), lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))

    def prefixed(n: int) -> Column:
        """Keys of every suffix of the host with the first ``n`` characters of the path, where it has so many."""
        return F.transform(suffixes, lambda s: F.when((F.length("path") >= n) & (s != ""), F.concat(F.lit("rule "), s, F.lit(" "), F.substring("path", 1, n))))

    asked = F.array_compact(F.concat(F.array(F.concat(F.lit("url "), canonical(F.col("host"), F.col("path")))), *map(prefixed, lengths)))
    probes = seen.select("url", F.explode(F.array_distinct(asked)).alias("key"))
    hits = possible(probes, "key", keys.select("key"), keys.count()).join(keys, "key")
    best = hits.groupBy("url").agg(F.max(F.struct("rank", "rule", "verdict")).alias("b")).select(F.col("url").alias("__url"), "b.rule", "b.verdict")
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
    out = rows.join(best, rows[url] == best["__url"], "left")
    return out.select(*[F.col(f"`{c}`") for c in kept], "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
