"""URL rules: host suffixes and path prefixes of each URL, joined to the rules on short hash prefixes.

A rule (host, path, verdict) fits its host and all subdomains when the URL's path starts with the rule's. URLs are expanded into
(host suffix at a dot) x (path prefix at a slash); a rule is keyed by its host and its path up to the last slash. Both sides carry
the SHA-256 of the key; they are joined on its first four bytes alone, and each pair then confirms the whole digest and the rest of
the rule's path. The longest rule wins (host and path together), then the longer host, then block.

Only as many labels and slashes are expanded as some rule has, so long hosts and paths stay cheap and nothing is missed. Equal
URLs are judged once. Rules that measure small are broadcast; a larger list is shuffled, and a key that many URLs share is then split by
the adaptive skew join, as both sides come straight from an exchange. Pages meet the verdicts by a digest of host and path;
the few that more than a thousandth of all pages share, less than a thousand, are broadcast.

Defined results: a null url or one without ``://`` has an empty host and path and fits no rule; no rule means ``allow``; rules
with a null host are ignored, a null path is the empty path; repeated rows stay; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.sizing import broadcast_if_small
from .common import join_by_count, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DEFAULT = "allow"
PREFIX_HEX = 8


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host up to ``/``, ``?``, ``#`` or the end in lower case, path up to ``?``, ``#`` or the end."""
    mark = F.locate("://", F.col(url))
    rest = F.when(mark > 0, F.substr(F.col(url), mark + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def keyed_rules(rules: DataFrame) -> DataFrame:
    """Rules with their key: digest of host and path up to the last slash, and its first bytes."""
    path = F.coalesce("path", F.lit(""))
    rules = rules.where(F.col("host").isNotNull()).select("host", path.alias("path"), "verdict").distinct()
    digest = _digest(F.col("host"), F.regexp_extract("path", "^(?s:.*)/", 0))
    return rules.select(
        F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"),
        digest.alias("r_digest"), F.substring(digest, 1, PREFIX_HEX).alias("r_short"),
    )


def expressions(sites: DataFrame, labels: int, slashes: int) -> DataFrame:
    """Rows of (host, path) with every suffix and prefix up to so many labels and slashes, as digest and short hash."""
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda k: F.array_join(F.slice(parts, -k, k), "."),
    )
    steps = F.split("path", "/")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(steps) - 1, F.lit(slashes))),
        lambda k: F.when(k == 0, "").otherwise(F.concat(F.array_join(F.slice(steps, 1, k), "/"), F.lit("/"))),
    )
    about = [c for c in sites.columns if c != "host"]
    rows = sites.select(*about, F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
    rows = rows.select(*about, F.explode("prefixes").alias("prefix"), "suffix")
    digest = _digest(F.col("suffix"), F.col("prefix"))
    return rows.select(*about, digest.alias("digest"), F.substring(digest, 1, PREFIX_HEX).alias("short"))


def best_rules(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """d_key and d_n of every row of ``sites`` (d_key, host, path, d_n) with its winning rule and verdict, null without one."""
    keyed = keyed_rules(rules)
    # Two numbers: how deep the rules go.
    depth = keyed.agg(
        F.max(F.size(F.split("r_host", r"\."))).alias("labels"), F.max(F.size(F.split("r_path", "/")) - 1).alias("slashes")
    ).first()
    keyed, _ = broadcast_if_small(keyed)
    # Digests have one length, so one that starts with the other equals it; written as an equality it would become a join key.
    fits = F.startswith("digest", "r_digest") & F.startswith("path", "r_path")
    found = expressions(sites, depth["labels"] or 1, depth["slashes"] or 0)
    found = found.join(keyed, (F.col("short") == F.col("r_short")) & fits, "left")
    rank = F.struct(
        F.length(F.concat("r_host", "r_path")), F.length("r_host"), F.col("r_verdict") == "block",
        F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"),
    )
    best = found.groupBy("d_key", "d_n").agg(F.max(F.when(F.col("r_host").isNotNull(), rank)).alias("best"))
    return best.select("d_key", "d_n", "best.rule", "best.verdict")


def url_verdicts(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Every row of ``pages`` with host, path, the winning rule as text (null without one) and the verdict."""
    host, path = host_and_path("url")
    judged = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    site = F.unhex(_digest(F.col("host"), F.col("path")))
    sites = judged.groupBy("host", "path").agg(F.count(F.lit(1)).alias("d_n"))
    sites = stored(sites.select(site.alias("d_key"), "host", "path", "d_n"), "sites")
    total = sites.agg(F.sum("d_n")).first()[0] or 0
    joined = join_by_count(judged, site, best_rules(sites, rules), total)
    return joined.withColumn("verdict", F.coalesce("verdict", F.lit(DEFAULT)))
