"""URL rules by host suffix and path prefix: equi-join on short hash prefixes, full digests decide.

Every different (host, path) is expanded into host suffixes times path prefixes, as lists of
unsafe addresses are looked up: the first four bytes of an expression's SHA-256 find candidates by
an equi-join, the whole digest confirms them, and the longest rule that fits wins. Prefixes are
taken at the lengths that occur among the rules, so that a rule's path may end anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.workspace import materialize

HASH_BYTES = 4
# Upper and lower case of the ASCII letters.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The part after the first ``://`` up to ``/``, ``?``, ``#``, A-Z lower-cased; then the path.

    Both are empty for a null url or one without ``://``.
    """
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return host, path


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules ``host, path, verdict`` with their text, digest and hash prefix, one row per (host, path).

    Hosts are lower-cased; null hosts or paths are left out. Of rules with equal host and path
    those that block win.
    """
    host, path = F.translate("host", _UPPER, _LOWER), F.col("path")
    named = rules.select(host.alias("host"), path.alias("path"), "verdict")
    named = named.where("host is not null and path is not null")
    named = named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    digest = F.sha2(F.concat_ws("\u0000", "host", "path"), 256)
    return named.select(
        "host",
        "path",
        "verdict",
        F.concat("host", "path").alias("rule"),
        F.octet_length("path").alias("path_bytes"),
        digest.alias("digest"),
        F.substring(digest, 1, 2 * HASH_BYTES).alias("short"),
    )


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    A rule fits its host and all subdomains if the url's path starts with the rule's. The rule with
    the longest text wins; among equally long ones the longest host, then "block". Where no rule
    fits, ``rule`` is null and ``verdict`` the default; this is so for null urls and urls without
    ``://``, whose host and path are empty. Rows that repeat an id are judged each by itself. Other
    columns are not looked at. Empty tables of pages or rules give no rows or no rule.

    Only different (host, path) pairs are expanded, so a frequent url costs one expansion. Rules are
    written first: if they are small, Spark broadcasts them by their true size, else both sides are
    shuffled by the short hash.
    """
    host, path = host_and_path(F.col(url_col))
    given = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    listed = materialize(rule_table(rules), "url_rules")
    lengths = listed.agg(F.collect_set("path_bytes")).scalar()

    places = given.where("host <> ''").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    first = F.explode(F.sequence(F.lit(1), F.size(labels)))
    suffixes = places.select("host", "path", labels.alias("labels"), first.alias("first"))
    suffix = F.array_join(F.slice("labels", F.col("first"), F.size("labels")), ".")
    raw = F.col("path").cast("binary")
    tried = suffixes.select("host", "path", suffix.alias("suffix"), lengths.alias("lengths"))
    tried = tried.select("host", "path", "suffix", F.explode("lengths").alias("bytes"))
    tried = tried.where(F.col("bytes") <= F.octet_length(raw))
    prefix = F.substring(raw, F.lit(1), F.col("bytes")).cast("string")
    digest = F.sha2(F.concat_ws("\u0000", "suffix", prefix), 256)
    tried = tried.select("host", "path", digest.alias("full"), F.substring(digest, 1, 2 * HASH_BYTES).alias("short"))
    rule = listed.select("short", "digest", "rule", "verdict", F.length("host").alias("host_length"))
    met = tried.join(rule, "short").where(F.col("full") == F.col("digest"))
    order = F.struct(F.length("rule"), "host_length", F.col("verdict") == "block")
    best = met.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    out = given.join(best, ["host", "path"], "left")
    return out.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
