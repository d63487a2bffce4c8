"""URL filter: host-suffix / path-prefix expressions against a rule list.

A rule is (action, host, path) with action ``allow`` or ``block``; it fits a URL whose
host is the rule's host or a subdomain of it and whose path starts with the rule's path.
Of several fitting rules the longest (host and path) wins; ``block`` wins a tie.

Each URL is expanded to the expressions <host suffix><directory prefix of the path>, for
every suffix of whole labels and every prefix that ends in "/" (none is left out, however
long the URL). Expressions meet rules in an equi-join on the first 32 bits of their
SHA-256; full digests and the rest of the path are compared after it. A rule whose path
does not end in "/" is looked up by its directory, and confirmed by the comparison. Only
hosts and paths, each pair once, are expanded and joined; the pages get the result by them.

Edge cases: a null URL, or one without "://", has an empty host and path and gets the
default verdict; an empty rule list gives the default to all; rows that are equal stay
separate rows; further columns of the input pass through in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

PREFIX_HEX = 8
RULE_SCHEMA = "action string, host string, path string"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) as plain text; both empty when there is no "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def expressions(host: Column, path: Column) -> Column:
    """array<string> of every host suffix joined to every directory prefix of the path."""
    labels, parts = F.split(host, r"\."), F.split(path, "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    # The last part follows the last "/", so it is no directory; without "/" there is no prefix.
    n = F.size(parts) - 1
    prefixes = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                         lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")))
                      ).otherwise(F.array().cast("array<string>"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))))


def hashed_rules(rules: DataFrame) -> DataFrame:
    key = F.concat("host", F.regexp_extract("path", r"^(.*/)", 1))
    return rules.select(
        F.concat("host", "path").alias("rule"), "action", F.col("path").alias("rule_path"),
        (F.length("host") + F.length("path")).alias("rule_length"), F.sha2(key, 256).alias("rule_digest"),
        F.substring(F.sha2(key, 256), 1, PREFIX_HEX).alias("prefix"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: ``row`` (struct of its columns), host, path, rule, verdict."""
    host, path = url_parts(F.col(url))
    urls = pages.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    # Narrow rows meet the rules: each host and path once, without the rest of the page.
    exprs = urls.select("host", "path").distinct().select("host", "path", F.explode(expressions(F.col("host"), F.col("path"))).alias("expression"))
    exprs = exprs.select("host", "path", F.sha2("expression", 256).alias("digest"))
    met = exprs.withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)).join(hashed_rules(rules), "prefix")
    fits = met.where((F.col("digest") == F.col("rule_digest")) & F.startswith("path", F.col("rule_path")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        "rule_length", (F.col("action") == "block").alias("blocks"), "rule", "action")).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "row", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
