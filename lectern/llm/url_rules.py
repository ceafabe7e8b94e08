"""URL filter: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over ``host || path`` together with the literal tokens that any URL it fits must
contain. A rule is filed under one of them, the one that the fewest URLs hold. The tokens of a URL fetch the rules
filed under them and only those run their regular expression; the fitting rule of largest weight decides.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and gets the default
verdict; repeated rows stay, one result each; an empty table gives an empty result; equal weights are decided by the
larger rule text; columns of the input beyond ``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# The rules (host and path prefix) and their verdicts.
PAGE_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

RULE_SCHEMA = "rule string, verdict string, weight int, pattern string, tokens array<string>"


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def host_rule(rule: str, verdict: str) -> tuple:
    """Compile ``host/path-prefix``: the host and its subdomains, paths that start with the prefix.

    Only tokens closed on both sides inside the rule are literal: an open end (``a.com/de``) may be longer in the URL.
    """
    host, slash, rest = rule.partition("/")
    closed = re.findall(r"[A-Za-z0-9]+(?=[^A-Za-z0-9])", f"{host}{slash or '/'}{rest}")
    pattern = rf"(?s)\A(?:[^/]*\.)?{re.escape(host)}{re.escape('/' + rest)}"
    return rule, verdict, len(rule), pattern, closed


def rule_table(spark: SparkSession, rules: Sequence[tuple]) -> DataFrame:
    """Rules as a DataFrame; further pattern rules may be unioned to it."""
    return spark.createDataFrame([host_rule(*r) for r in rules], RULE_SCHEMA)


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct runs of letters and digits; the empty token stands for rules without a literal one."""
    return F.array_union(F.array_distinct(F.split(F.concat(host, path), "[^A-Za-z0-9]+", -1)), F.array(F.lit("")))


def index_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """File each rule under the one of its tokens that the fewest rows of ``tokens`` (column ``token``) hold."""
    each = rules.select("rule", F.explode(F.when(F.size("tokens") > 0, F.col("tokens"))
                                          .otherwise(F.array(F.lit("")))).alias("token")).distinct()
    held = tokens.join(each.select("token").distinct(), "token", "left_semi").groupBy("token").agg(
        F.count("*").alias("n"))
    filed = each.join(held, "token", "left").groupBy("rule").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best"))
    return rules.join(filed, "rule").select("rule", "verdict", "weight", "pattern", F.col("best.token").alias("token"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id",
               url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict), one row for every row of ``pages``."""
    parts = pages.select(F.col(key).alias("_key"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    parts = parts.withColumn("_row", F.monotonically_increasing_id())
    each = parts.withColumn("token", F.explode(url_tokens(F.col("host"), F.col("path"))))
    index = index_rules(rules, each.select("token"))
    fits = F.regexp_like(F.concat("host", "path"), F.col("pattern"))
    # The scan's row number groups the candidates: no page, host or token gathers rows of others.
    best = each.join(index, "token", "left").groupBy("_row").agg(
        F.first("_key").alias(key), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max(F.when(fits, F.struct("weight", "rule", "verdict"))).alias("best"))
    return best.select(key, "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
