"""Operator 8: URL filters by hashed host-suffix and path-prefix expressions.

Each distinct (host, path) of the input expands into its host suffixes (label by
label) times its path prefixes (directory by directory).  A rule is filed under the
expression of its host and the directory part of its path.  The two sides meet in an
equi-join on the first bytes of the expressions' SHA-256; the full digest and the
rule's whole path then confirm a hit.  Of the rules that fit a URL the longest wins;
among rules of one length the one with the longer host, then ``block`` before
``allow``.

Only distinct (host, path) pairs expand, and they carry no page content.  The rules
join by their measured size: broadcast where Spark finds them small, otherwise a
shuffled join whose hot suffixes (``com/``) Spark splits.

Defined results: a null URL, or one without ``://``, has an empty host and path and
no rule; a URL without a rule gets ``default``; repeated pages are judged alike; an
empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT = "allow"
PREFIX_HEX = 8

# The rules of the query, (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def _lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return _lower_ascii(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """``a.b.c`` -> ``a.b.c``, ``b.c``, ``c``."""
    labels = F.split(host, "\\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def path_prefixes(path: Column) -> Column:
    """``/a/b.html`` -> ``/``, ``/a/``; an empty path has none."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.transform(
        F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))))


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")


def _hashed(df: DataFrame, expression: Column) -> DataFrame:
    digest = F.sha2(expression, 256)
    return df.withColumn("digest", digest).withColumn("short", F.substring("digest", 1, PREFIX_HEX))


def judge_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
               default: str = DEFAULT) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``rules`` has ``rule_host, rule_path, rule_verdict``; a rule without a host or
    without a path that starts with ``/`` fits nothing.
    """
    url = F.col(url_col).cast("string")
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    # the rule's directory: its path up to the last slash
    anchored = _hashed(
        rules.select(_lower_ascii(F.col("rule_host")).alias("rule_host"), "rule_path", "rule_verdict")
        .where((F.col("rule_host") != "") & F.col("rule_path").startswith("/")),
        F.concat("rule_host", F.regexp_extract("rule_path", "(?s)^(.*/)", 1)))
    pairs = parsed.select("host", "path").where((F.col("host") != "") & (F.col("path") != "")).distinct()
    spread = (pairs.withColumn("suffix", F.explode(host_suffixes(F.col("host"))))
              .withColumn("prefix", F.explode(path_prefixes(F.col("path")))))
    spread = _hashed(spread, F.concat("suffix", "prefix"))
    hits = (spread.alias("u").join(anchored.alias("r"), F.col("u.short") == F.col("r.short"))
            .where((F.col("u.digest") == F.col("r.digest")) & F.col("path").startswith(F.col("rule_path"))))
    rule = F.concat("rule_host", "rule_path")
    best = (hits.groupBy("host", "path")
            .agg(F.max(F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("h"),
                                (F.col("rule_verdict") == "block").alias("b"), rule.alias("rule"),
                                F.col("rule_verdict").alias("verdict"))).alias("best")))
    found = best.select(F.col("host").alias("h"), F.col("path").alias("p"), "best")
    return (parsed.join(found, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def _values_sql() -> str:
    return ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)


URL_SQL = f"""
WITH u AS (
  SELECT page_id, row_number() OVER () AS r,
         translate(regexp_extract(COALESCE(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(COALESCE(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
t(h, p, v) AS (VALUES {_values_sql()}),
f AS (
  SELECT u.r, arg_max(h || p, (length(h || p), length(h), v = 'block')) AS rule,
         arg_max(v, (length(h || p), length(h), v = 'block')) AS verdict
  FROM u JOIN t ON (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(u.path, p)
  GROUP BY u.r)
SELECT page_id, host, path, rule, COALESCE(verdict, '{DEFAULT}') AS verdict
FROM u LEFT JOIN f USING (r)
"""
