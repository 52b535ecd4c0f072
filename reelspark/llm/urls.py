"""URL rules by host suffix and path prefix, looked up through short hash prefixes.

Every distinct (host, path) is expanded into the expressions that a rule could have: the
host's suffixes at its dots and the path's prefixes. The short hash prefix of each
expression is joined with those of the rules, an equi-join; the full digest confirms a
hit, and of several rules the longest decides.

Only suffixes and prefixes of a length that some rule has are made, so their number
depends on the rules, not on the url. Equal urls are judged once.

Defined cases: null urls and urls without ``://`` have an empty host and path, fit no
rule and get the default verdict; an empty rule table leaves all to the default; of two
rules with the same host and path "block" counts; null or repeated page ids and repeated
rows keep a row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.operators.spread import lookup_join

#: (verdict, host, path)
Rule = tuple[str, str, str]

RULES: tuple[Rule, ...] = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DEFAULT = "allow"
#: Hex digits of the digest that the join compares.
PREFIX = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def prepared(rules: DataFrame) -> DataFrame:
    """One row per rule expression, with its digest and what it takes to meet it."""
    rules = rules.where("host is not null and path is not null and verdict is not null")
    one = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    digest = _digest(F.col("host"), F.col("path"))
    return one.select(
        F.concat("host", "path").alias("rule"),
        "verdict",
        digest.alias("_full"),
        F.left(digest, F.lit(PREFIX)).alias("_short"),
        F.size(F.split("host", r"\.")).alias("_labels"),
        F.length("path").alias("_path"),
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule and verdict of every row."""
    rules = prepared(rules)
    rows = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    # the distinct lengths of rules: at most as many as a host has labels and a path characters
    shapes = [(r["_labels"], r["_path"]) for r in rules.select("_labels", "_path").distinct().collect()]
    distinct = rows.where("host != ''").groupBy("host", "path").agg(F.count("*").alias("_rows"))
    labels = F.split("host", r"\.")

    def expression(n: int, m: int) -> Column:
        suffix = F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), F.lit(n)), ".")
        fits = (F.size(labels) >= n) & (F.length("path") >= m)
        return F.when(fits, F.struct(suffix.alias("h"), F.left("path", F.lit(m)).alias("p")))

    if not shapes:
        return rows.select(
            "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
        )
    expanded = distinct.select("host", "path", F.explode(F.array(*(expression(*s) for s in shapes))).alias("e"))
    expanded = expanded.where("e is not null")
    expanded = expanded.withColumn("_digest", _digest(F.col("e.h"), F.col("e.p")))
    expanded = expanded.withColumn("_short", F.left("_digest", F.lit(PREFIX)))
    hits = lookup_join(expanded, rules, ["_short"]).where("_digest = _full")
    rank = F.struct(F.length("rule"), "_path", "rule")
    best = hits.groupBy("host", "path").agg(
        F.max_by("rule", rank).alias("rule"), F.max_by("verdict", rank).alias("verdict")
    )
    return lookup_join(rows, best, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
