"""URL filters by host-suffix and path-prefix expressions.

Each distinct (host, path) is expanded into its host suffixes at label
boundaries times its path prefixes of the lengths that rules have. Expressions
meet rules by an equality join on a short hash prefix; the full digest confirms
a hit, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import is_small

# Fixed values of the contract: (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
_PREFIX = 8  # hex digits of the digest that the join compares: 32 bits


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return _ascii_lower(host), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\u0000"), path), 256)


def rule_table(spark, rules=RULES) -> DataFrame:
    """(prefix, digest, rule, weight, rule_verdict) of a list of rules."""
    rows = spark.createDataFrame([tuple(r) for r in rules], "rule_verdict string, host string, path string")
    rows = rows.withColumn("host", _ascii_lower(F.col("host"))).withColumn("digest", _digest(F.col("host"), F.col("path")))
    return rows.select(
        F.substr("digest", F.lit(1), F.lit(_PREFIX)).alias("prefix"), "digest", F.concat("host", "path").alias("rule"),
        F.length(F.concat("host", "path")).alias("weight"), "rule_verdict",
    )


def judge_urls(pages: DataFrame, rules=RULES, default: str = "allow") -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains when the path starts with the rule's;
    the longest fitting rule wins (of equal length: the one with more host, then
    the smaller text). Without a rule the verdict is ``default``. Null URLs and
    those without ``://`` have an empty host and path and fit no rule. Rows
    without a page_id and repeated rows stay as they are; other columns are not read.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    lengths = sorted({len(p) for _, _, p in rules})
    suffixes = F.transform(F.sequence(F.lit(1), F.size(F.split("host", r"\."))), lambda k: F.array_join(F.slice(F.split("host", r"\."), k, F.size(F.split("host", r"\."))), "."))
    prefixes = F.array_distinct(F.array(*[F.substr("path", F.lit(1), F.lit(n)) for n in lengths]))
    expressions = (
        urls.select("host", "path")
        .distinct()
        .where("host <> ''")
        .withColumn("end", F.explode(suffixes))
        .withColumn("start", F.explode(prefixes))
        .withColumn("expression", _digest(F.col("end"), F.col("start")))
        .withColumn("prefix", F.substr("expression", F.lit(1), F.lit(_PREFIX)))
    )
    table = rule_table(spark, rules)
    near = expressions.join(F.broadcast(table) if is_small(table) else table, "prefix")
    best = (
        near.where("expression = digest")
        .groupBy("host", "path")
        .agg(F.max(F.struct("weight", F.length("end").alias("of_host"), "rule", "rule_verdict")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict"))
    )
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict")
    )
