"""URL filtering by host and path rules, in DataFrame operations only.

Every URL is expanded into expressions, a suffix of its host followed by a prefix of its path;
expressions and rules meet on the first 32 bits of their SHA-256, the full digests then decide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Host, path and verdict of the rules that the registered query applies.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://``. Only A-Z of the host is lower-cased."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``expression, verdict, digest, prefix`` of rules; of equal rules the blocking one holds."""
    for host, path, verdict in rules:
        if not host or not path.startswith("/") or not path.endswith("/") or verdict not in ("allow", "block"):
            raise ValueError(f"not a rule: {(host, path, verdict)}")
    rows = spark.createDataFrame([(h, p, v) for h, p, v in rules], "host string, path string, verdict string")
    rows = rows.select(F.concat(F.translate("host", _UPPER, _LOWER), "path").alias("expression"), "verdict")
    return with_digest(rows.groupBy("expression").agg(F.max("verdict").alias("verdict")))


def with_digest(rows: DataFrame) -> DataFrame:
    digest = F.sha2("expression", 256)
    return rows.withColumn("digest", digest).withColumn("prefix", F.substring("digest", 1, 8))


def expressions(host: Column, path: Column, labels: int, depth: int) -> Column:
    """All host suffixes of at most ``labels`` labels with all path prefixes of at most ``depth`` slashes."""
    names, parts = F.split(host, "\\."), F.split(path, "/")
    low = F.greatest(F.lit(1), F.size(names) - labels + 1)
    hosts = F.transform(F.sequence(low, F.size(names)), lambda i: F.array_join(F.slice(names, i, F.size(names)), "."))
    high = F.least(F.lit(depth), F.size(parts) - 1)
    paths = F.when(high >= 1, F.transform(F.sequence(F.lit(1), F.greatest(high, F.lit(1))), lambda j: F.concat(F.array_join(F.slice(parts, 1, j), "/"), F.lit("/"))))
    pairs = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))
    return F.when((host != "") & (high >= 1), pairs)


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict``.

    A rule (host, path, verdict) fits its host and all subdomains if the URL's path starts with
    the rule's, which begins and ends with a slash; the longest rule that fits decides, of equal
    length the blocking one, then the greater text. Without any, ``rule`` is null and ``verdict`` is ``default``. A null
    URL, or one without ``://``, has an empty host and path and fits no rule. Ids may be null or
    repeated. Expansion goes no further than the rules' own labels and slashes, so a long URL
    makes no more expressions than a short one, and none is lost. Other columns are not read.
    """
    if default not in ("allow", "block"):
        raise ValueError("the default is allow or block")
    host, path = url_parts(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    labels = max((r[0].count(".") + 1 for r in rules), default=1)
    depth = max((r[1].count("/") for r in rules), default=1)
    # Each different place once: what decides is the host and the start of the path.
    start = F.array_join(F.slice(F.split("path", "/"), 1, depth), "/")
    slashes = F.size(F.split("path", "/")) - 1
    near = F.when(slashes >= depth, F.concat(start, F.lit("/"))).otherwise(F.col("path"))
    rows = rows.withColumn("near", near)
    places = rows.select("host", "near").filter("host <> '' and near <> ''").distinct()
    spread = places.select("host", "near", F.explode(expressions(F.col("host"), F.col("near"), labels, depth)).alias("expression"))
    known = rule_table(pages.sparkSession, rules).withColumnsRenamed({"expression": "rule", "digest": "full"})
    met = with_digest(spread).join(known, "prefix").filter("digest = full")
    best = met.groupBy("host", "near").agg(F.max(F.struct(F.length("rule").alias("n"), "verdict", "rule")).alias("best"))
    judged = rows.join(best, ["host", "near"], "left")
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
