"""URL verdicts from host-suffix and path-prefix rules.

Each distinct URL is expanded into the expressions that some rule could name: its host cut to
as many labels, and its path cut to as many characters, as a rule has.  Expressions meet rules in
an equi-join on the first 32 bits of a SHA-256 digest; the whole digest confirms a match, and of
the rules that fit the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of the hexadecimal digest on which the join is made.
PREFIX = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    """Of host and path with a sign between them that neither can hold."""
    return F.sha2(F.concat(host, F.lit("?"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has host, path and verdict.  A rule fits its host and all subdomains if the path
    starts with the rule's.  Of the fitting rules the longest (host and path together) wins, then
    the one with the longer host, then ``block`` over others, so conflicting copies of a rule
    block.  A URL that no rule fits, a null one among them, gets ``default`` and a null rule.
    Rows are kept as often as they occur; columns named like the four results are replaced.

    URLs are expanded once each however often they occur; the expressions of a URL are as many as
    the shapes (labels, path length) found among the rules, never a product of its own parts.
    The shapes are collected to the driver: a host has 127 labels at most, so they are a few
    hundred for any real list of rules.
    """
    rules = rules.select(
        F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("r_host"),
        F.coalesce("path", F.lit("")).alias("r_path"),
        F.col("verdict").alias("r_verdict"),
    ).filter("r_host != ''")
    rules = rules.withColumn("labels", F.size(F.split("r_host", r"\."))).withColumn("chars", F.length("r_path"))
    shapes = [(r.labels, r.chars) for r in rules.select("labels", "chars").distinct().collect()]
    rules = rules.select(
        _digest(F.col("r_host"), F.col("r_path")).alias("r_digest"),
        F.concat("r_host", "r_path").alias("r_rule"),
        F.length("r_host").alias("r_host_length"),
        "r_verdict",
    ).withColumn("prefix", F.substring("r_digest", 1, PREFIX))

    kept = pages.drop("host", "path", "rule", "verdict") if url not in ("host", "path", "rule", "verdict") else pages
    pages = kept.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    if not shapes:
        return pages.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    shape = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("chars")) for a, b in shapes])
    urls = pages.select("host", "path").distinct().withColumn("parts", F.split("host", r"\."))
    fits = F.filter(shape, lambda s: (F.size("parts") >= s.labels) & (F.length("path") >= s.chars))
    urls = urls.withColumn("shape", F.explode(fits)).select(
        "host",
        "path",
        _digest(
            F.concat_ws(".", F.slice("parts", F.size("parts") - F.col("shape.labels") + 1, F.col("shape.labels"))),
            F.substring(F.col("path"), F.lit(1), F.col("shape.chars")),
        ).alias("digest"),
    ).withColumn("prefix", F.substring("digest", 1, PREFIX))
    rank = F.struct(F.length("r_rule"), F.col("r_host_length"), F.col("r_verdict") == "block")
    found = (
        urls.join(rules, "prefix")
        .filter(F.col("digest") == F.col("r_digest"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("r_rule", "r_verdict"), rank).alias("best"))
        .select(F.col("host").alias("f_host"), F.col("path").alias("f_path"), "best")
    )
    return (
        pages.join(found, (F.col("host") == F.col("f_host")) & (F.col("path") == F.col("f_path")), "left")
        .withColumn("rule", F.col("best.r_rule"))
        .withColumn("verdict", F.coalesce(F.col("best.r_verdict"), F.lit(default)))
        .drop("f_host", "f_path", "best")
    )
