"""URL filter by hashed host-suffix / path-prefix expressions.

Every URL is expanded into expressions: each suffix of its host's labels with
each path prefix of a length some rule of that host has.  Expressions and rules
meet in two equi-joins, first on a short prefix of the SHA-256 of the host
expression, then on a short prefix of the digest of the whole expression; a
row counts only if the full digests agree.  Of a URL's rules the longest wins
(on equal length the longer host, then block before allow).

The first join tells a URL the path lengths worth expanding, so a URL yields
one row per (suffix, rule length) of hosts that have rules at all, not one per
path prefix.  Everything is JVM-side DataFrame code.  Distinct host/path pairs
are judged once: hot URLs and hosts are collapsed by a partial aggregate before
any join, and the verdicts return by one join on the pair, which adaptive
execution splits where one pair holds many pages.

Defined cases: host is what stands after the first ``://`` up to ``/``, ``?``,
``#`` or the end, A-Z lower-cased; path follows up to ``?`` or ``#``; NULL or
no ``://`` gives empty host and path, no rule and the default verdict.  Rules
with NULL host or path are ignored, repeated rules count once; empty tables
give empty results (no rules: the default verdict everywhere).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the digest that the equi-joins use.
SHORT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def host_suffixes(host: Column) -> Column:
    """All suffixes of a host at label borders, the host itself first."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``host`` (no leading dot), ``path`` (with its leading slash)
    and ``verdict`` (``allow`` or ``block``)."""
    rules = (rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
             .select(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), "verdict")
             .groupBy("r_host", "r_path").agg(F.max("verdict").alias("r_verdict")))     # block before allow
    by_host = (rules.groupBy("r_host").agg(F.collect_set(F.length("r_path")).alias("lengths"))
               .select(_digest(F.col("r_host")).alias("r_full"), "lengths")
               .withColumn("short", F.substring("r_full", 1, SHORT)))
    by_rule = (rules.withColumn("r_full", _digest(F.concat("r_host", "r_path")))
               .withColumn("short", F.substring("r_full", 1, SHORT)))

    urls = pages.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"),
                        url_path(F.col(url_col)).alias("path"))
    distinct = urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    hosts = (distinct.where("host <> ''")
             .select("host", "path", F.explode(host_suffixes(F.col("host"))).alias("suffix"))
             .withColumn("full", _digest(F.col("suffix"))).withColumn("short", F.substring("full", 1, SHORT)))
    known = (hosts.join(by_host, "short").where("full = r_full")
             .select("host", "path", "suffix", F.explode("lengths").alias("upto"))
             .where("upto <= length(path)"))
    expressions = (known.withColumn("full", _digest(F.expr("concat(suffix, substring(path, 1, upto))")))
                   .withColumn("short", F.substring("full", 1, SHORT)))
    best = F.struct(F.expr("length(r_host) + length(r_path)").alias("all"), F.length("r_host").alias("of_host"),
                    F.col("r_verdict").alias("verdict"), F.concat("r_host", "r_path").alias("rule"))
    won = (expressions.join(by_rule, "short").where("full = r_full")
           .groupBy("host", "path").agg(F.max(best).alias("won")))
    return (urls.join(won, ["host", "path"], "left")
            .select(F.col("id").alias(id_col), "host", "path", F.col("won.rule").alias("rule"),
                    F.coalesce("won.verdict", F.lit(default)).alias("verdict")))
