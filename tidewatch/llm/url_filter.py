"""URL filters: host-suffix and path-prefix expressions joined to rules by short hashes.

A url is expanded into one expression for every suffix of its host at a dot and every
prefix of its path that is as long as some rule's path.  Expressions meet rules by an
equality join on the first bytes of a digest; what meets is confirmed by the whole digest, in a
condition that Spark cannot make a join key of.  Of the rules that fit, the longest wins.

Work is done once for each distinct (host, path), so a host with a third of all urls
costs no more than its distinct paths; the answers are joined back.

Defined cases: a url that is null or has no ``://`` has an empty host and path; rules with
a null host or path are left out; of rules equally long the longer host wins, then
``block``; pages that repeat stay repeated; other columns of pages are untouched and the
operator's own (host, path, rule, verdict) replace theirs; no rules leave the default; a url of
any length is expanded whole, into one expression a host label and length of a rule's path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of a digest that make the join key.
PREFIX_DIGITS = 8


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column, empty where there is none."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)([^?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))
    return F.translate(rest, UPPER, LOWER), path


def _expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def expressions(urls: DataFrame, path_lengths: Column) -> DataFrame:
    """``(host, path, digest)`` for every host suffix and every path prefix of the given lengths."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return (urls.withColumn("_length", F.explode(path_lengths)).where(F.col("_length") <= F.length("path"))
            .withColumn("_suffix", F.explode(suffixes))
            .select("host", "path", _expression(F.col("_suffix"), F.substr("path", F.lit(1), F.col("_length"))).alias("digest")))


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the winner, or null) and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``; a rule fits its host and all
    subdomains where the url's path starts with the rule's.
    """
    host, path = parts(F.col(url).cast("string"))
    known = (rules.where("host is not null and path is not null")
             .select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
             .groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("rule_verdict"))          # 'block' > 'allow'
             .withColumn("rule_digest", _expression(F.col("rule_host"), F.col("rule_path")))
             .withColumn("rule_key", F.substring("rule_digest", 1, PREFIX_DIGITS)))
    lengths = known.agg(F.coalesce(F.collect_set(F.length("rule_path")), F.array().cast("array<int>"))).scalar()
    work = pages.drop("host", "path", "rule", "verdict").withColumn("host", host).withColumn("path", path)
    distinct = work.select("host", "path").distinct()
    tried = expressions(distinct, lengths).withColumn("key", F.substring("digest", 1, PREFIX_DIGITS))
    confirmed = tried.digest.between(known.rule_digest, known.rule_digest)                          # equal, but no key
    hits = tried.join(known, (tried.key == known.rule_key) & confirmed)
    rule = F.concat("rule_host", "rule_path")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(
        F.length(rule).alias("n"), F.length("rule_host").alias("h"), F.col("rule_verdict").alias("verdict"), rule.alias("rule"))).alias("_w"))
    return (work.join(best, ["host", "path"], "left")
            .withColumn("rule", F.col("_w.rule")).withColumn("verdict", F.coalesce("_w.verdict", F.lit(default))).drop("_w"))
