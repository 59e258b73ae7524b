"""URL allow and block lists by host suffix and path prefix.

Every URL is expanded into expressions ``host suffix + path prefix``. The rules
are found by an equi-join on the first digits of the expressions' SHA-256, then
confirmed by the full digest; among the rules that fit the longest wins. Only
suffixes and prefixes of lengths that some rule has are made, so the expansion
is exact for any rule, and its size follows the rules and not the URL.

Built-in functions only. The rule side has no hint: Spark broadcasts it below
its own size limit and else shuffles, where the adaptive join can split common
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the digest that the join compares.
SHORT = 8


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",),
               default: str = "allow") -> DataFrame:
    """``keep`` columns, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``; one row per row of ``urls``.

    ``rules``: ``host, path, action``. A rule fits its host and all subdomains if
    the path starts with the rule's. The longest rule wins; of equally long ones
    that with the longer host, then ``block``. Rules with a missing or empty host
    or a missing action are left out, a missing rule path is empty. A missing URL
    or one without ``://`` has empty host and path, fits no rule and gets
    ``default``. Repeated rows stay repeated; other columns of either frame are
    not read, whatever their names. Without rules every URL gets ``default``.
    """
    known = (rules.where((F.coalesce(F.length("host"), F.lit(0)) > 0) & F.col("action").isNotNull())
             .select(F.lower("host").alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "action")
             .distinct())
    shape = known.agg(
        F.collect_set(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.collect_set(F.length("rule_path")).alias("lengths")).first()
    labels, lengths = sorted(shape["labels"]) or [1], sorted(shape["lengths"]) or [0]

    fitting = known.select(
        F.sha2(F.concat("rule_host", "rule_path"), 256).alias("digest"),
        F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("size"),
            F.length("rule_host").alias("host_size"),
            (F.col("action") == "block").alias("blocks"),
            F.concat("rule_host", "rule_path").alias("rule"),
            F.col("action").alias("action")).alias("found"))
    fitting = fitting.groupBy("digest").agg(F.max("found").alias("found")).withColumn(
        "short", F.left("digest", F.lit(SHORT)))

    rows = urls.select(
        F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)],
        url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    names_of = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(F.array(*map(F.lit, labels)), lambda n: (n <= F.size(names_of)) & (F.length("host") > 0)),
        lambda n: F.array_join(F.slice(names_of, -n, n), "."))
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n))
    digests = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.sha2(F.concat(h, p), 256))))
    names = [f"keep_{i}" for i in range(len(keep))]
    asked = rows.select("row", *names, "host", "path", F.explode_outer(digests).alias("asked")).withColumn(
        "short", F.left("asked", F.lit(SHORT)))
    joined = asked.join(fitting, "short", "left")
    best = joined.groupBy("row", *names, "host", "path").agg(
        F.max(F.when(F.col("asked") == F.col("digest"), F.col("found"))).alias("best"))
    return best.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"))
