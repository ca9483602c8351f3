"""URL filters: rules for hosts and paths, found by a sorted sweep over intervals of keys.

A host is written backwards, label by label, so a rule's host and all its subdomains
are one interval of keys, and so are all paths with a rule's path in front. Intervals
of one kind are nested or apart. The sweep goes through keys and interval starts in
order; each start carries the stack of rules that are open there, innermost on top,
and a key keeps those of the last stack that have not ended. The first sweep finds the
rule hosts open at each host, the second the innermost path below each of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sampling import unused
from tidemark.llm.sweep import latest_mark
from tidemark.session import write_through


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    """``www.example.org`` as ``org.example.www.``; an empty host as ``.``."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _stacks(rules: DataFrame, key: str, heads: Column) -> DataFrame:
    """(key, mark): each key with all keys that begin it, longest first. ``heads`` are its beginnings."""
    keys = rules.select(key).distinct()
    return (
        keys.select(F.col(key), F.explode(heads).alias("head"))
        .join(keys.select(F.col(key).alias("head")), "head")
        .groupBy(key)
        .agg(F.collect_list("head").alias("open"))
        .select(key, F.array_sort("open", lambda a, b: F.length(b) - F.length(a)).alias("mark"))
    )


def match_rules(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """(url, host, path, rule, verdict) for every distinct url; see ``judge_urls``."""
    rules = (
        rules.filter("host IS NOT NULL AND verdict IS NOT NULL")
        .select(
            F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            "verdict",
        )
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("hkey", reversed_host(F.col("host")))
        .withColumn("pkey", F.concat("hkey", F.lit("#"), "path"))
    )
    urls = pages.select(F.col(f"`{url}`").alias("url")).distinct().select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    places = urls.select("host", "path").distinct().withColumn("hkey", reversed_host(F.col("host")))
    labels = F.expr(
        "transform(sequence(1, size(split(hkey, '[.]')) - 1), k -> concat(substring_index(hkey, '.', k), '.'))"
    )
    open_hosts = latest_mark(places, _stacks(rules, "hkey", labels), ["hkey"], ["host", "path"])
    below = open_hosts.select(
        "host", "path", F.explode(F.filter("mark", lambda r: F.startswith("hkey", r))).alias("top")
    ).withColumn("pkey", F.concat("top", F.lit("#"), "path"))
    heads = F.transform(
        F.sequence(F.instr("pkey", "#"), F.length("pkey")), lambda k: F.substring(F.col("pkey"), F.lit(1), k)
    )
    innermost = latest_mark(below, _stacks(rules, "pkey", heads), ["pkey"], ["host", "path", "top"]).select(
        "host", "path", F.get(F.filter("mark", lambda r: F.startswith("pkey", r)), F.lit(0)).alias("pkey")
    )
    best = (
        innermost.filter("pkey IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.instr("pkey", "#").alias("a"), F.length("pkey").alias("b"), "pkey")).alias("m"))
        .select("host", "path", "m.pkey")
        .join(rules.select("pkey", F.concat("host", "path").alias("rule"), "verdict"), "pkey")
        .select("host", "path", "rule", "verdict")
    )
    # Written, so that the join can be split at a place that very many urls share.
    best = write_through(best, "rules-of-places")
    return urls.join(best, ["host", "path"], "left").select(
        "url", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with host, path, rule and verdict of each url.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains
    whose path begins with the rule's; the most specific host wins, then the longest
    path. Of rules with one host and path, a ``block`` wins over an ``allow``. Rules
    without host or verdict are ignored, a null path is an empty one. A url that no
    rule fits gets ``default`` and a null rule. A url that is null or has no ``://``
    has an empty host and path. Columns of ``pages`` named like the four, in any case,
    are replaced; others may have any name. Urls are read whole, however long.
    Repeated urls are judged once and all get the result; an empty table gives none.
    """
    judged = match_rules(pages, rules, url, default)
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    pages = pages.select(*[F.col(f"`{c}`") for c in kept])
    (same,) = unused(pages, "url")
    judged = judged.select(F.col("url").alias(same), "host", "path", "rule", "verdict")
    known = pages.filter(F.col(f"`{url}`").isNotNull())
    out = known.join(judged, F.col(f"`{url}`") == F.col(same)).drop(same)
    blank = pages.filter(F.col(f"`{url}`").isNull()).select(
        "*",
        F.lit("").alias("host"),
        F.lit("").alias("path"),
        F.lit(None).cast("string").alias("rule"),
        F.lit(default).alias("verdict"),
    )
    return out.unionByName(blank)
