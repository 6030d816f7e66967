"""URL filtering by hashed host-suffix and path-prefix expressions, in DataFrame operations only.

Each URL is expanded into expressions: every suffix of its host at a label boundary, joined to every
prefix of its path that is as long as some rule's path. An expression equi-joins the rules on the first
four bytes of its SHA-256; the full digest confirms the match. The longest confirmed rule decides.

Pages that agree in host and in the part of the path that rules can see are looked up once, so a hot
host costs one lookup; its verdict returns through a join that broadcasts hot keys, whose number is
bounded, and shuffles the rest. Rules are broadcast by Spark only if their measured size allows it.

Cases: a null url or one without ``://`` has an empty host and path, which no rule with a host fits; of
rules of equal length the one with the longer host wins, then block over allow, then the smaller text;
rules with a null host, path or verdict, or an empty host, are ignored; a null or repeated page_id is
kept as it is; without a fitting rule the verdict is ``default``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.arrow import without
from quernstone.plans.joins import heavy_light_join
from quernstone.plans.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to pages. ``rules`` has host, path and verdict."""
    pages = without(pages, "host", "path", "rule", "verdict", "__host", "__seen", "__n")
    spark = pages.sparkSession
    rules = (
        rules.select(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
        .filter("r_host <> '' AND r_path IS NOT NULL AND r_verdict IS NOT NULL").distinct()
        .withColumn("r_rule", F.concat("r_host", "r_path")).withColumn("r_digest", _digest(F.col("r_rule")))
        .withColumn("r_short", F.substring("r_digest", 1, 4))
    )
    # The lengths of paths in the rules: at most as many as the longest path has characters.
    lengths = sorted(r[0] for r in rules.select(F.length("r_path")).distinct().collect())
    longest = max(lengths, default=0)
    located = pages.withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url")))
    seen = F.substring("path", 1, longest)
    keys = stored(located.filter("host <> ''").groupBy(F.col("host").alias("__host"), seen.alias("__seen")).agg(F.count(F.lit(1)).alias("__n")), "urls")
    total = keys.agg(F.sum("__n")).first()[0] or 0

    labels = F.split("__host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.concat_ws(".", F.slice(labels, k, F.size(labels))))
    prefixes = F.filter(F.array(*[F.when(F.length("__seen") >= n, F.substring("__seen", 1, n)) for n in lengths] or [F.lit(None).cast("string")]), lambda p: p.isNotNull())
    expressions = (
        keys.select("__host", "__seen", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("__host", "__seen", "suffix", F.explode("prefixes").alias("prefix"))
        .select("__host", "__seen", F.concat("suffix", "prefix").alias("expression"))
        .withColumn("digest", _digest(F.col("expression"))).withColumn("short", F.substring("digest", 1, 4))
    )
    # A digest is of host and path run together, so the split must agree too: the host part has no slash.
    confirmed = expressions.join(rules, F.col("short") == F.col("r_short")).filter("digest = r_digest AND (__host = r_host OR endswith(__host, concat('.', r_host))) AND startswith(__seen, r_path)")
    order = F.struct(F.length("r_rule").alias("a"), F.length("r_host").alias("b"), (F.col("r_verdict") == "block").alias("c"))
    # max_by leaves ties open; the smaller text is taken among equals by ordering on it last, reversed.
    best = (
        confirmed.groupBy("__host", "__seen").agg(F.max(order).alias("best"), F.collect_set(F.struct(order.alias("o"), "r_rule", "r_verdict")).alias("all"))
        .select("__host", "__seen", F.array_min(F.transform(F.filter("all", lambda x: x["o"] == F.col("best")), lambda x: F.struct(x["r_rule"].alias("rule"), x["r_verdict"].alias("verdict")))).alias("pick"))
        .select("__host", "__seen", F.col("pick.rule").alias("rule"), F.col("pick.verdict").alias("verdict"))
    )
    judged = stored(keys.join(best, ["__host", "__seen"], "left"), "verdicts").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    rows = located.withColumn("__host", F.col("host")).withColumn("__seen", seen)
    with_host = heavy_light_join(rows.filter("host <> ''"), judged, ["__host", "__seen"], "__n", total)
    without_host = rows.filter("host = ''").withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    return with_host.unionByName(without_host).select(*pages.columns, "host", "path", "rule", "verdict")
