"""File sources: JSON lists, delimited text, sitemaps, robots files, N-Triples and Markdown tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quernstone.plans.scratch import stored

# The columns of an exported entity that other steps read.
ENTITY = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("entityId", "name", "class", "url", "sourceUrl", "description", "shortDescription", "longDescription", "image", "mainImage", "address", "phone", "email", "wikidataId", "pageType", "mentionRole", "qualityDecision", "geoSource", "geoRejectedReason", "imageQuality")]
    + [T.StructField(n, T.DoubleType()) for n in ("score", "finalScore", "qualityScore")]
    + [T.StructField("coordinates", T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())]))]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("types", "relatedUrls", "images", "qualityReasons")]
)


def entities(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of entities; malformed records give nulls, not a failure."""
    return spark.read.schema(ENTITY).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def delimited(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text with a header; the delimiter is the one that the first line has more of, and a byte-order mark goes."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0][0] if first else ""
    df = spark.read.option("header", True).option("sep", ";" if line.count(";") > line.count(",") else ",").option("quote", '"').option("escape", '"').csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def sitemap_urls(xml: Column) -> Column:
    """The addresses in a sitemap or a sitemap index."""
    return F.transform(F.regexp_extract_all(F.coalesce(xml, F.lit("")), F.lit(r"<loc>\s*(?:<!\[CDATA\[)?\s*([^<\]]*?)\s*(?:\]\]>)?\s*</loc>"), F.lit(1)), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&")))


def is_sitemap_index(xml: Column) -> Column:
    return F.contains(F.lower(F.coalesce(xml, F.lit(""))), F.lit("<sitemapindex"))


def expand_sitemaps(documents: DataFrame, start: DataFrame, max_rounds: int = 16) -> DataFrame:
    """Pages reachable from sitemaps: rounds of index expansion, each an anti-join with what was visited.

    ``documents`` has url and xml, ``start`` has url. All maps of a round are followed; indexes that are nested
    deeper than ``max_rounds`` are an error.
    """
    frontier, visited, pages = start.select("url").distinct(), start.select("url").limit(0), None
    for _ in range(max_rounds):
        seen = documents.join(frontier, "url")
        found = seen.select(is_sitemap_index(F.col("xml")).alias("index"), F.explode(sitemap_urls(F.col("xml"))).alias("found"))
        got = found.filter("NOT index").select(F.col("found").alias("url"))
        pages = got if pages is None else pages.unionByName(got)
        visited = visited.unionByName(frontier)
        frontier = stored(found.filter("index").select(F.col("found").alias("url")).distinct().join(visited, "url", "left_anti"), "frontier")
        if frontier.isEmpty():
            return pages.distinct()
    raise ValueError(f"sitemap indexes are nested more than {max_rounds} deep")


def robots_rules(robots: DataFrame, key: str = "host", text: str = "text") -> DataFrame:
    """(host, agent, field, value): each line with the agent that stands above it."""
    lines = robots.select(key, F.posexplode(F.split(text, r"\r?\n")).alias("pos", "line"))
    parts = F.regexp_replace("line", r"\s*#.*$", "")
    split = lines.select(key, "pos", F.lower(F.trim(F.substring_index(parts, ":", 1))).alias("field"), F.trim(F.regexp_replace(parts, r"^[^:]*:", "")).alias("value")).filter("field <> '' AND value <> ''")
    agent = F.last(F.when(F.col("field") == "user-agent", F.lower("value")), True).over(Window.partitionBy(key).orderBy("pos"))
    return split.withColumn("agent", agent).filter("field <> 'user-agent'").select(key, "agent", "field", "value")


def crawl_delay(rules: DataFrame, key: str = "host", least: float = 0.6) -> DataFrame:
    """Seconds between requests to each host: what its robots file asks for, and at least ``least``."""
    asked = rules.filter("field = 'crawl-delay' AND agent = '*'").groupBy(key).agg(F.max(F.col("value").try_cast("double")).alias("asked"))
    return asked.select(key, F.greatest(F.lit(least), F.coalesce("asked", F.lit(least))).alias("delay"))


def ntriples(spark: SparkSession, path: str) -> DataFrame:
    """(subject, predicate, object, datatype, lang) of N-Triples lines."""
    return parse_ntriples(spark.read.text(path).withColumnRenamed("value", "line"))


def parse_ntriples(lines: DataFrame, line: str = "line") -> DataFrame:
    pattern = r'^\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>|@([A-Za-z-]+))?)\s*\.\s*$'
    part = lambda k: F.regexp_extract(line, pattern, k)
    null = lambda c: F.when(c != "", c)
    literal = F.replace(F.replace(part(4), F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n"))
    rows = lines.filter(F.col(line).rlike(pattern))
    return rows.select(part(1).alias("subject"), part(2).alias("predicate"), F.coalesce(null(part(3)), literal).alias("object"), null(part(5)).alias("datatype"), F.lower(null(part(6))).alias("lang"))


def markdown_cells(line: Column) -> Column:
    """The cells of a Markdown table row; null for any other line and for the rule below a header."""
    cells = F.transform(F.split(F.regexp_replace(F.trim(line), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    return F.when(F.trim(line).rlike(r"^\|.*\|$") & ~F.trim(line).rlike(r"^[|\s:-]+$"), cells)
