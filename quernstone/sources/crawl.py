"""The crawl as tables: rounds of a frontier, not a loop over pages. Fetching itself is outside the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions import urls as U


def next_round(links: DataFrame, visited: DataFrame, hosts: list[str] | DataFrame, base: str = "/", most: int | None = None) -> DataFrame:
    """(url, detail): new addresses in scope that no earlier round has visited, detail pages first.

    ``links`` has a link column of absolute addresses; ``hosts`` is a list, or a table with a host column;
    ``most`` is the crawl's budget, a feature of it.
    """
    found = links.select(U.crawl_url(F.col("link")).alias("url")).filter("url IS NOT NULL").distinct()
    new = found.filter(U.below(F.col("url"), base) & ~U.skipped(F.col("url"))).join(visited.select("url"), "url", "left_anti")
    if isinstance(hosts, DataFrame):
        scope = hosts.select("host").distinct()
        fresh = new.withColumn("host", U.host(F.col("url"))).join(scope, "host", "left_semi").drop("host")
    else:
        fresh = new.filter(U.in_scope(F.col("url"), hosts, base))
    ranked = fresh.withColumn("detail", F.contains("url", F.lit("/lugar/")))
    return ranked if most is None else ranked.orderBy(F.desc("detail"), "url").limit(most)


def seeds(found: DataFrame, max_pages: int) -> DataFrame:
    """The first addresses of a site's maps, four for each page that will be read and twenty at least."""
    return found.orderBy("pos").limit(max(4 * max_pages, 20))


def site_size(urls: DataFrame, depth: int, most: int) -> DataFrame:
    """The most common path prefixes of a site."""
    counted = urls.groupBy(U.prefix(F.col("url"), depth).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "prefix").limit(most)
