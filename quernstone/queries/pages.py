"""URL, page and HTML queries over pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import urls as U
from quernstone.functions import vocabulary as V
from quernstone.operators import evaluation, extract, ranking, scoring
from quernstone.queries.common import Registry, any_of, case_first, quoted, table
from quernstone.sources import files, html

REGISTRY = Registry()

_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"
_PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
_QUERY = r"regexp_extract(url, '^[^?#]*(\?[^#]*)', 1)"
_SEGS = f"list_filter(string_split({_PATH}, '/'), lambda x: x <> '')"
_CUT = f"CASE WHEN replace({_PATH}, '//', '/') IN ('', '/') THEN '/' ELSE rtrim(replace({_PATH}, '//', '/'), '/') END"
_NORM = f"regexp_extract(url, '^([a-z]+)://', 1) || '://' || {_HOST} || {_CUT} || {_QUERY}"


@REGISTRY.add(f"SELECT page_id, {_NORM} AS url_norm FROM pages")
def url_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.crawl_url(F.col("url")).alias("url_norm"))


@REGISTRY.add("SELECT page_id, rtrim(regexp_replace(regexp_replace(replace(lower(trim(url)), 'http://', 'https://'), '^https://www\\.', 'https://'), '#.*$', ''), '/') AS key FROM pages")
def url_eval_key(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.eval_url(F.col("url")).alias("key"))


@REGISTRY.add(f"""SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) || '://' || {_HOST} ||
CASE WHEN regexp_replace(rtrim({_PATH}, '/') || '/', '^/(web/guest|es|en|fr|it|pt|de)/', '/') = '/' THEN '/' ELSE rtrim(regexp_replace(rtrim({_PATH}, '/') || '/', '^/(web/guest|es|en|fr|it|pt|de)/', '/'), '/') END AS key FROM pages""")
def url_source_key(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.source_url(F.col("url")).alias("key"))


@REGISTRY.add(f"SELECT page_id, url FROM pages WHERE {_HOST} LIKE '%.example.com' AND ({_PATH} = '/en' OR starts_with({_PATH}, '/en/'))")
def url_scope_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    inside = (U.path(F.col("url")) == "/en") | F.startswith(U.path(F.col("url")), F.lit("/en/"))
    return pages.filter(F.endswith(U.host(F.col("url")), F.lit(".example.com")) & inside)


@REGISTRY.add(f"""SELECT page_id, (lower({_SEGS}[1]) IN ({", ".join(map(quoted, V.BLOCKED_LANGUAGES))}) OR regexp_matches(lower(coalesce({_SEGS}[1], '')), '^({"|".join(V.BLOCKED_LANGUAGES)})-'))
OR {any_of("lower(url)", V.BAD_URL_PARTS)} OR {any_of(f"lower({_QUERY})", V.BAD_QUERY_PARTS)}
OR regexp_matches(lower({_PATH}), '({"|".join(e.replace(".", "[.]") for e in V.BAD_EXTENSIONS)})$') AS skipped FROM pages""")
def url_skip_filter(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.skipped(F.col("url")).alias("skipped"))


@REGISTRY.add(f"SELECT page_id, {case_first([(n, any_of('lower(url)', p)) for n, p in V.PAGE_TYPES], quoted('unknown'))} AS page_type FROM pages")
def url_page_type(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.page_type(F.col("url")).alias("page_type"))


_FAMILIES = [("short_id", r"^/[a-z]{2}/[0-9]{1,2}(\.html)?/?$"), ("html", r"\.html$"), ("folder", r"/$"), ("plain", r"^/[a-z]{2}/[0-9]+$")]


@REGISTRY.add(f"SELECT page_id, {case_first([(n, f'regexp_matches({_PATH}, {quoted(p)})') for n, p in _FAMILIES], quoted('other'))} AS family FROM pages")
def url_family_case(spark, sf_dir):
    from quernstone.functions.rules import first_case

    path = U.path(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", first_case([(n, path.rlike(p)) for n, p in _FAMILIES], "other").alias("family"))


@REGISTRY.add(f"SELECT {_HOST} AS host, '/' || coalesce({_SEGS}[1], '') AS prefix, count(*) AS n FROM pages GROUP BY ALL")
def url_prefix_histogram(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.groupBy(U.host(F.col("url")).alias("host"), U.prefix(F.col("url"), 1).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add(f"SELECT page_id, trim(regexp_replace(coalesce({_SEGS}[-1], ''), '[-_]+', ' ', 'g')) AS slug, len(list_filter(regexp_split_to_array(lower({_PATH}), '[^a-z0-9]+'), lambda x: x <> ''))::BIGINT AS n_tokens FROM pages")
def url_slug_tokens(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.slug_text(F.col("url")).alias("slug"), F.size(U.path_tokens(F.col("url"))).cast("long").alias("n_tokens"))


_LINK = f"CASE WHEN page_id % 2 = 0 THEN {_PATH} ELSE url END"


@REGISTRY.add(f"""SELECT page_id, starts_with({_PATH}, '/') AND len({_SEGS}) >= 2 AND NOT coalesce(lower({_SEGS}[-1]) IN ({", ".join(map(quoted, V.CUT_SLUG_TAILS))}), false) AS plausible FROM pages""")
def url_plausible_link(spark, sf_dir):
    link = F.when(F.col("page_id") % 2 == 0, U.path(F.col("url"))).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", U.plausible_link(link).alias("plausible"))


_ENTITY_SQL = f"SELECT {_HOST} AS page, regexp_extract(url, '[.]([a-z]+)(/|$|[?#])', 1) AS cls FROM pages WHERE regexp_matches(url, '[.][a-z]+(/|$|[?#])')"


@REGISTRY.add(f"""WITH e AS ({_ENTITY_SQL}), p AS (SELECT DISTINCT {_HOST} AS page FROM pages),
c AS (SELECT page, cls, count(*) AS n FROM e GROUP BY ALL)
SELECT p.page, c.cls, coalesce(c.n, 0) AS n FROM p LEFT JOIN c USING (page)""")
def page_summary(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(U.host(F.col("url")).alias("page"), F.regexp_extract("url", r"[.]([a-z]+)(/|$|[?#])", 1).alias("cls"), "page_id")
    return evaluation.page_summary(pages, pages.filter("cls <> ''"), "page", "cls")


@REGISTRY.add(f"""WITH e AS ({_ENTITY_SQL}), p AS (SELECT DISTINCT {_HOST} AS page FROM pages),
c AS (SELECT page, count(*) AS n FROM e GROUP BY page)
SELECT coalesce(c.n, 0) AS entities, count(*) AS pages FROM p LEFT JOIN c USING (page) GROUP BY 1""")
def page_count_histogram(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(U.host(F.col("url")).alias("page"), "url")
    return evaluation.count_histogram(pages, pages.filter(F.col("url").rlike(r"[.][a-z]+(/|$|[?#])")), "page")


@REGISTRY.add(f"SELECT p.page_id, p.url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = p.page_id AND d.lang = 'en')")
def zero_page_left_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("lang = 'en'").select(F.col("doc_id").alias("page_id"))
    return table(spark, sf_dir, "pages").select("page_id", "url").join(docs, "page_id", "left_anti")


@REGISTRY.add()
def html_signals(spark, sf_dir):
    return html.parse_pages(table(spark, sf_dir, "pages")).select("page_id", "title", "h1", "lang", F.size("blocks").alias("n_blocks"))


@REGISTRY.add()
def html_blocks(spark, sf_dir):
    return html.blocks(html.parse_pages(table(spark, sf_dir, "pages")), ["page_id"]).select("page_id", "pos", "tag", "text", "heading", "parent_tag", "link_href")


@REGISTRY.add()
def html_links(spark, sf_dir):
    return html.parse_pages(table(spark, sf_dir, "pages")).select("page_id", F.posexplode("links").alias("pos", "link"))


@REGISTRY.add()
def html_page_text(spark, sf_dir):
    return html.page_text(html.blocks(html.parse_pages(table(spark, sf_dir, "pages")), ["page_id"]), ["page_id"])


@REGISTRY.add("SELECT page_id, regexp_extract(html, 'lang=\"([a-z]+)\"', 1) AS lang, len(regexp_extract_all(html, '<li><a href=\"([^\"]*)\"', 1))::BIGINT AS n_links FROM pages")
def html_regex_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("lang"), F.size(F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)"'), F.lit(1))).cast("long").alias("n_links"))


@REGISTRY.add()
def candidate_extract(spark, sf_dir):
    return extract.candidates(html.blocks(html.parse_pages(table(spark, sf_dir, "pages")), ["page_id"]), ["page_id"])


@REGISTRY.add()
def containment_prune(spark, sf_dir):
    return extract.drop_contained(candidate_extract(spark, sf_dir).select("page_id", "pos", "name"), ["page_id"])


@REGISTRY.add(r"""SELECT doc_id, len(list_filter(list_transform(regexp_split_to_array(text, '\s*(;|·|\||\s/\s)\s*'), lambda x: trim(x)), lambda x: x <> ''))::BIGINT AS n_parts FROM documents""")
def candidate_split(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(extract.split_parts(F.col("text"))).cast("long").alias("n_parts"))


_LOW = f"lower(url)"
_SAID = f"concat_ws(' | ', lower(url))"


@REGISTRY.add(f"""SELECT page_id, {case_first([
    ("legal", any_of(_SAID, scoring.LEGAL) + " OR " + any_of(_LOW, scoring.LEGAL_URL)), ("technical", any_of(_SAID, scoring.TECHNICAL)),
    ("programmatic", any_of(_SAID, scoring.INSTITUTIONAL) + " AND " + any_of(_SAID, scoring.PROGRAMMATIC)), ("institutional", any_of(_SAID, scoring.INSTITUTIONAL)),
    ("detail", f"contains({_LOW}, '/lugar/')"), ("listing", any_of(_LOW, scoring.LISTING_URL))], quoted("detail"))} AS intent FROM pages""")
def page_intent_case(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", scoring.page_intent(F.lit(""), F.lit(""), F.col("url")).alias("intent"))


@REGISTRY.add("SELECT DISTINCT trim(url) AS url FROM pages WHERE url IS NOT NULL AND trim(url) <> '' AND NOT regexp_matches(url, '[<\\]]')")
def sitemap_expand(spark, sf_dir):
    """Sitemaps of bounded size written from the pages' own addresses, indexes of them, and an index of indexes."""
    locs = table(spark, sf_dir, "pages").select("url").filter("url IS NOT NULL AND trim(url) <> '' AND NOT url RLIKE '[<\\\\]]'").distinct()
    n = locs.count()
    tag = lambda c: F.concat(F.lit("<loc>"), F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("</loc>"))
    written = lambda rows, root: F.concat(F.lit(f"<{root}>"), F.concat_ws("", F.array_sort(F.collect_list(rows))), F.lit(f"</{root}>")).alias("xml")
    address = lambda kind, c: F.concat(F.lit(f"https://maps/{kind}-"), c.cast("string"), F.lit(".xml")).alias("url")
    part = F.pmod(F.xxhash64("url"), F.lit(n // 1000 + 1)).alias("part")
    maps = locs.groupBy(part).agg(written(F.concat(F.lit("<url>"), tag(F.col("url")), F.lit("</url>")), "urlset")).select(address("map", F.col("part")), "xml")
    group = F.pmod(F.xxhash64("url"), F.lit(n // 1_000_000 + 1)).alias("part")
    indexes = maps.groupBy(group).agg(written(tag(F.col("url")), "sitemapindex")).select(address("index", F.col("part")), "xml")
    return files.expand_sitemaps(maps.unionByName(indexes), indexes.select("url"))


@REGISTRY.add(f"WITH p AS (SELECT {_HOST} AS host, page_id, url, row_number() OVER (PARTITION BY {_HOST} ORDER BY length(url) DESC, page_id) AS rank, count(*) OVER (PARTITION BY {_HOST}) AS n FROM pages) SELECT host, page_id, rank FROM p WHERE rank <= greatest(3, least(8, n))")
def page_top_k(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(U.host(F.col("url")).alias("host"), "page_id", "url")
    counted = pages.join(pages.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "host")
    return ranking.top_k(counted, ["host"], [F.desc(F.length("url")), F.asc("page_id")], ranking.page_limit(F.lit(False), F.col("n")), most=ranking.LARGEST_PAGE).select("host", "page_id", "rank")


@REGISTRY.add()
def pipeline_end_to_end(spark, sf_dir):
    from quernstone.plans.pipeline import entities_of_pages

    return entities_of_pages(table(spark, sf_dir, "pages"))
