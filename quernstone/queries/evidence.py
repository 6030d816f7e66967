"""Evidence queries over pages and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.operators import evidence
from quernstone.queries.common import Registry, any_of, case_first, quoted, table

REGISTRY = Registry()

_HOST = "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1))"
_PATH = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_SEGS = f"list_filter(string_split({_PATH}, '/'), lambda x: x <> '')"


@REGISTRY.add(f"""SELECT page_id, CASE WHEN {any_of("lower(url)", evidence.IGNORED_PAGES)} THEN 'ignore' WHEN len({_SEGS}) = 0 THEN 'homepage_or_portal' WHEN {_SEGS}[1] IN ({", ".join(map(quoted, evidence.VALUABLE_SEGMENTS))}) THEN 'likely_rescatable'
WHEN len({_SEGS}) >= 2 THEN 'review_by_family' ELSE 'review_single_segment' END AS kind, CASE WHEN len({_SEGS}) = 0 THEN '/' WHEN contains(url, '?') AND contains(regexp_extract(url, '[?]([^#]*)', 1), 'elementor_library') THEN '?elementor_library'
WHEN len({_SEGS}) = 1 THEN '/' || {_SEGS}[1] ELSE '/' || {_SEGS}[1] || '/...' END AS pattern FROM pages""")
def zero_page_kinds(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", evidence.zero_page_kind(url).alias("kind"), evidence.address_pattern(url).alias("pattern"))


# An image address for each page: its own, in front of one of the parts that tell a kind of image.
_PARTS = [part for part, _ in evidence.IMAGE_REASONS]
_SRC = "CASE WHEN page_id % 3 = 0 THEN url || '/foto.jpg' ELSE 'https://img.es/' || list_extract([" + ", ".join(map(quoted, _PARTS)) + f"], CAST(page_id % {len(_PARTS)} + 1 AS INT)) || '.png' END"


@REGISTRY.add(f"""WITH i AS (SELECT page_id, {_SRC} AS src FROM pages) SELECT page_id, {case_first([(r, f"contains(lower(src), {quoted(p)})") for p, r in evidence.IMAGE_REASONS], "''")} AS reason FROM i""")
def image_rejection_reasons(spark, sf_dir):
    named = F.element_at(F.array(*[F.lit(p) for p in _PARTS]), (F.col("page_id") % len(_PARTS) + 1).cast("int"))
    src = F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit("/foto.jpg"))).otherwise(F.concat(F.lit("https://img.es/"), named, F.lit(".png")))
    return table(spark, sf_dir, "pages").select("page_id", evidence.image_rejection(src).alias("reason"))


_TOK = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda x: x <> '')"
_SHORT = r"list_filter(list_transform(regexp_split_to_array(text, '[|•·\-–—/]+'), lambda p: trim(regexp_replace(p, '\s+', ' ', 'g'))), lambda p: p <> '')"


@REGISTRY.add(rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), t AS (SELECT doc_id, text, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS norm, len({_TOK}) AS n, len(list_distinct({_TOK})) AS u, {_SHORT} AS parts FROM d),
s AS (SELECT *, u / greatest(n, 1) AS share, len(list_filter(parts, lambda p: len(string_split(p, ' ')) <= 4)) / greatest(len(parts), 1) AS short, {" + ".join(f"contains(norm, {quoted(w)})::INT" for w in evidence.NAVIGATION_TERMS)} AS hits FROM t),
w AS (SELECT *, CASE WHEN n >= 40 THEN 3 WHEN n >= 20 THEN 2 WHEN n >= 10 THEN 1 ELSE -2 END + CASE WHEN share > 0.6 THEN 1 WHEN share < 0.35 THEN -1 ELSE 0 END + CASE WHEN hits >= 3 THEN -3 WHEN hits = 2 THEN -2 ELSE 0 END
  + CASE WHEN short > 0.7 THEN -3 WHEN short > 0.5 THEN -1 ELSE 0 END + CASE WHEN regexp_matches(text, '[.:;]') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(text, '\b\d{{4}}\b') THEN 0.5 ELSE 0 END
  + CASE WHEN regexp_matches(text, '(?i)\bhttps?://') THEN 0.5 ELSE 0 END + CASE WHEN regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}') THEN 0.5 ELSE 0 END AS raw FROM s)
SELECT doc_id, CASE WHEN norm = '' THEN 0.0 ELSE greatest(0, least(10, raw)) END::DOUBLE AS score, CASE WHEN norm = '' OR raw < 3 THEN 'discard' WHEN raw >= 5 THEN 'keep' ELSE 'review' END AS decision FROM w""")
def block_quality_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", evidence.block_quality(F.col("text")).alias("x")).select("doc_id", "x.score", "x.decision")


_MARKUP = """'<html><body data-x="1">' || CASE page_id % 5 WHEN 0 THEN '<script type="application/ld+json">{"@type":"Place","geo":{"latitude":"42.5","longitude":-1.25}}</script>'
WHEN 1 THEN '<div class="m" data-lat="43.1" data-lng="-2.5">' WHEN 2 THEN '<div data-lng=''-3.5'' id="a" data-lat=''40.25''>' WHEN 3 THEN '<iframe width="3" src="https://maps/?q=41.5,-4.75&z=3"></iframe>' ELSE '<iframe src="https://maps/@91.5,-4.75,3z"></iframe>' END || '</body>'"""


@REGISTRY.add("""SELECT page_id, lat, lng, source, NOT regexp_matches(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '[.]es$') OR (lat BETWEEN 27.0 AND 44.5 AND lng BETWEEN -18.5 AND 5.5) AS plausible
FROM pages JOIN (VALUES (0, 42.5, -1.25, 'jsonld'), (1, 43.1, -2.5, 'data-attrs'), (2, 40.25, -3.5, 'data-attrs'), (3, 41.5, -4.75, 'iframe')) v(k, lat, lng, source) ON page_id % 5 = k""")
def markup_geo_points(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(evidence.markup_points(F.expr(_MARKUP))).alias("p"))
    return pages.select("page_id", "p.lat", "p.lng", "p.source", evidence.plausible_for_host(F.col("p.lat"), F.col("p.lng"), F.col("url")).alias("plausible"))


_CLS = "CASE doc_id % 4 WHEN 0 THEN 'Museum' WHEN 1 THEN 'Event' ELSE 'Church' END"


@REGISTRY.add(rf"""SELECT doc_id, CASE WHEN regexp_matches(lower(trim(source)), '( de| del| la| el| los| las| y)$|^(de |del |y )') THEN 'suspicious_name' WHEN regexp_matches(text, '(?i)ES\s+EN\s+FR\s+IT\s+PT\s+DE|\b(Saber|Leer|Mostrar)\s+m[aá]s\b|\bIr a\b') THEN 'navigation_noise'
WHEN {_CLS} IN ('Museum', 'Church') AND n_chars % 2 = 0 AND n_chars % 3 = 0 THEN 'missing_geo_and_image' WHEN {_CLS} IN ('Museum', 'Church') AND n_chars % 2 = 0 THEN 'missing_geo'
WHEN n_chars % 3 = 0 AND lang = 'en' THEN 'only_weak_image_candidates' WHEN n_chars % 3 = 0 THEN 'missing_image' ELSE 'manual_review' END AS bucket FROM documents""")
def review_buckets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    n = F.col("n_chars")
    return docs.select("doc_id", evidence.review_bucket(F.col("source"), F.expr(_CLS), F.col("text"), n % 2 != 0, n % 3 != 0, F.col("lang") == "en").alias("bucket"))
