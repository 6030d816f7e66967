"""Text cleaning and property extraction over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import properties as P
from quernstone.functions import text as X
from quernstone.functions import vocabulary as V
from quernstone.queries.common import Literal, Registry, quoted, table

REGISTRY = Registry()


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@REGISTRY.add("SELECT doc_id, md5(strip_accents(text)) AS digest FROM documents")
def text_strip_accents(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(X.strip_accents(F.col("text"))).alias("digest"))


@REGISTRY.add(r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(trim(text))), '\b(la|el|los|las|un|una|de|del|al)\b', ' ', 'g'), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS key FROM documents""")
def text_canonical_key(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(X.canonical_name(F.col("text"))).alias("key"))


_MOJI = "text"
for _wrong, _right in V.MOJIBAKE:
    _MOJI = f"replace({_MOJI}, {quoted(_wrong)}, {quoted(_right)})"


@REGISTRY.add(f"SELECT doc_id, md5({_MOJI}) AS digest, regexp_matches(text, 'Ç|ƒ|Â') AS had FROM documents")
def text_mojibake(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(X.repair_mojibake(F.col("text"))).alias("digest"), F.col("text").rlike("Ç|ƒ|Â").alias("had"))


_NAV = [
    (r"(?i)^(\s*((ES\s*[▼▾]?\s*)?ES\s+EN\s+FR\s+IT\s+PT\s+DE\s+|(Leer|Saber|Mostrar)\s+m[aá]s\s+))+", ""), (r"(?i)\s+(Leer|Mostrar)\s+m[aá]s( .*)?$", ""),
    (r"(?i)\bES\s+EN\s+FR\s+IT\s+PT\s+DE\b", " "), (r"(?i)\s+Ir a\s+", " "), (r"\s+", " "),
]
# Every third text gets a language bar and a call to read on, which the invented prose doesn't have.
_NAVIGATED = "CASE WHEN doc_id % 3 = 0 THEN 'ES EN FR IT PT DE ' || text || ' Ir a inicio Leer más ahora' ELSE text END"
_NAV_SQL = "trim(regexp_replace(" + _NAVIGATED + r", '\s+', ' ', 'g'))"
for _pattern, _by in _NAV:
    _NAV_SQL = f"regexp_replace({_NAV_SQL}, {quoted(_pattern)}, {quoted(_by)}, 'g')"


@REGISTRY.add(f"SELECT doc_id, md5(trim({_NAV_SQL}, ' -|,.;:')) AS cleaned FROM documents")
def text_nav_noise(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(X.strip_navigation(F.expr(_NAVIGATED))).alias("cleaned"))


_MARKERS = ["licensed under", "released under", "this work is"]
_AT = [f"nullif(greatest(strpos(lower(text), {quoted(m)}) - 1, 0), 0)" for m in _MARKERS]


@REGISTRY.add(f"WITH t AS (SELECT doc_id, text, least({', '.join(_AT)}) AS cut FROM documents) SELECT doc_id, length(CASE WHEN cut IS NULL THEN text ELSE rtrim(ltrim(text[1:cut], ' '), ' ') END) AS kept FROM t")
def footer_cut(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.length(X.cut_at_first(F.col("text"), _MARKERS)).cast("long").alias("kept"))


_EDGE = ["the", "and", "of", "to", "in", "de", "la"]


@REGISTRY.add(rf"""WITH t AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS s FROM documents)
SELECT doc_id, md5(trim(regexp_replace(regexp_replace(s, '(?i)^(({"|".join(_EDGE)})\s+)+', ''), '(?i)(\s+({"|".join(_EDGE)}))+$', ''), ' -|,;:')) AS name FROM t""")
def name_edge_clean(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(X.strip_edges(F.col("text"), _EDGE, _EDGE)).alias("name"))


@REGISTRY.add(r"SELECT doc_id, trim(string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), '.')[1]) AS short, trim(regexp_replace(text, '\s+', ' ', 'g'))[1:300] AS long FROM documents")
def descriptions(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.short_description(F.col("text")).alias("short"), X.long_description(F.col("text")).alias("long"))


@REGISTRY.add(r"SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda x: x <> ''))::BIGINT AS n_tokens, len(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda x: x <> '')))::BIGINT AS n_distinct FROM documents")
def token_diversity(spark, sf_dir):
    words = X.tokens(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.size(words).cast("long").alias("n_tokens"), F.size(F.array_distinct(words)).cast("long").alias("n_distinct"))


@REGISTRY.add(r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'))) AS slug FROM documents")
def text_slug(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(X.slug(F.col("text"))).alias("slug"))


@REGISTRY.add(f"SELECT doc_id, nullif(trim(regexp_extract(text, {quoted(P.EMAIL)})), '') AS email FROM documents")
def extract_email(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", P.email(F.col("text")).alias("email"))


_PHONE = "coalesce(" + ", ".join(f"CASE WHEN length(regexp_replace(regexp_extract(text, {quoted(p)}), '[^0-9]', '', 'g')) >= 9 THEN trim(regexp_extract(text, {quoted(p)})) END" for p in P.PHONES) + ")"


@REGISTRY.add(f"SELECT doc_id, {_PHONE} AS phone FROM documents")
def extract_phone(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", P.phone(F.col("text")).alias("phone"))


# Whole documents, and in front of some of them an offer, which the invented prose doesn't have.
_OFFERED = """CASE doc_id % 7 WHEN 0 THEN 'Abierto 10:00 - 14:30, entrada 5,50 €, 4,5/5. ' WHEN 1 THEN 'Calle Mayor 12, 31001 Pamplona, desde 1512. ' WHEN 2 THEN 'lat: 42.34 lng: -3.70 '
WHEN 3 THEN 'https://maps/@42.8125,-1.6458,15z ' WHEN 4 THEN '?q=40.4,-3.7 ' WHEN 5 THEN 'lat: 142.0 lng: 8.0 ' ELSE 'precio 12€ y 3/5; 9:30–20:00 ' END || text"""


@REGISTRY.add(rf"""WITH o AS (SELECT doc_id, {_OFFERED} AS text FROM documents) SELECT doc_id, nullif(regexp_extract(text, {quoted(P.HOURS)}), '') AS hours, nullif(regexp_extract(text, {quoted(P.PRICE)}), '') AS price,
replace(nullif(regexp_extract(text, {quoted(P.RATING)}, 1), ''), ',', '.') AS rating, nullif(trim(regexp_extract(text, {quoted(P.ADDRESS)})), '') AS address, nullif(regexp_extract(text, {quoted(P.YEAR)}), '') AS year FROM o""")
def extract_price_hours_rating(spark, sf_dir):
    t = F.col("text")
    year = F.regexp_extract("text", P.YEAR, 0)
    offers = _docs(spark, sf_dir).select("doc_id", F.expr(_OFFERED).alias("text"))
    return offers.select("doc_id", P.hours(t).alias("hours"), P.price(t).alias("price"), P.rating(t).alias("rating"), P.address(t).alias("address"), F.when(year != "", year).alias("year"))


_POINTS = [f"CASE WHEN try_cast(regexp_extract(text, {quoted(p)}, 1) AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(regexp_extract(text, {quoted(p)}, 2) AS DOUBLE) BETWEEN -180 AND 180 THEN regexp_extract(text, {quoted(p)}, 1) || ' ' || regexp_extract(text, {quoted(p)}, 2) END" for _, p in P.COORDINATES]


@REGISTRY.add(f"WITH o AS (SELECT doc_id, {_OFFERED} AS text FROM documents), c AS (SELECT doc_id, coalesce({', '.join(_POINTS)}) AS place FROM o) SELECT doc_id, CAST(string_split(place, ' ')[1] AS DOUBLE) AS lat, CAST(string_split(place, ' ')[2] AS DOUBLE) AS lng FROM c")
def extract_coordinates(spark, sf_dir):
    offers = _docs(spark, sf_dir).select("doc_id", F.expr(_OFFERED).alias("text"))
    return offers.select("doc_id", P.coordinates(F.col("text")).alias("p")).select("doc_id", "p.lat", "p.lng")


GEO = Literal("id long, source string, lat double, lng double", [(1, "regex", 1.0, 2.0), (1, "jsonld", 3.0, 4.0), (2, "iframe", 5.0, 6.0), (2, "data-attrs", 7.0, 8.0), (2, "regex", 9.0, 1.0), (3, "regex", 95.0, 1.0)])


@REGISTRY.add(f"""WITH {GEO.values('g')}, p(source, priority) AS (VALUES {", ".join(f"({quoted(k)}, {v})" for k, v in P.GEO_SOURCES.items())})
SELECT id, source, lat, lng FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY priority DESC, lat, lng) AS rn FROM g JOIN p USING (source) WHERE lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180) WHERE rn = 1""")
def geo_candidate_priority(spark, sf_dir):
    from quernstone.functions.rules import looked_up
    from quernstone.operators import ranking

    fair = GEO.frame(spark).filter(P.valid_point(F.col("lat"), F.col("lng")).isNotNull())
    return ranking.best_of(fair, ["id"], F.struct(looked_up(P.GEO_SOURCES, F.col("source")), -F.col("lat"), -F.col("lng"))).select("id", "source", "lat", "lng")


IMAGES = Literal("id long, tokens string, src string, alt string", [
    (1, "catedral burgos", "https://x.es/images/catedral.jpg", "La catedral"), (1, "catedral burgos", "https://x.es/logo.png", ""), (1, "catedral burgos", "https://x.es/sites/default/files/otra.jpg", ""),
    (2, "museo", "https://x.es/thumb/museo.png", "Museo"), (2, "museo", "https://x.es/images/hero.jpg", ""),
])
_TOK = lambda c: f"len(list_filter(string_split(tokens, ' '), lambda t: contains(lower({c}), t))) > 0"
_IMG = " + ".join(f"CASE WHEN {c} THEN {w} ELSE 0 END" for w, c in [
    (-5, "regexp_matches(src, 'logo|icon|iconos|sprite|banner|placeholder')"), (6, _TOK("alt")), (3, _TOK("src")), (1, "alt <> ''"), (2, "regexp_matches(src, '[.](jpg|jpeg|webp|png|avif)$')"),
    (2, "regexp_matches(src, '/sites/default/files/|/migration/|/images/')"), (-3, "regexp_matches(src, 'home|portada|hero|cabecera|header|cover')"), (-3, "regexp_matches(src, 'thumbnail|thumb|menu|nav|mapa')"), (-2, "length(src) < 15")])


@REGISTRY.add(f"WITH {IMAGES.values('i')}, s AS (SELECT id, src, CAST({_IMG} AS DOUBLE) AS score FROM i) SELECT id, src, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, src) AS rank FROM s")
def image_rank_roles(spark, sf_dir):
    from quernstone.operators import ranking, scoring

    scored = IMAGES.frame(spark).select("id", "src", scoring.image_score(F.split("tokens", " "), F.col("src"), F.col("alt"), F.lit("")).alias("score"))
    return ranking.top_k(scored, ["id"], [F.desc("score"), "src"], 12).select("id", "src", "score", "rank")


@REGISTRY.add("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS dialogue, count(*) AS turns FROM conversations GROUP BY conv_id")
def block_concat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("x"))
    return rows.select("conv_id", F.concat_ws("\n", F.transform("x", lambda t: t["text"])).alias("dialogue"), F.size("x").cast("long").alias("turns"))


HEADINGS = Literal("id long, raw string", [(1, "Qué ver Hoteles Museo del Prado Ver"), (2, "Ayuntamiento de Pamplona Plaza Mayor"), (3, "Mercados Mercado Central"), (4, "  Ruta  del vino -"), (5, "Restaurantes Tradiciones")])


@REGISTRY.add(rf"""WITH {HEADINGS.values('h')}, a AS (SELECT id, trim(regexp_replace(trim(regexp_replace(raw, '\s+', ' ', 'g')), '(?i)\b({"|".join(X.CALLS)})$', '')) AS s FROM h),
b AS (SELECT id, regexp_replace(regexp_replace(s, '(?i)^Ayuntamiento\s+de\s+Pamplona\s+', ''), '(?i)^(({"|".join(X.LISTING_HEADS)})\s+)+', '') AS s FROM a)
SELECT id, trim(regexp_replace(s, '\s+', ' ', 'g'), ' -|,;:') AS name FROM b""")
def candidate_name_clean(spark, sf_dir):
    return HEADINGS.frame(spark).select("id", X.candidate_name(F.col("raw")).alias("name"))
