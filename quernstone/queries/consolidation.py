"""Names, consolidation, images, structure and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import urls as U
from quernstone.operators import consolidate, names
from quernstone.queries.common import Literal, Registry, any_of, quoted, table
from quernstone.sources import crawl

REGISTRY = Registry()

NAMES = Literal("id long, name string, context string, cls string", [
    (1, "Catedral de Burgos", "", "Cathedral"), (2, "Contacto", "", None), (3, "Inicio", "", None), (4, "agenda", "", None), (5, "Ana Gómez", "", None), (6, "Ana Gómez", "el palacio real", None),
    (7, "Camino de Santiago ver mas", "", "Route"), (8, "cuando quieras venir", "", None), (9, "Laboratorio central", "", None), (10, "", "", None), (11, "Postres caseros", "", None), (12, "Festival Sol Azul", "", "Event"),
    (13, "Programa Programa Torre", "", None), (14, "una dos tres cuatro cinco seis siete ocho nueve", "", None), (15, "Sol", "junto al museo", None),
])


def _in(words):
    return ", ".join(map(quoted, words))


_TOK = "list_filter(regexp_split_to_array(low, '[^a-z0-9_]+'), lambda w: w <> '')"
_HELD = lambda words: f"len(list_filter(words, lambda w: w IN ({_in(words)})))"


@REGISTRY.add(rf"""WITH {NAMES.values('e')},
a AS (SELECT id, context, cls, trim(regexp_replace(regexp_replace(trim(regexp_replace(name, '\s+', ' ', 'g')), '(?i)^(({"|".join(names.LEADING)})\s+)+', ''), '(?i)(\s+({"|".join(names.TRAILING)}))+$', ''), ' -|,;:') AS clean FROM e),
b AS (SELECT *, strip_accents(lower(clean)) AS low, strip_accents(lower(clean)) || ' || ' || strip_accents(lower(context)) AS both_ FROM a),
c AS (SELECT *, {_TOK} AS words, {any_of("low", names.INSTANCE)} AS inst, {any_of("both_", names.INSTANCE)} AS sup FROM b),
d AS (SELECT *, len(words) AS n, len(string_split(clean, ' ')) BETWEEN 2 AND 4 AND len(list_filter(string_split(clean, ' '), lambda w: regexp_matches(w, '^[A-ZÁÉÍÓÚÑ][a-záéíóúñü-]+$'))) >= 2 AS person FROM c),
f AS (SELECT *, CASE WHEN clean = '' THEN -10.0 WHEN {any_of("low", names.UI)} OR {any_of("low", names.NAVIGATION)} OR {any_of("low", names.PHRASES)}
  OR n = 0 OR (n >= 9 AND NOT inst) OR {" OR ".join(f"starts_with(low, {quoted(o)})" for o in names.OPENERS)} OR (n >= 5 AND {_HELD(names.VERBS)} > 0 AND NOT inst) OR {_HELD(["quien", "como", "cuando"])} > 0
  OR (NOT inst AND ({any_of("low", names.TECHNICAL)} OR {" + ".join(f"contains(both_, {quoted(t)})::INT" for t in names.TECHNICAL)} >= 2))
  OR (NOT inst AND (low IN ({_in(names.CATEGORY + names.THEMES)}) OR {any_of("low", names.THEMES)} OR ({any_of("low", names.CATEGORY)} AND len(string_split(low, ' ')) <= 4))) THEN -8.0
 ELSE CASE WHEN low IN ({_in(names.GENERIC + names.NAVIGATION + names.UI)}) THEN -4 ELSE 0 END + CASE WHEN n = 1 THEN -2 WHEN n >= 2 THEN 1 ELSE 0 END + CASE WHEN inst THEN 3 ELSE 0 END + CASE WHEN sup THEN 2 ELSE 0 END
  + CASE WHEN {any_of("both_", names.EVENT_HINTS)} THEN 2 ELSE 0 END + CASE WHEN {any_of("both_", names.ROUTE_HINTS)} THEN 2 ELSE 0 END + CASE WHEN person THEN 1 ELSE 0 END + CASE WHEN lower(coalesce(cls, '')) IN ({_in(names.STRONG)}) THEN 2 ELSE 0 END
  + CASE WHEN NOT inst AND ((n >= 6 AND {_HELD(names.LOOSE)} >= 2) OR n >= 9 OR {_HELD(["ver", "mas", "comenzaremos", "tambien"])} > 0) THEN -5 ELSE 0 END + CASE WHEN person AND NOT sup THEN -1 ELSE 0 END END AS score FROM d)
SELECT id, score::DOUBLE AS score, CASE WHEN score > -4 THEN 'keep' ELSE 'reject' END AS decision FROM f""")
def additive_name_score(spark, sf_dir):
    e = NAMES.frame(spark)
    return e.select("id", names.name_score(F.col("name"), F.col("context"), F.col("cls")).alias("x")).select("id", "x.score", "x.decision")


@REGISTRY.add()
def entity_quality(spark, sf_dir):
    c = F.col
    held = [(0.75, c("id") % 2 == 0), (1.0, c("id") % 3 == 0)]
    types = F.when(c("cls").isNull(), F.array().cast("array<string>")).otherwise(F.array("cls"))
    urls = F.array(F.concat(F.lit("https://x.es/lugar/"), F.replace(F.lower("name"), F.lit(" "), F.lit("-"))))
    quality = names.entity_quality(c("name"), c("context"), c("context"), urls, types, c("cls"), held, c("name"), F.lit(""), F.lit(""))
    return NAMES.frame(spark).select("id", quality.alias("x")).select("id", "x.score", "x.decision")


@REGISTRY.add("""WITH r AS (SELECT lower(source) AS key, source, doc_id, n_chars, CASE WHEN n_chars % 3 = 0 THEN lang END AS phone FROM documents)
SELECT key, count(*) AS n, max(n_chars)::DOUBLE AS score, arg_min(phone, doc_id) FILTER (phone IS NOT NULL) AS phone FROM r GROUP BY key""")
def consolidate_by_name(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("source").alias("name"), F.lit(None).cast("string").alias("class"), F.col("n_chars").cast("double").alias("score"), F.lit("").alias("short_description"), F.lit("").alias("long_description"), F.when(F.col("n_chars") % 3 == 0, F.col("lang")).alias("phone"), F.lit(None).cast("string").alias("email"), F.col("doc_id").alias("pos"))
    return consolidate.consolidated(rows).select("key", "n", "score", "phone")


@REGISTRY.add("""WITH e AS (SELECT o_custkey AS key, o_orderstatus AS k, o_orderpriority AS v FROM orders)
SELECT key, k, v FROM (SELECT *, row_number() OVER (PARTITION BY key, k ORDER BY length(v) DESC, v) AS rn FROM e) WHERE rn = 1""")
def property_map_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.create_map("o_orderstatus", "o_orderpriority").alias("properties"))
    return consolidate.merge_properties(rows, "key", "properties").select("key", F.explode("properties").alias("k", "v"))


@REGISTRY.add("""WITH i AS (SELECT o_orderkey AS key, unnest([o_orderpriority || '-' || (o_custkey % 400), 'logo-' || o_orderstatus]) AS image FROM orders), c AS (SELECT image FROM i GROUP BY image HAVING count(*) < 5),
k AS (SELECT key, count(*) AS n FROM i WHERE image IN (FROM c) AND NOT contains(image, 'logo') GROUP BY key) SELECT o_orderkey AS key, coalesce(n, 0) AS n FROM orders LEFT JOIN k ON key = o_orderkey""")
def repeated_images(spark, sf_dir):
    images = F.array(F.concat_ws("-", "o_orderpriority", (F.col("o_custkey") % 400).cast("string")), F.concat(F.lit("logo-"), "o_orderstatus"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), images.alias("images"))
    return consolidate.unrepeated_images(rows, "key", "images").select("key", F.size("images").cast("long").alias("n"))


@REGISTRY.add("""WITH r AS (SELECT l_orderkey AS page, l_linenumber AS line, min(l_partkey) AS part FROM lineitem GROUP BY ALL),
s AS (SELECT *, count(*) OVER w AS n, max(CASE WHEN part % 2 = 0 AND line > 1 THEN 1 ELSE 0 END) OVER w AS stops, min(line) OVER w AS first FROM r WINDOW w AS (PARTITION BY page))
SELECT page, line, CASE WHEN n = 1 THEN 'single' WHEN page % 3 = 0 AND first = 1 AND stops = 1 THEN 'hierarchical' ELSE 'flat' END AS structure,
CASE WHEN n = 1 OR line = 1 THEN 'primary' WHEN page % 3 = 0 AND first = 1 AND stops = 1 THEN CASE WHEN part % 2 = 0 THEN 'child' ELSE 'secondary' END ELSE 'standalone' END AS role FROM s""")
def page_structure(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("line")).agg(F.min("l_partkey").alias("part"))
    return consolidate.page_structure(rows, "page", "line", F.col("line") == 1, F.col("page") % 3 == 0, F.col("part") % 2 == 0).select("page", "line", "structure", "role")


@REGISTRY.add("SELECT o_orderkey, n_name FROM orders JOIN nation ON n_nationkey = o_custkey")
def cache_hits(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"))
    cache = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), "n_name")
    return consolidate.from_cache(wanted, cache, "k")[0].select("o_orderkey", "n_name")


@REGISTRY.add("SELECT l_orderkey, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey) AS rn FROM lineitem WHERE l_quantity >= 30) WHERE rn = 1")
def external_candidate(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return consolidate.best_candidate(rows, "l_orderkey", F.col("l_quantity"), 30.0, "l_partkey").select("l_orderkey", "l_partkey", "l_quantity")


@REGISTRY.add("""WITH f AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS found FROM events WHERE value > 90 GROUP BY user_id)
SELECT c.c_custkey AS user_id, CASE WHEN found IS NULL THEN 'missing' WHEN list_contains(found, 'click') THEN 'matched' ELSE 'different' END AS status FROM customer c LEFT JOIN f ON f.user_id = c.c_custkey""")
def review_sample_join(spark, sf_dir):
    sample = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.lit("click").alias("expected"))
    return consolidate.review_status(sample, table(spark, sf_dir, "events").filter("value > 90"), "user_id", "expected", "event_type").select("user_id", "status")


@REGISTRY.add()
def crawl_frontier(spark, sf_dir):
    from quernstone.sources import html

    pages = table(spark, sf_dir, "pages")
    links = html.parse_pages(pages).select("url", F.explode("links").alias("link"))
    hosts = pages.select(U.host(F.col("url")).alias("host")).distinct()
    return crawl.next_round(links, pages.select(U.crawl_url(F.col("url")).alias("url")), hosts)


@REGISTRY.add("SELECT * FROM (SELECT '/' || regexp_extract(url, '^[a-z]+://[^/]*/([a-z]+)', 1) AS prefix, count(*) AS n FROM pages GROUP BY 1) ORDER BY n DESC, prefix LIMIT 3")
def site_size(spark, sf_dir):
    return crawl.site_size(table(spark, sf_dir, "pages").select("url"), 1, 3)
