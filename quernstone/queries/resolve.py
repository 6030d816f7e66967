"""Similarity joins and entity resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import similarity as S
from quernstone.operators import resolve
from quernstone.plans.scratch import stored
from quernstone.queries.common import Literal, Registry, quoted, table

REGISTRY = Registry()

PLACES = Literal("id long, name string, class string, url string, external_id string, image string, description string", [
    (1, "Catedral de Burgos", "Cathedral", "https://a.es/es/catedral", None, "i1", "La catedral gótica"), (2, "La Catedral de Burgos", "Church", "https://a.es/catedral", None, "i1", "Catedral gótica de Burgos"),
    (3, "Burgos", "Place", "https://a.es/burgos", "Q1", None, "Ciudad"), (4, "Ciudad de Burgos", "Place", "https://b.es/burgos", "Q1", None, "La ciudad"), (5, "Museo del Prado", "Museum", "https://c.es/prado", None, None, None),
    (6, "Prado", "Museum", "https://d.es/prado", None, None, None), (7, "Plaza Mayor", "Square", "https://e.es/plaza", "Q7", None, None), (8, "Plaza Mayor", "Square", "https://f.es/plaza", "Q8", None, None),
    (9, "Plaza Mayor", "Event", "https://g.es/plaza", None, None, None), (10, None, None, None, None, None, None),
])


def page_entities(spark, sf_dir):
    """The entities that the page pipeline yields from all pages, as rows to be merged across pages."""
    from quernstone.plans.pipeline import entities_of_pages

    rows = entities_of_pages(table(spark, sf_dir, "pages"))
    none = F.lit(None).cast("string")
    return stored(rows.select(F.xxhash64("page_id", "rank").alias("id"), "name", F.col("primary_class").alias("class"), "url", none.alias("external_id"), none.alias("image"), F.col("name").alias("description")), "entities")


@REGISTRY.add()
def blocked_fuzzy_merge(spark, sf_dir):
    return resolve.merge_entities(page_entities(spark, sf_dir))


@REGISTRY.add()
def match_scores(spark, sf_dir):
    return resolve.scored_pairs(PLACES.frame(spark))


@REGISTRY.add()
def weak_variant_anti(spark, sf_dir):
    places = PLACES.frame(spark)
    return places.join(resolve.weak_variants(places), "id", "left_anti").select("id", "name")


@REGISTRY.add("""WITH w AS (SELECT item_id, list_distinct(list_filter(string_split(lower(text), ' '), lambda x: x <> '')) AS words FROM benchmark),
p AS (SELECT a.item_id AS a, b.item_id AS b, len(list_intersect(a.words, b.words))::DOUBLE / len(list_distinct(list_concat(a.words, b.words))) AS j FROM w a JOIN w b ON a.item_id < b.item_id)
SELECT a, b, round(j, 6) AS jaccard FROM p WHERE j >= 0.1""")
def token_jaccard_join(spark, sf_dir):
    words = F.array_distinct(F.filter(F.split(F.lower("text"), " "), lambda x: x != ""))
    items = table(spark, sf_dir, "benchmark").select("item_id", words.alias("words"))
    word = items.select("item_id", F.explode("words").alias("word"))
    sizes = items.select("item_id", F.size("words").alias("n"))
    # Common words are counted by an equi-join; pairs without any never meet.
    common = word.alias("l").join(word.alias("r"), "word").filter("l.item_id < r.item_id").groupBy(F.col("l.item_id").alias("a"), F.col("r.item_id").alias("b")).agg(F.count(F.lit(1)).alias("common"))
    joined = common.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    j = F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
    return joined.withColumn("j", j).filter("j >= 0.1").select("a", "b", F.round("j", 6).alias("jaccard"))


NAMES = Literal("page long, name string", [(1, "Museo"), (1, "Museo del Prado"), (1, "Prado"), (1, "Prado Nuevo"), (2, "Museo"), (2, "Plaza"), (2, "Gran Plaza Mayor")])


@REGISTRY.add(f"WITH {NAMES.values('n')} SELECT page, name FROM n s WHERE NOT EXISTS (SELECT 1 FROM n l WHERE l.page = s.page AND length(l.name) > length(s.name) AND contains(' ' || lower(l.name) || ' ', ' ' || lower(s.name) || ' '))")
def substring_anti(spark, sf_dir):
    from quernstone.operators import extract

    return extract.drop_contained(NAMES.frame(spark), ["page"])


@REGISTRY.add("""WITH c AS (SELECT label AS class_id, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label),
s AS (SELECT e.vec_id, c.class_id, list_cosine_similarity(e.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS score FROM embeddings e, c),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class_id) AS rank FROM s) SELECT vec_id, class_id, round(score, 6) AS score, rank FROM r WHERE rank <= 3""")
def cosine_topk(spark, sf_dir):
    """Every vector against the first vector of each label."""
    e = table(spark, sf_dir, "embeddings")
    classes = stored(e.groupBy(F.col("label").alias("class_id")).agg(F.min_by("embedding", "vec_id").alias("class_vector")), "classes")
    return resolve.nearest_classes(e, classes, "vec_id", "embedding", 3).select("vec_id", "class_id", F.round("score", 6).alias("score"), "rank")


@REGISTRY.add()
def cosine_cluster(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 50).cast("long").alias("page"), F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return resolve.cosine_groups(e, ["page"])


_POINT = "SELECT c_custkey AS id, 40.0 + (c_custkey % 97) / 100.0 AS lat, -4.0 + (c_custkey % 89) / 100.0 AS lng FROM customer"


@REGISTRY.add(f"""WITH p AS ({_POINT}), d AS (SELECT a.id AS a, b.id AS b, 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2)))) AS km FROM p a JOIN p b ON a.id < b.id)
SELECT a, b, round(km, 6) AS km FROM d WHERE km <= 2.0""")
def haversine_range_join(spark, sf_dir):
    c = F.col("c_custkey")
    points = table(spark, sf_dir, "customer").select(c.alias("id"), (40.0 + (c % 97) / 100.0).alias("lat"), (-4.0 + (c % 89) / 100.0).alias("lng"))
    return resolve.near_points(points, 2.0)


@REGISTRY.add(f"WITH p AS ({_POINT}) SELECT id FROM p WHERE lat BETWEEN 40.2 AND 40.6 AND lng BETWEEN -3.9 AND -3.5")
def bbox_filter(spark, sf_dir):
    c = F.col("c_custkey")
    points = table(spark, sf_dir, "customer").select(c.alias("id"), (40.0 + (c % 97) / 100.0).alias("lat"), (-4.0 + (c % 89) / 100.0).alias("lng"))
    return points.filter(S.in_box(F.col("lat"), F.col("lng"), 40.2, 40.6, -3.9, -3.5)).select("id")
