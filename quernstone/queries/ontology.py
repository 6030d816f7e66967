"""Queries over the taxonomy."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import vocabulary as V
from quernstone.operators import ontology
from quernstone.operators.scoring import clean_type
from quernstone.queries.common import Literal, Registry, quoted

REGISTRY = Registry()
_CLOSURE = ontology.closure_sql()


@REGISTRY.add(f"{_CLOSURE} SELECT class, ancestor, steps FROM reach")
def ontology_closure(spark, sf_dir):
    return ontology.closure(ontology.edges(spark))


@REGISTRY.add(f"{_CLOSURE} SELECT class, ancestor, steps FROM reach")
def ontology_closure_recursive(spark, sf_dir):
    return spark.sql(f"{_CLOSURE} SELECT class, ancestor, steps FROM reach")


_DIST = f"""{_CLOSURE}, depth AS (SELECT class, max(steps) AS depth FROM reach GROUP BY class),
pair AS (SELECT a.class AS source, b.class AS target, min(a.steps + b.steps) AS distance, arg_max(a.ancestor, d.depth) AS lca FROM reach a JOIN reach b ON a.ancestor = b.ancestor JOIN depth d ON d.class = a.ancestor GROUP BY ALL)"""


@REGISTRY.add(f"{_DIST} SELECT source, target, lca FROM pair")
def taxonomy_lca(spark, sf_dir):
    return ontology.distances(ontology.closure(ontology.edges(spark))).select("source", "target", "lca")


_GENERIC = ", ".join(map(quoted, V.GENERIC_CLASSES))


@REGISTRY.add(f"""{_DIST} SELECT source, target, distance::BIGINT AS distance, round(CASE WHEN source = target THEN 1.0 ELSE
 CASE distance WHEN 1 THEN 0.83 WHEN 2 THEN 0.66 WHEN 3 THEN 0.5 WHEN 4 THEN 0.33 ELSE greatest(0.1, 1.0 - 0.18 * distance) END
 * CASE WHEN source IN ({_GENERIC}) AND target IN ({_GENERIC}) THEN 0.85 WHEN source IN ({_GENERIC}) OR target IN ({_GENERIC}) THEN 0.75 WHEN abs(s.depth - t.depth) >= 3 THEN 0.85 ELSE 1.0 END END, 6)::DOUBLE AS similarity
FROM pair JOIN depth s ON s.class = source JOIN depth t ON t.class = target""")
def taxonomy_distance(spark, sf_dir):
    reach = ontology.closure(ontology.edges(spark))
    depth = reach.groupBy("class").agg(F.max("steps").alias("depth"))
    near = ontology.distances(reach).join(depth.toDF("source", "ds"), "source").join(depth.toDF("target", "dt"), "target")
    return near.select("source", "target", "distance", F.round(ontology.similarity(F.col("distance"), F.col("source"), F.col("target"), F.col("ds") - F.col("dt")), 6).alias("similarity"))


CLASSES = Literal("id long, class string", [(1, "Museum"), (2, "Place"), (3, "Hotel"), (4, None), (5, "Square"), (6, ""), (7, "Cathedral"), (8, "Thing")])


@REGISTRY.add(f"""WITH {CLASSES.values('e')}, known(class) AS (VALUES {", ".join(f"({quoted(c)})" for c in sorted({*V.PARENTS, *V.PARENTS.values()}))}),
r AS (SELECT id, e.class, CASE WHEN coalesce(trim(e.class), '') = '' THEN 'missing_class' WHEN e.class IN ({", ".join(map(quoted, V.NOT_IN_ONTOLOGY))}) THEN 'generic_class' WHEN k.class IS NULL THEN 'class_not_in_ontology' END AS rejection FROM e LEFT JOIN known k ON e.class = k.class)
SELECT id, CASE WHEN rejection IS NULL THEN class END AS class, rejection, rejection IS NULL AS ontology_match FROM r""")
def closed_world_left_join(spark, sf_dir):
    classes = ontology.closure(ontology.edges(spark)).select("class").distinct()
    return ontology.closed_world(CLASSES.frame(spark), classes)


SPELLED = Literal("id long, raw string", [(1, " museums "), (2, "Coffee  Shop"), (3, "Theater"), (4, "Castle"), (5, ""), (6, "lodging")])


@REGISTRY.add(rf"""WITH {SPELLED.values('s')}, m(k, v) AS (VALUES {", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in V.CANONICAL_TYPES.items())}),
t AS (SELECT id, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS raw FROM s) SELECT id, coalesce(v, raw) AS class FROM t LEFT JOIN m ON k = lower(raw)""")
def alias_lookup(spark, sf_dir):
    return SPELLED.frame(spark).select("id", clean_type(F.col("raw")).alias("class"))


LABELS = Literal("class string, lang string, label string", [("Museum", "en", "Museum"), ("Museum", "es", "Museo"), ("Castle", "en", "Castle"), ("Castle", None, "Castrum"), ("Wall", "fr", "Mur"), ("Wall", None, "Murus")])


@REGISTRY.add(f"WITH {LABELS.values('l')} SELECT class, label FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY CASE coalesce(lang, '') WHEN 'es' THEN 1 WHEN 'en' THEN 2 WHEN '' THEN 3 ELSE 4 END, label) AS rn FROM l) WHERE rn = 1")
def label_language_preference(spark, sf_dir):
    return ontology.preferred_label(LABELS.frame(spark), "class")
