"""The class taxonomy: closure, common ancestors, distance, and the closed world."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import vocabulary as V
from quernstone.plans.scratch import stored


def edges(spark: SparkSession, parents: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame(sorted((parents or V.PARENTS).items()), "child string, parent string")


def closure(edges: DataFrame, max_rounds: int = 16) -> DataFrame:
    """(class, ancestor, steps), each class its own ancestor at no steps.

    Each round joins the reach with itself and so doubles it; it ends when nothing is new, with cycles too.
    """
    nodes = edges.select(F.col("child").alias("class")).union(edges.select("parent")).distinct()
    direct = edges.select(F.col("child").alias("class"), F.col("parent").alias("ancestor"), F.lit(1).alias("steps"))
    reach = stored(nodes.select("class", F.col("class").alias("ancestor"), F.lit(0).alias("steps")).unionByName(direct), "reach")
    known = reach.count()
    for _ in range(max_rounds):
        far = reach.alias("a").join(reach.alias("b"), F.col("a.ancestor") == F.col("b.class")).select(F.col("a.class"), F.col("b.ancestor"), (F.col("a.steps") + F.col("b.steps")).alias("steps"))
        reach = stored(far.groupBy("class", "ancestor").agg(F.min("steps").alias("steps")), "reach")
        before, known = known, reach.count()
        if known == before:
            break
    return reach


def closure_sql(parents: dict[str, str] | None = None) -> str:
    """The closure as a recursive query, in SQL that Spark and DuckDB share."""
    rows = ", ".join(f"('{c}', '{p}')" for c, p in sorted((parents or V.PARENTS).items()))
    return f"""WITH RECURSIVE edge(child, parent) AS (VALUES {rows}),
node AS (SELECT child AS class FROM edge UNION SELECT parent FROM edge),
reach(class, ancestor, steps) AS (
  SELECT class, class, 0 FROM node
  UNION ALL
  SELECT r.class, e.parent, r.steps + 1 FROM reach r JOIN edge e ON e.child = r.ancestor)"""


def distances(reach: DataFrame) -> DataFrame:
    """(source, target, distance, lca) for classes with a common ancestor; of equal ones the deepest is taken."""
    depth = reach.groupBy(F.col("class").alias("ancestor")).agg(F.max("steps").alias("depth"))
    up = reach.join(depth, "ancestor")
    pairs = up.alias("a").join(up.alias("b"), F.col("a.ancestor") == F.col("b.ancestor"))
    total = F.col("a.steps") + F.col("b.steps")
    return pairs.groupBy(F.col("a.class").alias("source"), F.col("b.class").alias("target")).agg(F.min(total).cast("long").alias("distance"), F.max_by(F.col("a.ancestor"), F.col("a.depth")).alias("lca"))


def distances_of(reach: DataFrame, pairs: DataFrame) -> DataFrame:
    """(source, target, distance, depth_gap) of the pairs (source, target) that have a common ancestor."""
    up = lambda side: reach.select(F.col("class").alias(side), "ancestor", F.col("steps").alias(f"{side}_steps"))
    met = pairs.select("source", "target").distinct().join(up("source"), "source").join(up("target"), ["target", "ancestor"])
    near = met.groupBy("source", "target").agg(F.min(F.col("source_steps") + F.col("target_steps")).cast("long").alias("distance"))
    depth = reach.groupBy("class").agg(F.max("steps").alias("depth"))
    both = near.join(depth.toDF("source", "d1"), "source").join(depth.toDF("target", "d2"), "target")
    return both.select("source", "target", "distance", F.abs(F.col("d1") - F.col("d2")).alias("depth_gap"))


def similarity(distance: Column, source: Column, target: Column, depth_gap: Column) -> Column:
    """1 for equal classes, falling with distance, less where a class is generic or far apart in depth."""
    base = F.when(distance == 0, 1.0).when(distance == 1, 0.83).when(distance == 2, 0.66).when(distance == 3, 0.50).when(distance == 4, 0.33).otherwise(F.greatest(F.lit(0.10), 1.0 - 0.18 * distance))
    a, b = source.isin(V.GENERIC_CLASSES), target.isin(V.GENERIC_CLASSES)
    penalty = F.when(a & b, 0.85).when(a | b, 0.75).when(F.abs(depth_gap) >= 3, 0.85).otherwise(1.0)
    return F.when(source == target, 1.0).when(distance >= 999, 0.0).otherwise(base * penalty)


def closed_world(entities: DataFrame, classes: DataFrame, cls: str = "class") -> DataFrame:
    """Keep a class that the ontology has and that says something; else null, with the reason."""
    known = classes.select(F.col("class").alias("__known")).distinct()
    generic = F.coalesce(F.col(cls), F.lit("")).isin(V.NOT_IN_ONTOLOGY)
    joined = entities.join(known, F.col(cls) == F.col("__known"), "left")
    reason = F.when(F.coalesce(F.trim(cls), F.lit("")) == "", "missing_class").when(generic, "generic_class").when(F.col("__known").isNull(), "class_not_in_ontology")
    return joined.withColumn("rejection", reason).withColumn(cls, F.when(F.col("rejection").isNull(), F.col(cls))).withColumn("ontology_match", F.col("rejection").isNull()).drop("__known")


def preferred_label(labels: DataFrame, key: str, order: tuple[str, ...] = ("es", "en", "")) -> DataFrame:
    """The label in the first language of the order that a class has."""
    at = F.array_position(F.array(*[F.lit(x) for x in order]), F.coalesce("lang", F.lit("")))
    rank = F.when(at > 0, at).otherwise(F.lit(len(order) + 1))
    return labels.groupBy(key).agg(F.min_by("label", F.struct(rank.alias("r"), F.col("label").alias("l"))).alias("label"))


def catalog(triples: DataFrame) -> DataFrame:
    """(class, label_es, label_en, parents) from triples: declared classes, labels by language, direct parents."""
    declared = triples.filter("predicate LIKE '%type' AND (object LIKE '%owl#Class' OR object LIKE '%rdf-schema#Class')").select(F.col("subject").alias("class")).distinct()
    label = lambda lang: F.max(F.when((F.col("lang") == lang) & F.col("predicate").endswith("label"), F.col("object")))
    facts = triples.groupBy(F.col("subject").alias("class")).agg(label("es").alias("label_es"), label("en").alias("label_en"), F.array_sort(F.collect_set(F.when(F.col("predicate").endswith("subClassOf"), F.col("object")))).alias("parents"))
    return declared.join(facts, "class", "left")
