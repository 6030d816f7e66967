"""Exports as rows: triples, Markdown, nested pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.operators import export
from quernstone.queries.common import Registry, quoted, table

REGISTRY = Registry()


@REGISTRY.add(f"""WITH s AS (SELECT {quoted(export.ENTITY_NS)} || 's' || s_suppkey AS subject, s_name, s_acctbal, s_nationkey FROM supplier)
SELECT DISTINCT * FROM (SELECT subject, {quoted(export.RDF_TYPE)} AS predicate, {quoted(export.TERM_NS + "Entity")} AS object, 'iri' AS datatype FROM s
UNION ALL SELECT subject, {quoted(export.RDFS_LABEL)}, s_name, NULL FROM s UNION ALL SELECT subject, {quoted(export.TERM_NS + "nation")}, CAST(s_nationkey AS VARCHAR), NULL FROM s)""")
def triples_unpivot(spark, sf_dir):
    return export.triples(table(spark, sf_dir, "supplier"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), {"nation": "s_nationkey"}, {}, "s_name")


@REGISTRY.add()
def turtle_rows(spark, sf_dir):
    graph = export.triples(table(spark, sf_dir, "supplier"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), {"name": "s_name"}, {"balance": "s_acctbal"}, "s_name")
    return export.turtle_lines(graph)


@REGISTRY.add()
def hierarchical_nest(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("line"), F.when(F.col("l_linenumber") > 1, 1).alias("parent"), F.col("l_partkey").alias("part"))
    return export.hierarchy(lines, "page", "line", "parent", ["line", "part"])


@REGISTRY.add("SELECT '| ' || c_custkey || ' | ' || replace(c_name, '|', '\\|') || ' | ' || c_mktsegment || ' |' AS row FROM customer")
def markdown_rows(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(export.markdown_row(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")).alias("row"))


@REGISTRY.add("SELECT n_name AS node, 'entity' AS kind FROM nation UNION SELECT r_name, 'url' FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)")
def graph_nodes(spark, sf_dir):
    joined = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return export.graph_nodes_edges(joined.select("n_name", F.array("r_name").alias("related")), "n_name", "related")[0]


@REGISTRY.add("SELECT round(avg(c_acctbal), 6) AS lat, round(avg(c_nationkey), 6) AS lng FROM customer")
def map_centroid(spark, sf_dir):
    points = table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("lat"), F.col("c_nationkey").cast("double").alias("lng"))
    return export.centroid(points, (0.0, 0.0)).select(F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"))
