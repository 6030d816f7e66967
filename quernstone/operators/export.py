"""Exports: triples, Turtle, nested pages, Markdown, graph and map pages, and the sinks that write them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import text as X

# Namespaces of the graph.
ENTITY_NS = "http://example.org/entity/"
TERM_NS = "http://example.org/tourism/"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS_LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
XSD_FLOAT = "http://www.w3.org/2001/XMLSchema#float"


def triples(entities: DataFrame, subject: Column, literals: dict[str, str], floats: dict[str, str], label: str) -> DataFrame:
    """(subject, predicate, object, datatype): one row for each value that is there, unpivoted in one pass."""
    def fact(predicate: str, value: Column, kind: str | None = None) -> Column:
        return F.struct(F.lit(predicate).alias("predicate"), value.cast("string").alias("object"), F.lit(kind).cast("string").alias("datatype"))

    facts = [fact(RDF_TYPE, F.lit(TERM_NS + "Entity"), "iri"), fact(RDFS_LABEL, X.nz(F.col(label)))]
    facts += [fact(TERM_NS + name, X.nz(F.col(column).cast("string"))) for name, column in literals.items()]
    facts += [fact(TERM_NS + name, F.col(column).cast("double"), XSD_FLOAT) for name, column in floats.items()]
    rows = entities.select(F.concat(F.lit(ENTITY_NS), subject).alias("subject"), F.explode(F.array(*facts)).alias("f"))
    return rows.select("subject", "f.*").filter("object IS NOT NULL").distinct()


def turtle_lines(graph: DataFrame) -> DataFrame:
    """A statement a line, which is Turtle and N-Triples alike."""
    escaped = F.replace(F.replace(F.replace("object", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    value = F.when(F.col("datatype") == "iri", F.concat(F.lit("<"), "object", F.lit(">"))).when(F.col("datatype").isNotNull(), F.concat(F.lit('"'), escaped, F.lit('"^^<'), "datatype", F.lit(">"))).otherwise(F.concat(F.lit('"'), escaped, F.lit('"')))
    return graph.select(F.concat(F.lit("<"), "subject", F.lit("> <"), "predicate", F.lit("> "), value, F.lit(" .")).alias("value"))


def hierarchy(entities: DataFrame, page: str, key: str, parent: str, payload: list[str]) -> DataFrame:
    """(page, count, roots): each page's root entities with their children nested.

    A row whose parent is missing on its page is a root.
    """
    node = F.struct(*payload)
    children = entities.filter(F.col(parent).isNotNull()).groupBy(F.col(page).alias("__page"), F.col(parent).alias("__parent")).agg(F.array_sort(F.collect_list(node)).alias("children"))
    known = entities.select(F.col(page).alias("__p"), F.col(key).alias("__k")).distinct()
    placed = entities.join(known, (F.col(page) == F.col("__p")) & (F.col(parent) == F.col("__k")), "left")
    roots = placed.filter("__k IS NULL").join(children, (F.col(page) == F.col("__page")) & (F.col(key) == F.col("__parent")), "left")
    whole = F.struct(*payload, F.coalesce("children", F.array()).alias("children"))
    nested = roots.groupBy(page).agg(F.array_sort(F.collect_list(whole)).alias("roots"))
    return entities.groupBy(page).agg(F.count(F.lit(1)).alias("entity_count")).join(nested, page, "left")


def markdown_row(*cells: Column) -> Column:
    """A row of a Markdown table; bars and line breaks in cells are escaped."""
    fine = [F.regexp_replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), r"\s*\n\s*", " ") for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *fine), F.lit(" |"))


def markdown_section(name: Column, cls: Column, score: Column, description: Column) -> Column:
    """An entity's part of the report."""
    return F.concat_ws("\n", F.concat(F.lit("## "), name), F.concat(F.lit("- Class: "), F.coalesce(cls, F.lit("Unknown"))), F.concat(F.lit("- Score: "), F.round(score, 2).cast("string")), F.when(F.trim(description) != "", F.concat(F.lit("\n"), F.trim(description))))


def graph_nodes_edges(entities: DataFrame, name: str, related: str) -> tuple[DataFrame, DataFrame]:
    """Names and addresses as nodes, and the links between them."""
    edges = entities.select(F.col(name).alias("source"), F.explode(related).alias("target")).distinct()
    nodes = entities.select(F.col(name).alias("node"), F.lit("entity").alias("kind")).unionByName(edges.select(F.col("target").alias("node"), F.lit("url").alias("kind"))).distinct()
    return nodes, edges


def centroid(points: DataFrame, default: tuple[float, float]) -> DataFrame:
    """The mean point, or the default where there is none."""
    return points.agg(F.coalesce(F.avg("lat"), F.lit(default[0])).alias("lat"), F.coalesce(F.avg("lng"), F.lit(default[1])).alias("lng"))


def write_entities(entities: DataFrame, path: str) -> None:
    entities.write.mode("overwrite").json(path)


def write_by(entities: DataFrame, column: str, path: str) -> None:
    """A folder for each value: classes, audit buckets."""
    entities.write.mode("overwrite").partitionBy(column).json(path)


def write_delimited(rows: DataFrame, path: str, sep: str = ";") -> None:
    rows.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("overwrite").text(path)


def graph_page(nodes: list[str], edges: list[tuple[str, str]]) -> str:
    """A static page of a small graph; the caller bounds what it collects for a picture."""
    import html
    import json

    rows = "".join(f"<li>{html.escape(a)} → {html.escape(b)}</li>" for a, b in edges)
    return f"<!DOCTYPE html><meta charset='utf-8'><title>Graph</title><script type='application/json'>{json.dumps({'nodes': nodes, 'edges': edges}).replace('</', '<\\/')}</script><ul>{rows}</ul>"


def map_page(points: list[tuple[str, float, float]], centre: tuple[float, float]) -> str:
    """A static page of markers."""
    import html

    rows = "".join(f"<li data-lat='{lat}' data-lng='{lng}'>{html.escape(name)}</li>" for name, lat, lng in points)
    return f"<!DOCTYPE html><meta charset='utf-8'><title>Map</title><body data-lat='{centre[0]}' data-lng='{centre[1]}'><ul>{rows}</ul>"
