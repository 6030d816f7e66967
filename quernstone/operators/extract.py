"""Candidate names from blocks, and the pruning of names that others contain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.functions import text as X
from quernstone.functions import vocabulary as V

#: A run of capitalised words, which may be tied by particles.
NAME = r"\p{Lu}[\p{L}'’-]*(?:\s+(?:(?:de|del|la|las|los|el|y|e|of|the)\s+){0,3}\p{Lu}[\p{L}'’-]*)*"


def split_parts(text: Column) -> Column:
    """The parts of a listing that stand between separators."""
    return F.filter(F.transform(F.split(text, r"\s*(?:;|·|\||\s/\s)\s*"), lambda x: F.trim(x)), lambda p: p != "")


def candidates(blocks: DataFrame, keys: list[str], shortest: int = 4, most_words: int = 18) -> DataFrame:
    """(keys, pos, name, source_text): distinct plausible names of each page, in the order they are met."""
    parts = blocks.select(*keys, F.col("pos").alias("block"), F.col("text").alias("source_text"), F.posexplode(split_parts(F.col("text"))).alias("part", "piece"))
    found = parts.select(*keys, "block", "part", "source_text", F.posexplode(F.regexp_extract_all("piece", F.lit(NAME), F.lit(0))).alias("at", "raw"))
    named = found.withColumn("name", X.strip_edges(F.col("raw"), ["de", "del", "la", "el", "los", "las", "y", "the", "of"], ["de", "del", "la", "el", "los", "las", "y", "the", "of"]))
    words = F.size(F.split("name", " "))
    fair = named.filter((F.length("name") >= shortest) & (words <= most_words) & ((words >= 2) | F.lower("name").isin(V.ANCHOR_WORDS)))
    order = F.row_number().over(Window.partitionBy(*keys, F.lower("name")).orderBy("block", "part", "at"))
    first = fair.withColumn("__n", order).filter("__n = 1")
    pos = F.row_number().over(Window.partitionBy(*keys).orderBy("block", "part", "at"))
    return first.select(*keys, pos.alias("pos"), "name", F.substring("source_text", 1, 500).alias("source_text"))


def drop_contained(names: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """Drop names that a longer name of the same page contains as whole words.

    Pages' names meet on a shared word, so no page's names are all paired.
    """
    row = names.withColumn("__lower", F.lower(name))
    words = row.select(*keys, "__lower", F.explode(F.array_distinct(F.split("__lower", " "))).alias("word"))
    first = row.select(*keys, F.col("__lower").alias("__short"), F.split("__lower", " ").getItem(0).alias("word"))
    padded = lambda c: F.concat(F.lit(" "), F.col(c), F.lit(" "))
    inside = first.join(words, [*keys, "word"]).filter((F.length("__lower") > F.length("__short")) & F.contains(padded("__lower"), padded("__short")))
    gone = inside.select(*keys, F.col("__short").alias("__lower")).distinct()
    return row.join(gone, [*keys, "__lower"], "left_anti").select(names.columns)
