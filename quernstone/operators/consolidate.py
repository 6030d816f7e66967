"""One record for each name, merged properties, images over all pages, page structure, and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.functions import text as X
from quernstone.functions import vocabulary as V
from quernstone.functions.rules import any_in, looked_up

# Fragments of portal text and of technical images.
PORTAL = ["te queda mucho por descubrir", "visita sevilla", "descubre la muy famosa"]
SITE_IMAGES = ["separador", "separator", "logo", "banner", "icon", "header", "footer"]


def longer(a: Column, b: Column) -> Column:
    """Of two values the longer, the first of equal ones."""
    return F.when(F.length(F.coalesce(b, F.lit(""))) > F.length(F.coalesce(a, F.lit(""))), b).otherwise(F.coalesce(a, b))


def merged_maps(a: Column, b: Column) -> Column:
    """Union of two maps; where both have a key the longer value stays."""
    return F.map_zip_with(F.coalesce(a, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), F.coalesce(b, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, x, y: longer(x, y))


def merge_properties(rows: DataFrame, key: str, properties: str) -> DataFrame:
    """(key, properties): each property's longest value, of equal ones the smallest, by entries rather than by rows."""
    entries = rows.select(key, F.explode(properties).alias("__k", "v")).filter(F.trim("v") != "")
    best = entries.groupBy(key, "__k").agg(F.min_by("v", F.struct(-F.length("v"), F.col("v"))).alias("v"))
    return best.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__k", "v")))).alias(properties))


def consolidated(rows: DataFrame, name: str = "name", cls: str = "class", score: str = "score", texts: tuple[str, ...] = ("short_description", "long_description"), firsts: tuple[str, ...] = ("phone", "email"), order: str = "pos") -> DataFrame:
    """One row for each canonical name.

    The largest score; the longest name; the class that the name implies, else that of the largest priority;
    the best text, portal phrases last; the first other value that is filled.
    """
    from quernstone.operators.scoring import leading_class

    keyed = rows.withColumn("key", X.canonical_name(F.col(name))).filter("key <> ''")
    rank = F.when(leading_class(F.col(name)) == F.col(cls), 1000).otherwise(F.coalesce(looked_up(V.MERGE_PRIORITY, F.col(cls)), F.lit(0)))
    worth = lambda c: F.when(F.trim(c) != "", F.length(F.trim(c)) - F.when(any_in(F.lower(c), PORTAL), 100).otherwise(0))
    best = lambda c: F.max_by(F.when(F.trim(c) != "", F.trim(c)), F.struct(worth(c), -F.col(order))).alias(c)
    first = lambda c: F.min_by(F.col(c), F.when(F.trim(c) != "", F.col(order))).alias(c)
    return keyed.groupBy("key").agg(
        F.max_by(name, F.struct(F.length(name), -F.col(order))).alias(name), F.max_by(cls, F.struct(F.when(F.col(cls).isNotNull(), rank), -F.col(order))).alias(cls),
        F.max(score).alias(score), *[best(c) for c in texts], *[first(c) for c in firsts], F.count(F.lit(1)).alias("n"),
    )


def unrepeated_images(rows: DataFrame, key: str, images: str, threshold: int = 5) -> DataFrame:
    """(key, images): images that fewer than ``threshold`` entities have and that aren't the site's own."""
    each = rows.select(key, F.posexplode(images).alias("pos", "image"))
    counts = each.groupBy("image").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") < threshold) & ~any_in(F.lower("image"), SITE_IMAGES))
    kept = each.join(counts, "image", "left_semi").groupBy(key).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("pos", "image"))), lambda x: x["image"])).alias(images))
    return rows.select(key).join(kept, key, "left").select(key, F.coalesce(images, F.array().cast("array<string>")).alias(images))


def promoted_images(rows: DataFrame, key: str, image: str, candidate: str) -> DataFrame:
    """(key, image): a missing image takes a candidate that no other entity has."""
    unique = rows.filter(F.trim(candidate) != "").groupBy(candidate).agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select(F.col(candidate).alias("__unique"))
    joined = rows.join(unique, rows[candidate] == F.col("__unique"), "left")
    fine = F.col("__unique").isNotNull() & ~any_in(F.lower(candidate), [*SITE_IMAGES, "placeholder", "avatar", "share", "social"])
    return joined.select(key, F.coalesce(X.nz(F.col(image)), F.when(fine, F.col(candidate))).alias(image))


def image_decision(entity_score: Column, context_score: Column, reason: Column) -> Column:
    """(accepted, reason): an image needs six points in all and four from the entity."""
    fine = (entity_score + context_score >= 6) & (entity_score >= 4)
    return F.struct((reason.isNull() & fine).alias("accepted"), F.coalesce(reason, F.when(~fine, "weak_image_affinity")).alias("reason"))


def page_structure(rows: DataFrame, page: str, key: str, primary: Column, route: Column, child: Column) -> DataFrame:
    """Adds structure, role, parent and relation: a route page with stops is hierarchical, others flat or single."""
    w = Window.partitionBy(page)
    marked = rows.withColumn("__primary", F.coalesce(primary, F.lit(False))).withColumn("__child", F.coalesce(child, F.lit(False)) & ~F.col("__primary"))
    head = F.min(F.when(F.col("__primary"), F.col(key))).over(w)
    nested = head.isNotNull() & F.max(F.coalesce(route, F.lit(False))).over(w) & (F.sum(F.col("__child").cast("int")).over(w) > 0)
    staged = marked.withColumn("__head", head).withColumn("structure", F.when(F.count(F.lit(1)).over(w) == 1, "single").when(nested, "hierarchical").otherwise("flat"))
    stop = (F.col("structure") == "hierarchical") & F.col("__child")
    role = (
        F.when((F.col("structure") == "single") | F.col("__primary"), "primary").when(stop, "child").when(F.col("structure") == "hierarchical", "secondary").otherwise("standalone")
    )
    return staged.withColumn("role", role).withColumn("parent", F.when(stop, F.col("__head"))).withColumn("relation", F.when(stop, F.lit("includesStop"))).drop("__primary", "__child", "__head")


def from_cache(wanted: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(found, missing): what a cache holds, and what an outside service would be asked for."""
    return wanted.join(cache, key), wanted.join(cache.select(key), key, "left_anti")


def best_candidate(candidates: DataFrame, key: str, score: Column, least: float, tie: str) -> DataFrame:
    """Each entity's best outside candidate that scores ``least`` or more."""
    scored = candidates.withColumn("candidate_score", score).filter(F.col("candidate_score") >= least)
    rest = [c for c in scored.columns if c != key]
    return scored.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("candidate_score", -F.col(tie))).alias("__best")).select(key, "__best.*")


def review_status(sample: DataFrame, entities: DataFrame, url: str, expected: str, found: str) -> DataFrame:
    """Each sampled page with how what was found compares with what was expected."""
    per = entities.groupBy(url).agg(F.array_sort(F.collect_set(found)).alias("found"))
    status = F.when(F.col("found").isNull(), "missing").when(F.array_contains("found", F.col(expected)), "matched").otherwise("different")
    return sample.join(per, url, "left").withColumn("status", status)
