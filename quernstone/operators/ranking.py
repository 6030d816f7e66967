"""Distinct, best-of, top-k and merging of records, each as one window or aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.functions import vocabulary as V
from quernstone.plans.scratch import stored


def digest(*columns: str) -> Column:
    """A 128-bit hash of columns that may be long texts, to group by in their place; null counts as a value."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"), F.struct(*[F.isnull(c).alias(f"n{k}") for k, c in enumerate(columns)]).alias("c"))


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in a total order. Long keys are compared by digest."""
    at = F.row_number().over(Window.partitionBy(digest(*keys)).orderBy(*order))
    return df.withColumn("__at", at).filter("__at = 1").drop("__at")


def best_of(df: DataFrame, keys: list[str], by: Column, name: str = "best") -> DataFrame:
    """The row with the largest ``by`` of each key, as an aggregation that combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias(name))
    return picked.select(*keys, f"{name}.*")


def top_k(df: DataFrame, keys: list[str], order: list, k: Column | int, rank: str = "rank", most: int | None = None) -> DataFrame:
    """The first ``k`` of each key; ``most`` bounds a ``k`` that differs by row, so that tasks drop the rest early."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = df.withColumn(rank, at)
    return (ranked if most is None else ranked.filter(F.col(rank) <= most)).filter(F.col(rank) <= k)


#: No page keeps more entities.
LARGEST_PAGE = 12


def page_limit(listing: Column, n: Column) -> Column:
    """How many entities a page keeps: five to twelve on a listing, else three to eight."""
    return F.when(listing, F.least(F.lit(LARGEST_PAGE), F.greatest(F.lit(5), n))).otherwise(F.greatest(F.lit(3), F.least(F.lit(8), n)))


def select_per_page(df: DataFrame, page: str, order: list, listing: str, penalty: str, most: int = 6) -> DataFrame:
    """The best entities of each page; those of a heavy penalty only if the page has no others."""
    fine = F.col(penalty) < most
    counts = df.groupBy(page).agg(F.sum(fine.cast("int")).alias("__fine"), F.count(F.lit(1)).alias("__n"))
    kept = df.join(counts, page).filter(fine | (F.col("__fine") == 0))
    return top_k(kept, [page], order, page_limit(F.col(listing), F.col("__n")), most=LARGEST_PAGE).drop("__fine", "__n")


def margins(df: DataFrame, keys: list[str], label: str, score: str) -> DataFrame:
    """Each key's best label, its score, and how far the second is behind."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(label))
    ranked = df.withColumn("__at", F.row_number().over(w)).withColumn("second", F.coalesce(F.lead(score).over(w), F.lit(0.0)))
    return ranked.filter("__at = 1").select(*keys, label, score, (F.col(score) - F.col("second")).alias("margin"))


def tally(votes: DataFrame, keys: list[str], label: str, weight: str) -> DataFrame:
    """Sums of votes for each label, generic labels weighed at 0.35."""
    w = F.when(F.col(label).isin(V.GENERIC_TYPES), F.col(weight) * 0.35).otherwise(F.col(weight))
    return votes.groupBy(*keys, label).agg(F.sum(w).alias("score"))


def elect(votes: DataFrame, keys: list[str], label: str, weight: str) -> DataFrame:
    """The elected label, Unknown where the score or the lead is too small or the label is generic."""
    best = margins(tally(votes, keys, label, weight), keys, label, "score")
    strong = (F.col("score") >= 3.2) & (F.col("margin") >= F.when(F.col("score") >= 5.0, 0.65).otherwise(1.0)) & ~F.col(label).isin(V.GENERIC_TYPES)
    return best.withColumn("elected", F.when(strong, F.col(label)).otherwise("Unknown"))


def suffixed_ids(df: DataFrame, base: str, order: list[str], name: str = "entity_id") -> DataFrame:
    """The base as the id; the second and later rows of a base get a number, in the order of columns.

    Rows are dealt out by ranges of base and order, numbered within a range, and raised by what lies before it, so a base
    that very many rows share is numbered by many tasks.
    """
    ranged = stored(df.repartitionByRange(base, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(base, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(base).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).select(F.col(base).alias("__base"), F.col("__part").alias("__at"), "__before")
    own = F.row_number().over(Window.partitionBy(base, "__part").orderBy(*order))
    joined = ranged.withColumn("__own", own).join(offsets, F.col(base).eqNullSafe(F.col("__base")) & (F.col("__part") == F.col("__at")))
    at = F.col("__own") + F.col("__before")
    return joined.withColumn(name, F.when(at == 1, F.col(base)).otherwise(F.concat(base, F.lit("_"), at.cast("string")))).select(*df.columns, name)


def dedupe_key(cls: Column, name: Column, identity: Column, lat: Column, lng: Column) -> Column:
    """Class and name for the classes that a name identifies, else the id, else name and place, else the name."""
    place = F.concat_ws("|", F.lit("namecoords"), name, F.round(lat, 4).cast("string"), F.round(lng, 4).cast("string"))
    return (
        F.when(cls.isin(V.CROSS_PAGE_CLASSES) & (name != ""), F.concat_ws("|", F.lit("classname"), F.lower(cls), name))
        .when(F.coalesce(identity, F.lit("")) != "", F.concat(F.lit("id|"), F.lower(identity)))
        .when(lat.isNotNull() & lng.isNotNull(), place)
        .otherwise(F.concat(F.lit("name|"), name))
    )


def merge_group(df: DataFrame, key: str, quality: list[Column], arrays: list[str], order: str) -> DataFrame:
    """One row for each key: the best row, with the union of its group's arrays and the number merged.

    ``quality`` are compared one after the other; of equal rows the first in ``order`` wins.
    """
    by = F.struct(*[q.alias(f"q{k}") for k, q in enumerate(quality)], (-F.col(order)).alias("first"))
    rest = [c for c in df.columns if c not in (key, *arrays)]
    unions = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(a)))).alias(a) for a in arrays]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), by).alias("__best"), *unions, F.count(F.lit(1)).alias("merged_count")).select(key, "__best.*", *arrays, "merged_count")


def union_capped(first: DataFrame, second: DataFrame, keys: list[str], group: str, order: list, cap: int) -> DataFrame:
    """Rows of both, one for each key, the first source ahead, at most ``cap`` in each group."""
    both = first.withColumn("__source", F.lit(0)).unionByName(second.withColumn("__source", F.lit(1)))
    once = keep_first(both, keys, ["__source", *order])
    return top_k(once, [group], ["__source", *order], cap).drop("__source")


def fill_missing(df: DataFrame, other: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A left join that only fills what is missing."""
    right = other.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = df.join(right, keys, "left")
    return joined.select(*[F.coalesce(c, f"__{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def rows_for_absent(wanted: DataFrame, have: DataFrame, candidates: DataFrame, key: str, order: list) -> DataFrame:
    """For each wanted key that ``have`` lacks, its best candidate."""
    absent = wanted.select(key).distinct().join(have.select(key).distinct(), key, "left_anti")
    return keep_first(candidates.join(absent, key, "left_semi"), [key], order)
