"""Reports over entities, the gates they pass, and what plain text reveals of relations, events, places and classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import text as X
from quernstone.functions.rules import any_in, clamped, first_case, let, weighted


def report_entities(entities: DataFrame, name: str, order: str, score: str, texts: list[str], lists: list[str]) -> DataFrame:
    """One row for each name, case ignored: the largest score, the longest of each text, and all list items in order.

    Of equally long texts the first row's stays. Lists are united item by item, so a name that very many rows share
    gathers different items only.
    """
    keyed = entities.withColumn("key", F.lower(X.squeeze(F.col(name)))).filter("key <> ''")
    longest = [F.max_by(F.trim(t), F.struct(F.length(F.trim(t)), -F.col(order))).alias(t) for t in texts]
    base = keyed.groupBy("key").agg(F.min_by(name, order).alias(name), F.max(score).alias(score), F.count(F.lit(1)).alias("rows"), *longest)
    for column in lists:
        items = keyed.select("key", order, F.posexplode(column).alias("at", "item")).groupBy("key", "item").agg(F.min(F.struct(order, "at")).alias("first"))
        united = items.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "item"))), lambda x: x["item"]).alias(column))
        base = base.join(united, "key", "left").withColumn(column, F.coalesce(column, F.slice(F.array(F.lit("")), 1, 0)))
    return base


def in_report_order(entities: DataFrame, name: str, score: str) -> DataFrame:
    return entities.orderBy(F.coalesce(F.col(score), F.lit(0)).desc(), F.lower(name))


def by_count(rows: DataFrame, column: str) -> DataFrame:
    """Pages or types with their entities, the fullest first."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def best_images(images: DataFrame, keys: list[str], src: str, score: Column, tie: Column) -> DataFrame:
    """Each image address of an entity once, with its best score; of equal scores the one with the greatest ``tie`` counts.

    As with SQL's arg_max, rows without a score or a value take no part in that value.
    """
    rest = [c for c in images.columns if c not in (*keys, src)]
    best = [F.max_by(c, F.when(score.isNotNull() & F.col(c).isNotNull(), F.struct(score, tie))).alias(c) for c in rest]
    return images.groupBy(*keys, src).agg(F.max(score).alias("best_score"), *best)


def related_capped(urls: Column, own: Column, most: int = 10) -> Column:
    """The first different related addresses that aren't the entity's own."""
    return F.slice(F.array_distinct(F.filter(urls, lambda u: u.isNotNull() & (F.trim(u) != "") & ~u.eqNullSafe(own))), 1, most)


# How soon a page without entities is looked at.
ZERO_PRIORITY = {"likely_false_negative": 0, "review": 1, "expected_empty_if_following_links": 2, "correct_empty": 3}


def zero_pages_first(pages: DataFrame, label: str, family: str, url: str, most: int) -> DataFrame:
    """The pages to look at, the most urgent first; a report, so the limit is the feature."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in ZERO_PRIORITY.items() for x in p]), F.col(label)), F.lit(9))
    return pages.withColumn("priority", rank).orderBy("priority", family, url, label).limit(most)


# Words of interface in a name.
INTERFACE = ["click", "info", "home"]


def importance(name: Column, text: Column, score: Column, seen: Column, pictured: Column) -> Column:
    """How much a name matters: its score, its share of the text and of all texts, an image, and a name of fair length."""
    low = F.lower(name)
    local = F.when(low != "", (F.length(F.lower(text)) - F.length(F.replace(F.lower(text), low, F.lit("")))) / F.length(low)).otherwise(0)
    words = F.size(F.filter(F.split(low, r"\s+"), lambda w: w != ""))
    total = F.coalesce(score, F.lit(0.5)) + F.least(local * 0.1, F.lit(0.3)) + F.least(F.coalesce(seen, F.lit(0)) * 0.05, F.lit(0.3)) + weighted([(0.1, pictured), (0.1, words.between(2, 4)), (-0.3, any_in(low, INTERFACE))])
    return clamped(total, 0.0, 1.0)


# How text tells relations, and classes of a place's own.
RELATION_PATTERNS = [("located_in", r"([^\n]*?)", r" en ([A-ZÁÉÍÓÚÑ][a-záéíóúñ\s]+)"), ("near", r"([^\n]*?)", r" cerca de ([A-ZÁÉÍÓÚÑ][a-záéíóúñ\s]+)"), ("occurs_in", r"(Festival|Fiesta|Carnaval|Romería)[^\n]*", r" de ([A-ZÁÉÍÓÚÑ][a-záéíóúñ]+)")]
CLASS_PATTERNS = [("Route", r"Ruta de ([A-ZÁÉÍÓÚÑ][a-záéíóúñ]+)"), ("Festival", r"Festival de ([A-ZÁÉÍÓÚÑ][a-záéíóúñ]+)"), ("Event", r"(?:Carnaval|Fiesta|Romería) de ([A-ZÁÉÍÓÚÑ][a-záéíóúñ]+)"), ("Beach", r"Playa de ([A-ZÁÉÍÓÚÑ][a-záéíóúñ]+)"), ("NaturalSite", r"Parque Natural de ([A-ZÁÉÍÓÚÑ][a-záéíóúñ]+)")]
EVENT_WORDS = ["carnaval", "semana santa", "festival", "romería", "fiesta", "feria"]


def told_relations(text: Column) -> Column:
    """(subject, relation, object) that a text tells, pattern by pattern.

    A pattern is tried on the text up to its last object only; behind it every position would be tried in vain.
    """
    found = []
    for name, subject, rest in RELATION_PATTERNS:
        told = F.regexp_extract(text, rf"(?s)^.*{rest}", 0)
        one, two = (F.regexp_extract_all(told, F.lit(subject + rest), F.lit(k)) for k in (1, 2))
        found.append(_triples(one, name, two))
    return F.concat(*found)


def _triples(subjects: Column, relation: str, objects: Column) -> Column:
    return F.zip_with(subjects, objects, lambda s, o: F.struct(F.trim(s).alias("subject"), F.lit(relation).alias("relation"), F.trim(o).alias("object")))


def _suffixed(names: Column, base: str) -> Column:
    return F.transform(names, lambda n: F.concat(n, F.lit(base)))


def told_classes(text: Column) -> Column:
    """Classes that a text suggests, such as a place's own route."""
    return F.concat(*[_suffixed(F.regexp_extract_all(text, F.lit(p), F.lit(1)), base) for base, p in CLASS_PATTERNS])


def is_event(name: Column) -> Column:
    return any_in(F.lower(F.coalesce(name, F.lit(""))), EVENT_WORDS)


def known_places(docs: DataFrame, places: DataFrame, key: str, text: str, most_words: int = 4) -> DataFrame:
    """(key, place): the places of a gazetteer that a text names, as whole words.

    Runs of words are joined with the gazetteer by equality, so neither side is compared with all of the other.
    """
    plain = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    words = F.split(plain(F.col(text)), " ")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(most_words)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))), lambda k: F.array_join(F.slice("w", k, n), " "))))
    said = docs.select(key, words.alias("w")).select(key, F.explode(F.array_distinct(runs)).alias("run")).filter("run <> ''")
    return said.join(places.select(F.col("place"), plain(F.col("place")).alias("run")).dropDuplicates(["run"]), "run").select(key, "place").distinct()


def relation_allowed(relation: Column, object_class: Column) -> Column:
    """Whether a relation can point to a class."""
    plain = F.regexp_replace(F.lower(F.coalesce(relation, F.lit(""))), "[^a-z]", "")
    return (
        F.when(plain == "", False).when(plain.isin("locatedin", "islocatedin", "partof"), F.coalesce(object_class.isin("Place", "Landmark", "TouristAttraction"), F.lit(False)))
        .when(plain.isin("hasevent", "hosts", "celebrates"), F.coalesce(object_class == "Event", F.lit(False))).otherwise(True)
    )


# What each kind of page asks of an entity that fails the quality score.
PAGE_PROFILES = [("strict_listing", 2.2, True), ("listing", 2.6, True), ("detail_priority", 2.2, True), ("detail", 3.4, False)]


def page_profile(strict: Column, listing: Column, detail: Column) -> Column:
    """(name, rescue, review_ok) of a page."""
    as_struct = lambda p: F.struct(F.lit(p[0]).alias("name"), F.lit(p[1]).alias("rescue"), F.lit(p[2]).alias("review_ok"))
    return F.when(strict, as_struct(PAGE_PROFILES[0])).when(listing, as_struct(PAGE_PROFILES[1])).when(detail, as_struct(PAGE_PROFILES[2])).otherwise(as_struct(PAGE_PROFILES[3]))


def quality_gate(profile: Column, decision: Column, quality: Column, evidence: Column, anchored: Column, primary: Column, abstract: Column) -> Column:
    """(keep, why, score): whether an entity passes, why it was rescued, and its combined score."""
    def judged(x: Column) -> Column:
        p, fails = x["p"], x["decision"] == "discard"
        rescued = fails & (x["evidence"] >= p["rescue"]) & (x["anchored"] | ((p["name"] == "detail_priority") & x["primary"])) & ~x["abstract"]
        why = first_case([("tourism_evidence", rescued), ("review_allowed_by_page_profile", (x["decision"] == "review") & p["review_ok"])], "")
        return F.struct((~fails | rescued).alias("keep"), why.alias("why"), (F.floor((x["quality"] + F.greatest(F.lit(0.0), x["evidence"]) * 0.6) * 1000 + 0.5) / 1000).alias("score"))

    yes = lambda c: F.coalesce(c, F.lit(False))
    number = lambda c: F.coalesce(c, F.lit(0.0))
    return let(judged, p=profile, decision=decision, quality=number(quality), evidence=number(evidence), anchored=yes(anchored), primary=yes(primary), abstract=yes(abstract))


def calibrated(score: Column, bad_name: Column, valid_class: Column, name: Column) -> Column:
    """A model's score within 0 and 1, less where the name or class is doubtful, and never quite certain."""
    total = clamped(score, 0.0, 1.0) * F.when(bad_name, 0.15).otherwise(1.0) * F.when(valid_class, 1.0).otherwise(0.10) * F.when(F.size(F.split(X.squeeze(name), " ")) == 1, 0.80).otherwise(1.0)
    return F.round(F.when(total > 0.95, 0.92).otherwise(total), 4)


def guarded(items: DataFrame, name: str, cls: str, score: str, order: str, bad_name: Column, valid_class: Column, least: float = 0.45) -> DataFrame:
    """A model's items that name something, of a valid class and a fair score, each name and class once."""
    fair = items.filter((X.squeeze(F.col(name)) != "") & ~bad_name & valid_class & (F.coalesce(F.col(score), F.lit(0.0)) >= least))
    key = [F.lower(X.squeeze(F.col(name))).alias("__n"), F.lower(F.trim(cls)).alias("__c")]
    return fair.groupBy(*key).agg(F.min_by(F.struct(*items.columns), order).alias("__row")).select("__row.*")


def enrichment_context(heading: Column, link: Column, source: Column, context: Column, page_text: Column, routed: Column, least: int = 140) -> Column:
    """What is said about an entity: around it, each part once, and the beginning of the page where that is little."""
    blank = lambda c: X.squeeze(F.coalesce(c, F.lit("")))
    parts = F.filter(F.array(*[blank(c) for c in (heading, link, source, context)]), lambda p: p != "")
    keyed = F.transform(parts, lambda p: F.struct(X.canonical_name(p).alias("k"), p.alias("p")))
    once = F.aggregate(keyed, F.slice(keyed, 1, 0), lambda seen, x: F.when(F.exists(seen, lambda y: y["k"] == x["k"]) | (x["k"] == ""), seen).otherwise(F.concat(seen, F.array(x))))

    def judged(x: Column) -> Column:
        merged, page = x["merged"], F.coalesce(x["page"], F.lit(""))
        return (
            F.when(F.length(merged) >= least, merged).when(x["routed"] & (page != ""), F.trim(F.concat_ws(" ", merged, F.substring(page, 1, 1200))))
            .when(merged != "", merged).otherwise(F.substring(page, 1, 800))
        )

    return let(judged, merged=F.array_join(F.transform(once, lambda x: x["p"]), " "), page=page_text, routed=F.coalesce(routed, F.lit(False)))
