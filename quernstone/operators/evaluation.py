"""Evaluation against ground truth, and audits of exported entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.functions import similarity as S
from quernstone.functions import text as X
from quernstone.functions.rules import first_case, let, looked_up
from quernstone.operators import ontology

# Classes of the evaluation, spellings of them, and words that tell one.
EVAL_TYPES = [
    "Thing", "Place", "Organization", "Service", "Concept", "Event", "TouristAttraction", "Monument", "Museum", "Castle", "Alcazar", "Basilica", "Cathedral", "Church", "Chapel", "ArcheologicalSite",
    "HistoricalOrCulturalResource", "Square", "TownHall", "BullRing", "SportsCenter", "CultureCenter", "ExhibitionHall", "EducationalCenter", "DestinationExperience", "RetailAndFashion", "TourismService",
    "Accommodation", "AccommodationEstablishment", "FoodEstablishment", "TransportInfrastructure", "EventOrganisationCompany", "EventAttendanceFacility", "PublicService", "Stadium",
]
EVAL_ALIASES = {
    "hotel": "AccommodationEstablishment", "hostel": "AccommodationEstablishment", "hostal": "AccommodationEstablishment", "apartamento turistico": "AccommodationEstablishment", "apartments": "AccommodationEstablishment",
    "restaurant": "FoodEstablishment", "restaurante": "FoodEstablishment", "bar": "FoodEstablishment", "cafeteria": "FoodEstablishment", "mercado gastronomico": "FoodEstablishment", "museum": "Museum", "museo": "Museum",
    "monument": "Monument", "monumento": "Monument", "castle": "Castle", "castillo": "Castle", "alcazar": "Alcazar", "basilica": "Basilica", "cathedral": "Cathedral", "catedral": "Cathedral", "church": "Church",
    "iglesia": "Church", "chapel": "Chapel", "capilla": "Chapel", "square": "Square", "plaza": "Square", "townhall": "TownHall", "ayuntamiento": "TownHall", "bullring": "BullRing", "plaza de toros": "BullRing",
    "sports center": "SportsCenter", "polideportivo": "SportsCenter", "culture center": "CultureCenter", "centro cultural": "CultureCenter", "exhibition hall": "ExhibitionHall", "sala de exposiciones": "ExhibitionHall",
    "educational center": "EducationalCenter", "academia": "EducationalCenter", "school": "EducationalCenter", "festival": "Event", "concierto": "Event", "evento": "Event", "destination experience": "DestinationExperience",
    "tourism service": "TourismService", "servicio turistico": "TourismService", "retail": "RetailAndFashion", "fashion": "RetailAndFashion", "shopping": "RetailAndFashion", "taxi": "TransportInfrastructure",
    "bus": "TransportInfrastructure", "train station": "TransportInfrastructure", "estacion": "TransportInfrastructure", "airport": "TransportInfrastructure", "public service": "PublicService", "parking": "PublicService",
    "aparcamiento": "PublicService", "stadium": "Stadium", "estadio": "Stadium", "event organisation company": "EventOrganisationCompany", "event organization company": "EventOrganisationCompany",
    "organizador de eventos": "EventOrganisationCompany",
}
EVAL_WORDS = [
    ("plaza de toros", "BullRing"), ("centro cultural", "CultureCenter"), ("sala de exposiciones", "ExhibitionHall"), ("bus turistico", "TransportInfrastructure"), ("autobus turistico", "TransportInfrastructure"),
    ("aparcamiento", "PublicService"), ("parking", "PublicService"), ("festival", "Event"), ("concierto", "Event"), ("evento", "Event"), ("hotel", "AccommodationEstablishment"), ("hostal", "AccommodationEstablishment"),
    ("restaurante", "FoodEstablishment"), ("cafeteria", "FoodEstablishment"), ("academia", "EducationalCenter"), ("museo", "Museum"), ("monumento", "Monument"), ("castillo", "Castle"), ("alcazar", "Alcazar"),
    ("basilica", "Basilica"), ("catedral", "Cathedral"), ("iglesia", "Church"), ("capilla", "Chapel"), ("plaza", "Square"), ("ayuntamiento", "TownHall"), ("taxi", "TransportInfrastructure"), ("estadio", "Stadium"),
]
EVAL_CONTEXT = [
    ("taxi", "TransportInfrastructure"), ("bus turistico", "TransportInfrastructure"), ("autobus turistico", "TransportInfrastructure"), ("festival", "Event"), ("concierto", "Event"), ("seminario", "Event"),
    ("congreso", "Event"), ("hotel", "AccommodationEstablishment"), ("hostal", "AccommodationEstablishment"), ("apartamento", "AccommodationEstablishment"), ("restaurante", "FoodEstablishment"),
    ("cafeteria", "FoodEstablishment"), ("mercado", "FoodEstablishment"), ("academia", "EducationalCenter"), ("colegio", "EducationalCenter"), ("centro cultural", "CultureCenter"), ("sala de exposiciones", "ExhibitionHall"),
    ("museo", "Museum"), ("castillo", "Castle"), ("alcazar", "Alcazar"), ("capilla", "Chapel"), ("catedral", "Cathedral"), ("iglesia", "Church"), ("basilica", "Basilica"), ("plaza de toros", "BullRing"),
    ("aparcamiento", "PublicService"), ("parking", "PublicService"), ("estadio", "Stadium"),
]

# Types that the looser comparison takes for another, in lower case.
TYPE_EQUIVALENCES = {
    "accomodationestablishment": "accommodationestablishment", "culturecentre": "culturecenter", "exibitionhall": "exhibitionhall", "eductionalcenter": "educationalcenter", "foodestablisment": "foodestablishment",
    "townh": "townhall", "tourismentity": "place", "thing": "place", "location": "place", "concept": "place", "touristattractionsite": "touristattraction", "historicalorculturalresource": "touristattraction",
    "culturalheritage": "touristattraction", "tourismresource": "touristattraction", "tourismorrelatedfacility": "tourismservice", "eventattendancefacility": "event", "partyandentertainmentfacility": "event",
    "localbusiness": "organization", "passengertransportcompany": "transportinfrastructure", "publictransportstop": "transportinfrastructure", "vehiclerentalcompany": "transportinfrastructure",
    "privatehirecompany": "transportinfrastructure", "aparthotel": "accommodationestablishment", "hostel": "accommodationestablishment", "hotel": "accommodationestablishment", "residence": "accommodationestablishment",
    "restaurant": "foodestablishment",
}


def _folded(c: Column) -> Column:
    """Lower case without accents; underscores, hyphens and slashes are spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(X.strip_accents(F.lower(F.trim(F.coalesce(c, F.lit(""))))), r"[_\-/]+", " "), r"\s+", " "))


def eval_type(c: Column) -> Column:
    """The evaluation's class of a raw one: itself, by alias, by a word in it, or by its words run together; else Thing."""
    def judged(x: Column) -> Column:
        words = F.filter(F.split(x["raw"], r"[_\-\s]+"), lambda w: w != "")
        joined = F.concat_ws("", F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))))
        told = first_case([(cls, F.contains(x["key"], F.lit(word))) for word, cls in EVAL_WORDS], None)
        known = lambda v: F.when(v.isin(EVAL_TYPES), v)
        return F.coalesce(known(x["raw"]), looked_up(EVAL_ALIASES, x["key"]), told, known(joined), F.lit("Thing"))

    return let(judged, raw=F.trim(F.coalesce(c, F.lit(""))), key=_folded(c))


def eval_type_in_context(c: Column, name: Column, page_text: Column) -> Column:
    """The evaluation's class, or where it is Thing the one that the name or the page tells."""
    def judged(x: Column) -> Column:
        told = first_case([(cls, x["said"].rlike(rf"\b{word}\b")) for word, cls in EVAL_CONTEXT], "Thing")
        return F.when(x["cls"] != "Thing", x["cls"]).otherwise(told)

    blank = lambda v: F.coalesce(v, F.lit(""))
    return let(judged, cls=eval_type(c), said=_folded(F.concat_ws(" ", blank(name), blank(page_text))))


def equivalent_type(c: Column) -> Column:
    """A type in lower case without its address, by its equivalence where it has one."""
    text = X.squeeze(F.regexp_replace(X.strip_accents(F.lower(F.trim(F.coalesce(c, F.lit(""))))), r"[^a-z0-9\s\-_#/.:]", " "))
    local = F.when(F.contains(text, F.lit("#")), F.substring_index(text, "#", -1)).otherwise(F.substring_index(F.regexp_replace(text, "/+$", ""), "/", -1))
    return let(lambda x: F.coalesce(looked_up(TYPE_EQUIVALENCES, x["local"]), x["local"]), local=local)


def best_pairs(truth: DataFrame, found: DataFrame, reach: DataFrame, name_weight: float = 0.35, class_weight: float = 0.65) -> DataFrame:
    """Each true entity (gt_id, url, name, type) with its best prediction (url, name, type, rank) on the same page.

    Best is by overall, class and name similarity, then by the smaller rank; ``reach`` is the taxonomy's closure. An
    entity without a prediction on its page comes with nulls. Distances are looked up for the pairs of classes at hand.
    """
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", " "), r"\s+", " "))
    left = truth.select("gt_id", "url", F.col("name").alias("gt_name"), eval_type(F.col("type")).alias("gt_type"), X.eval_name(F.col("name")).alias("gt_key"))
    right = found.select("url", F.col("name").alias("pred_name"), eval_type(F.col("type")).alias("pred_type"), X.eval_name(F.col("name")).alias("pred_key"), "rank")
    pairs = left.join(right, "url", "left")
    asked = pairs.filter("pred_type IS NOT NULL").select(F.col("gt_type").alias("source"), F.col("pred_type").alias("target")).distinct()
    measured = ontology.distances_of(reach, asked)
    same = F.coalesce(F.col("gt_type") == F.col("pred_type"), F.lit(False))
    joined = pairs.join(measured.withColumnsRenamed({"source": "gt_type", "target": "pred_type"}), ["gt_type", "pred_type"], "left")
    distance = F.when(same, F.lit(0)).otherwise(F.col("distance"))
    close = F.when(same, 1.0).when(F.col("pred_type").isNull(), None).otherwise(F.round(ontology.similarity(F.coalesce("distance", F.lit(999)), F.col("gt_type"), F.col("pred_type"), F.coalesce("depth_gap", F.lit(0))), 6))
    scored = joined.withColumn("class_distance", distance.cast("long")).withColumn("class_similarity", close).withColumn("name_similarity", F.round(S.ratio(plain(F.col("gt_key")), plain(F.col("pred_key"))), 6))
    scored = scored.withColumn("global_similarity", F.round(name_weight * F.col("name_similarity") + class_weight * F.col("class_similarity"), 6))
    columns = ["url", "gt_name", "gt_type", "pred_name", "pred_type", "rank", "class_distance", "class_similarity", "name_similarity", "global_similarity", (F.col("gt_key") == F.col("pred_key")).alias("exact_name"), same.alias("exact_type")]
    order = F.struct("global_similarity", "class_similarity", "name_similarity", -F.coalesce("rank", F.lit(9999)), "pred_name")
    best = scored.groupBy("gt_id").agg(F.max_by(F.struct(*columns), order).alias("x"), F.first(F.struct("url", "gt_name", "gt_type"), True).alias("t"))
    own = lambda c: F.coalesce(f"x.{c}", f"t.{c}").alias(c)
    rest = ["pred_name", "pred_type", "rank", "class_distance", "class_similarity", "name_similarity", "global_similarity", "exact_name", "exact_type"]
    return best.select("gt_id", own("url"), own("gt_name"), own("gt_type"), *[F.col(f"x.{c}").alias(c) for c in rest]).withColumn("exact_match", F.col("exact_name") & F.col("exact_type"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def with_prf(df: DataFrame) -> DataFrame:
    """precision, recall and f1 from tp, fp and fn, 0 where undefined."""
    p, r = _ratio(F.col("tp"), F.col("tp") + F.col("fp")), _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    scored = df.withColumn("p", p).withColumn("r", r)
    return scored.select(*df.columns, F.round("p", 6).alias("precision"), F.round("r", 6).alias("recall"), F.round(_ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), 6).alias("f1"))


def confusion(truth: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys of both sides with flags in_truth and in_found."""
    left = truth.select(*keys).distinct().withColumn("in_truth", F.lit(True))
    right = found.select(*keys).distinct().withColumn("in_found", F.lit(True))
    return left.join(right, keys, "full_outer").fillna(False, ["in_truth", "in_found"])


def counts(flags: DataFrame, by: list[str]) -> DataFrame:
    """tp, fp and fn for each group."""
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).alias
    t, f = F.col("in_truth"), F.col("in_found")
    return flags.groupBy(*by).agg(one(t & f)("tp"), one(~t & f)("fp"), one(t & ~f)("fn"))


def micro(truth: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return with_prf(counts(confusion(truth, found, keys), []))


def by_type(truth: DataFrame, found: DataFrame, keys: list[str], type_column: str) -> DataFrame:
    return with_prf(counts(confusion(truth, found, [*keys, type_column]), [type_column]))


def worst(truth: DataFrame, found: DataFrame, keys: list[str], url: str, n: int) -> DataFrame:
    """The n urls with the lowest f1, then recall; a report, so the limit is the feature."""
    return with_prf(counts(confusion(truth, found, keys), [url]).filter("tp + fn > 0")).orderBy("f1", "recall", url).limit(n)


def error_mode(gt_name: Column, gt_type: Column, name: Column, cls: Column) -> Column:
    same_name, same_type = gt_name.eqNullSafe(name), gt_type.eqNullSafe(cls)
    return (
        F.when(F.coalesce(name, F.lit("")) == "", "NO_PRED").when(same_name & same_type, "OK").when(same_name, "TYPE_ONLY").when(same_type, "NAME_ONLY_UNLIKELY").otherwise("BOTH")
    )


def summary_columns() -> list[Column]:
    """Aggregates of pairs with exact_match, exact_type, class_distance, class_similarity, name_similarity."""
    share = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 6)
    overall = 0.35 * F.col("name_similarity") + 0.65 * F.col("class_similarity")
    return [
        F.count(F.lit(1)).alias("total_cases"), share(F.col("exact_match")).alias("exact_match_accuracy"), share(F.col("exact_type")).alias("exact_type_accuracy"),
        share(F.coalesce(F.col("class_distance") <= 1, F.lit(False))).alias("accuracy_at_1"), share(F.coalesce(F.col("class_distance") <= 2, F.lit(False))).alias("accuracy_at_2"),
        share(overall >= 0.75).alias("soft_accuracy"), F.round(F.avg("class_distance"), 6).alias("mean_class_distance"),
        F.round(F.avg("class_similarity"), 6).alias("mean_class_similarity"), F.round(F.avg(overall), 6).alias("mean_global_similarity"),
    ]


def evaluation_report(pairs: DataFrame, group: str) -> DataFrame:
    """The summary for each group and, in one pass, for all."""
    return pairs.rollup(group).agg(F.grouping(group).alias("is_total"), *summary_columns())


def histogram(df: DataFrame, column: str, most: int | None = None) -> DataFrame:
    """Values with their counts, the most common first, equal ones by value."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted if most is None else counted.orderBy(F.desc("n"), F.asc(column)).limit(most)


def class_stats(entities: DataFrame, cls: str, flags: dict[str, Column]) -> DataFrame:
    """Counts and shares by class, with the number of entities for which each flag holds."""
    total = F.sum(F.count(F.lit(1))).over(Window.partitionBy())  # over classes, which are few
    marks = [F.sum(F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0)).alias(n) for n, c in flags.items()]
    return entities.groupBy(cls).agg(F.count(F.lit(1)).alias("n"), F.round(100.0 * F.count(F.lit(1)) / total, 2).alias("percent"), *marks)


def main_prediction(entities: DataFrame, cls: str, score: str, least: float = 0.6) -> DataFrame:
    """The class with the most entities of a fair score, then the larger sum of scores."""
    fair = entities.filter((F.col(score) >= least) & (F.col(cls) != "Concept"))
    return fair.groupBy(cls).agg(F.count(F.lit(1)).alias("n"), F.sum(score).alias("total")).orderBy(F.desc("n"), F.desc("total"), cls).limit(1)


def audit(entities: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """All conditional counts of an audit in one pass."""
    return entities.agg(F.count(F.lit(1)).alias("total"), *[F.sum(F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0)).alias(n) for n, c in tests.items()])


def coverage(entities: DataFrame, present: Column, wanted: Column) -> DataFrame:
    n = F.sum(F.when(wanted, 1).otherwise(0))
    have = F.sum(F.when(wanted & present, 1).otherwise(0))
    return entities.agg(n.alias("wanted"), have.alias("present"), F.round(F.when(n > 0, 100.0 * have / n).otherwise(0.0), 2).alias("percent"))


def ambiguous_pairs(rows: DataFrame, key: str, label: str, most: int) -> DataFrame:
    """Pairs of labels that keys carry both of; the labels of one key are few, being a set of classes."""
    sets = rows.groupBy(key).agg(F.array_sort(F.collect_set(label)).alias("labels")).filter(F.size("labels") > 1)
    pairs = sets.select(F.explode("labels").alias("a"), "labels").select("a", F.explode("labels").alias("b")).filter("a < b")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "a", "b").limit(most)


def page_summary(pages: DataFrame, entities: DataFrame, url: str, cls: str) -> DataFrame:
    """Entities of each page and class, pages without any included with a null class."""
    per = entities.groupBy(url, cls).agg(F.count(F.lit(1)).alias("n"))
    return pages.select(url).distinct().join(per, url, "left").fillna(0, ["n"])


def count_histogram(pages: DataFrame, entities: DataFrame, url: str) -> DataFrame:
    """How many pages have how many entities."""
    per = entities.groupBy(url).agg(F.count(F.lit(1)).alias("entities"))
    return pages.select(url).distinct().join(per, url, "left").fillna(0, ["entities"]).groupBy("entities").agg(F.count(F.lit(1)).alias("pages"))


def grouped_split(rows: DataFrame, group: str, share: float, seed: int = 42) -> DataFrame:
    """A split that keeps groups whole: a group's hash decides, so it needs no pass over the others."""
    part = F.pmod(F.xxhash64(F.col(group).cast("string"), F.lit(seed)), F.lit(1000))
    return rows.withColumn("part", F.when(part < int(share * 1000), "fewshot").otherwise("validation"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions)
