"""Evaluation, audit and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import vocabulary as V
from quernstone.operators import evaluation, scoring
from quernstone.queries.common import Literal, Registry, any_of, case_first, quoted, sum_of, table

REGISTRY = Registry()

_PRF = "round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1"
_SIDES = """WITH truth AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS kind FROM labels),
found AS (SELECT d.doc_id, CASE WHEN regexp_matches(d.text, '[$%&#*]{3}|!!') THEN 'bad' ELSE 'good' END AS kind, d.lang FROM documents d JOIN labels USING (doc_id)),
flags AS (SELECT coalesce(t.doc_id, f.doc_id) AS doc_id, coalesce(t.kind, f.kind) AS kind, t.doc_id IS NOT NULL AS t, f.doc_id IS NOT NULL AS f FROM truth t FULL JOIN found f ON t.doc_id = f.doc_id AND t.kind = f.kind)"""
_COUNTS = "count(*) FILTER (t AND f) AS tp, count(*) FILTER (NOT t AND f) AS fp, count(*) FILTER (t AND NOT f) AS fn"


def _sides(spark, sf_dir):
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    truth = labels.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("kind"))
    guess = F.when(F.col("text").rlike("[$%&#*]{3}|!!"), "bad").otherwise("good")
    return truth, docs.select("doc_id", "lang", guess.alias("kind")).join(labels.select("doc_id"), "doc_id", "left_semi")


@REGISTRY.add(f"{_SIDES}, c AS (SELECT {_COUNTS} FROM flags) SELECT tp, fp, fn, {_PRF} FROM c")
def prf_micro(spark, sf_dir):
    return evaluation.micro(*_sides(spark, sf_dir), ["doc_id", "kind"])


@REGISTRY.add(f"{_SIDES}, c AS (SELECT kind, {_COUNTS} FROM flags GROUP BY kind) SELECT kind, tp, fp, fn, {_PRF} FROM c")
def prf_by_type(spark, sf_dir):
    return evaluation.by_type(*_sides(spark, sf_dir), ["doc_id"], "kind")


@REGISTRY.add(f"{_SIDES} SELECT doc_id, kind, t AS in_truth, f AS in_found FROM flags")
def set_tp_fp_fn(spark, sf_dir):
    return evaluation.confusion(*_sides(spark, sf_dir), ["doc_id", "kind"])


@REGISTRY.add(f"""{_SIDES}, g AS (SELECT doc_id % 20 AS page, {_COUNTS} FROM flags GROUP BY 1),
s AS (SELECT page, tp, fp, fn, {_PRF} FROM g WHERE tp + fn > 0) SELECT * FROM s ORDER BY f1, recall, page LIMIT 10""")
def worst_urls(spark, sf_dir):
    truth, found = (side.withColumn("page", F.col("doc_id") % 20) for side in _sides(spark, sf_dir))
    return evaluation.worst(truth, found, ["page", "doc_id", "kind"], "page", 10)


@REGISTRY.add("""SELECT l.doc_id, CASE WHEN d.text IS NULL OR d.lang = '' THEN 'NO_PRED' WHEN d.lang = 'en' AND l.quality = l.toxic THEN 'OK' WHEN d.lang = 'en' THEN 'TYPE_ONLY'
WHEN l.quality = l.toxic THEN 'NAME_ONLY_UNLIKELY' ELSE 'BOTH' END AS error_mode FROM labels l LEFT JOIN documents d USING (doc_id)""")
def error_modes(spark, sf_dir):
    joined = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "left")
    return joined.select("doc_id", evaluation.error_mode(F.lit("en"), F.col("quality"), F.col("lang"), F.col("toxic")).alias("error_mode"))


_PAIRS = "SELECT lang, quality = toxic AS exact_match, quality = 1 AS exact_type, CASE WHEN doc_id % 7 < 5 THEN doc_id % 5 END AS class_distance, CASE WHEN quality = 1 THEN 1.0 ELSE 0.5 END AS class_similarity, CASE WHEN toxic = 1 THEN 0.25 ELSE 1.0 END AS name_similarity FROM labels JOIN documents USING (doc_id)"
_SUMMARY = """count(*) AS total_cases, round(avg(CASE WHEN exact_match THEN 1.0 ELSE 0.0 END), 6) AS exact_match_accuracy, round(avg(CASE WHEN exact_type THEN 1.0 ELSE 0.0 END), 6) AS exact_type_accuracy,
round(avg(CASE WHEN class_distance <= 1 THEN 1.0 ELSE 0.0 END), 6) AS accuracy_at_1, round(avg(CASE WHEN class_distance <= 2 THEN 1.0 ELSE 0.0 END), 6) AS accuracy_at_2,
round(avg(CASE WHEN 0.35 * name_similarity + 0.65 * class_similarity >= 0.75 THEN 1.0 ELSE 0.0 END), 6) AS soft_accuracy, round(avg(class_distance), 6) AS mean_class_distance,
round(avg(class_similarity), 6) AS mean_class_similarity, round(avg(0.35::DOUBLE * name_similarity::DOUBLE + 0.65::DOUBLE * class_similarity::DOUBLE), 6) AS mean_global_similarity"""


@REGISTRY.add(f"SELECT lang, grouping(lang)::BIGINT AS is_total, {_SUMMARY} FROM ({_PAIRS}) GROUP BY ROLLUP(lang)")
def acc_at_k_summary(spark, sf_dir):
    pairs = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").select(
        "lang", (F.col("quality") == F.col("toxic")).alias("exact_match"), (F.col("quality") == 1).alias("exact_type"), F.when(F.col("doc_id") % 7 < 5, F.col("doc_id") % 5).alias("class_distance"),
        F.when(F.col("quality") == 1, 1.0).otherwise(0.5).alias("class_similarity"), F.when(F.col("toxic") == 1, 0.25).otherwise(1.0).alias("name_similarity"),
    )
    return evaluation.evaluation_report(pairs, "lang").withColumn("is_total", F.col("is_total").cast("long"))


@REGISTRY.add("""SELECT source, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM documents), 2) AS percent, count(*) FILTER (lang = 'en') AS english, count(*) FILTER (n_chars > 2000) AS long FROM documents GROUP BY source""")
def entity_stats(spark, sf_dir):
    return evaluation.class_stats(table(spark, sf_dir, "documents"), "source", {"english": F.col("lang") == "en", "long": F.col("n_chars") > 2000})


@REGISTRY.add("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE value >= 0.6 AND event_type <> 'Concept' GROUP BY event_type ORDER BY n DESC, total DESC, event_type LIMIT 1")
def main_prediction(spark, sf_dir):
    return evaluation.main_prediction(table(spark, sf_dir, "events"), "event_type", "value").withColumn("total", F.round("total", 4))


@REGISTRY.add("SELECT count(*) AS total, count(*) FILTER (text = '') AS empty_text, count(*) FILTER (regexp_matches(text, 'Ç|ƒ|Â')) AS mojibake, count(*) FILTER (n_chars > 5000) AS very_long, count(*) FILTER (contains(text, '@')) AS at_signs FROM documents")
def audit_count_if(spark, sf_dir):
    text = F.col("text")
    return evaluation.audit(table(spark, sf_dir, "documents"), {"empty_text": text == "", "mojibake": text.rlike("Ç|ƒ|Â"), "very_long": F.col("n_chars") > 5000, "at_signs": F.contains(text, F.lit("@"))})


@REGISTRY.add("SELECT sum(CASE WHEN lang = 'en' THEN 1 ELSE 0 END) AS wanted, sum(CASE WHEN lang = 'en' AND n_chars > 1000 THEN 1 ELSE 0 END) AS present, round(100.0 * sum(CASE WHEN lang = 'en' AND n_chars > 1000 THEN 1 ELSE 0 END) / sum(CASE WHEN lang = 'en' THEN 1 ELSE 0 END), 2) AS percent FROM documents")
def coverage_pct(spark, sf_dir):
    return evaluation.coverage(table(spark, sf_dir, "documents"), F.col("n_chars") > 1000, F.col("lang") == "en")


_REASONS = [("short", "n_chars < 300"), ("long", "n_chars > 3000"), ("table", "contains(text, ' | ')"), ("shouting", "contains(text, '!!')")]


@REGISTRY.add(f"SELECT reason, count(*) AS n FROM ({' UNION ALL '.join(f'SELECT {quoted(n)} AS reason FROM documents WHERE {c}' for n, c in _REASONS)}) GROUP BY reason")
def reason_histogram(spark, sf_dir):
    from quernstone.functions.rules import reasons

    found = reasons([(n, F.expr(c)) for n, c in _REASONS])
    return evaluation.histogram(table(spark, sf_dir, "documents").select(F.explode(found).alias("reason")), "reason")


@REGISTRY.add(f"""SELECT doc_id, array_to_string(list_sort(list_filter([{", ".join(f"CASE WHEN {c} THEN {quoted(n)} END" for n, c in _REASONS)}], lambda x: x IS NOT NULL AND NOT (lang = 'en' AND x IN ('long', 'table')))), ',') AS reasons FROM documents""")
def reason_exemptions(spark, sf_dir):
    from quernstone.functions.rules import reasons

    found = reasons([(n, F.expr(c)) for n, c in _REASONS])
    left = F.when(F.col("lang") == "en", F.array_except(found, F.array(F.lit("long"), F.lit("table")))).otherwise(found)
    return table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(",", left).alias("reasons"))


# Invented entities, for rules about Spanish names that the tables don't have.
ENTITIES = Literal(
    "id long, name string, cls string, page_type string, role string, description string, lat double, image string, merged long, matched boolean, extraction double",
    [
        (1, "Catedral de Burgos", "Cathedral", "place_detail", "primary_resource", "La catedral es un monumento del patrimonio, con ruta y visita guiada por su historia y su claustro.", 42.34, "specific", 2, True, 4.0),
        (2, "Catedral", "Cathedral", "unknown", "", "", None, "missing", 1, True, 1.0),
        (3, "Castillo Viejo", "Castle", "listing_page", "related_entity", "Leer más", None, "candidates", 1, False, 2.5),
        (4, "Plaza Mayor", "Square", "place_detail", "primary_resource", "Plaza", 40.1, "rejected", 1, True, 3.0),
        (5, "Ruta del vino de", "Route", "blog_page", "", "Ruta y fiesta cultural", None, "none", 1, True, 0.2),
        (6, "Contacto", "Unknown", "unknown", "", "newsletter", None, "none", 1, False, 0.5),
        (7, "", "Museum", "unknown", "", "Sin nombre", None, "none", 1, True, 0.0),
        (8, "Museo y plaza del puente viejo", "Place", "category_page", "", "Museo", None, "generic", 3, False, 5.5),
        (9, "Madrid centro", "Place", "unknown", "", "Turismo", None, "none", 1, False, 1.0),
        (10, "Monumento a San Fermín en la plaza del ayuntamiento viejo", "Monument", "place_detail", "standalone_candidate", "Escultura y homenaje a la fiesta", 42.8, "specific", 1, True, 2.0),
        (11, "Iglesia de Santa María", None, "place_detail", "", "Iglesia", None, "none", 1, True, 1.5),
        (12, "Servicio de guías", "TourismService", "professional_page", "", "ES EN FR IT PT DE Servicio", None, "missing", 1, True, 9.0),
    ],
)


@REGISTRY.add(f"""WITH {ENTITIES.values('e')}, t AS (SELECT *, lower(name) AS nm, lower(description) AS ctx, len(list_filter(string_split(name, ' '), lambda x: x <> '')) AS words FROM e),
s AS (SELECT id, CASE WHEN nm = '' THEN -5.0 ELSE round({sum_of("nm", V.EVIDENCE_NAME)} + {sum_of("ctx", V.EVIDENCE_CONTEXT)}
 + CASE WHEN words >= 2 THEN 0.7 ELSE 0 END + CASE WHEN lat IS NOT NULL THEN 1.2 ELSE 0 END + CASE WHEN image = 'specific' THEN 0.8 ELSE 0 END - CASE WHEN words >= 6 THEN 2.0 ELSE 0 END
 - 2.5 * ({" + ".join(f"CASE WHEN contains(nm || ' ' || ctx, {quoted(b)}) THEN 1 ELSE 0 END" for b in V.EVIDENCE_AGAINST)}), 3) END AS score FROM t)
SELECT id, CAST(score AS DOUBLE) AS score, CASE WHEN score >= 4.0 THEN 'strong' WHEN score >= 1.5 THEN 'medium' ELSE 'weak' END AS decision FROM s""")
def evidence_score(spark, sf_dir):
    e = ENTITIES.frame(spark)
    return e.select("id", scoring.evidence(F.col("name"), F.col("description"), F.lit(False), F.col("lat").isNotNull(), F.col("image") == "specific").alias("x")).select("id", "x.score", "x.decision")


def _rules():
    c = F.col
    return scoring.quality_rules(c("name"), c("cls"), c("matched"), c("description"), c("page_type"), c("role"), c("lat").isNotNull(), c("image"), c("merged"))


# The same conditions in DuckDB's words, by reason.
_QUALITY = {
    "has_name": (1.0, "trim(name) <> ''"), "good_name_length": (1.0, "words BETWEEN 2 AND 8"), "long_name": (-1.0, "words > 10"),
    "has_class": (1.5, "has_cls"), "ontology_match": (1.5, "has_cls AND matched"), "has_description": (1.0, "trim(description) <> ''"),
    "rich_description": (0.75, "length(trim(description)) >= 80"), "navigation_noise": (-2.0, "regexp_matches(lower(description), 'es\\s+en\\s+fr\\s+it\\s+pt\\s+de|(saber|leer|mostrar)\\s+m[aá]s')"),
    "missing_description": (-1.0, "trim(description) = ''"), "place_detail_page": (1.0, "page_type = 'place_detail'"),
    "weak_page_type": (-0.75, "page_type IN ('listing_page', 'category_page', 'blog_page', 'professional_page')"), "primary_resource": (1.0, "role = 'primary_resource'"),
    "related_entity": (-0.75, "role = 'related_entity'"), "has_coordinates": (1.25, "lat IS NOT NULL"),
    "missing_physical_coordinates": (-0.75, f"lat IS NULL AND cls IN ({', '.join(map(quoted, V.PHYSICAL_CLASSES))})"), "specific_image": (0.75, "image = 'specific'"),
    "only_weak_image_candidates": (-0.25, "image = 'candidates'"), "weak_image": (-0.5, "image IN ('missing', 'generic', 'rejected')"), "merged_evidence": (0.5, "merged > 1"),
}
_QSQL = f"""WITH {ENTITIES.values('e')}, t AS (SELECT *, len(list_filter(string_split(name, ' '), lambda x: x <> '')) AS words, coalesce(trim(cls) <> '', false) AS has_cls FROM e),
q AS (SELECT id, cls, has_cls, matched, extraction, greatest(0.0, least(10.0, round({" + ".join(f"CASE WHEN {c} THEN {w} ELSE 0.0 END" for w, c in _QUALITY.values())}, 2)))::DOUBLE AS quality,
 array_to_string(list_sort(list_filter([{", ".join(f"CASE WHEN {c} THEN {quoted(n)} END" for n, (_, c) in _QUALITY.items())}], lambda x: x IS NOT NULL)), ',') AS reasons FROM t)"""


@REGISTRY.add(f"{_QSQL} SELECT id, quality, reasons FROM q")
def quality_score(spark, sf_dir):
    score, reasons = scoring.export_quality(_rules())
    return ENTITIES.frame(spark).select("id", score.alias("quality"), F.concat_ws(",", reasons).alias("reasons"))


@REGISTRY.add(f"""{_QSQL}, s AS (SELECT id, round(greatest(0.0, least(10.0, extraction * 2.0)) * 0.2 + CASE WHEN has_cls AND matched THEN 1.0 WHEN has_cls THEN 0.65 ELSE 0.0 END * 10.0 * 0.3 + quality * 0.5, 2) AS score FROM q)
SELECT id, score, CASE WHEN score >= 7.0 THEN 'promote' WHEN score >= 4.5 THEN 'review' ELSE 'weak' END AS decision FROM s""")
def export_score(spark, sf_dir):
    quality, _ = scoring.export_quality(_rules())
    final = scoring.final_score(F.col("extraction"), scoring.ontology_score(F.col("cls"), F.col("matched")), quality)
    return ENTITIES.frame(spark).select("id", final.alias("x")).select("id", "x.score", "x.decision")


_STRICT = "page_type IN ('listing_page', 'category_page', 'blog_page', 'professional_page')"
_LIST = lambda words: ", ".join(map(quoted, words))


@REGISTRY.add(f"""WITH {ENTITIES.values('e')}, t AS (SELECT *, lower(trim(name)) AS nm, len(list_filter(string_split(name, ' '), lambda x: x <> '')) AS words FROM e)
SELECT id, {case_first([
    ("missing_name", "nm = ''"), ("truncated_name_tail", " OR ".join([f"ends_with(nm, {quoted(t)})" for t in V.TRUNCATED_TAILS] + [f"starts_with(nm, {quoted(t)})" for t in V.TRUNCATED_HEADS])),
    ("context_fragment_name", any_of("nm", V.CONTEXT_FRAGMENTS)), ("out_of_scope_name", any_of("nm", V.OUT_OF_SCOPE)), ("utility_or_navigation_page", f"nm IN ({_LIST(V.UTILITY_NAMES)})"),
    ("missing_primary_class", "coalesce(trim(cls), '') = ''"), ("non_final_generic_class", f"cls IN ({_LIST(V.NON_FINAL_CLASSES)})"), ("related_entity_on_strict_page", f"role = 'related_entity' AND {_STRICT}"),
    ("implausible_cathedral_structure", "cls = 'Cathedral' AND NOT regexp_matches(nm, '^(catedral |conjunto catedralicio)')"),
    ("implausible_castle_structure", "cls = 'Castle' AND NOT regexp_matches(nm, '^castillo (de|del|de la|de los|de las) ')"),
    ("composite_navigation_name_on_strict_page", f"{_STRICT} AND len(list_intersect(string_split(nm, ' '), [{_LIST(V.ANCHOR_WORDS)}])) >= 2 AND NOT regexp_matches(nm, '^rutas? ')"),
    ("generic_on_strict_page", f"{_STRICT} AND cls IN ('Place', 'Service', 'Organization') AND words > 6"), ("name_too_long_on_strict_page", f"{_STRICT} AND words > 10")], quoted("keep"))} AS reason FROM t""")
def first_failing_reason(spark, sf_dir):
    c = F.col
    return ENTITIES.frame(spark).select("id", scoring.candidate_reason(c("name"), c("cls"), c("page_type"), c("role")).alias("reason"))


_WORD = lambda words: "regexp_matches(' ' || regexp_replace(nm, '[^a-z0-9áéíóúñ]+', ' ', 'g') || ' ', " + quoted(" (" + "|".join(words) + ") ") + ")"


@REGISTRY.add(f"""WITH {ENTITIES.values('e')}, t AS (SELECT *, lower(trim(name)) AS nm FROM e)
SELECT id, CASE WHEN cls IN ({_LIST(V.GENERIC_TYPES)}) THEN {case_first([(c, _WORD(w)) for w, c in V.RESCUE_RULES], "cls")} ELSE cls END AS rescued FROM t""")
def ordered_rescue_rules(spark, sf_dir):
    return ENTITIES.frame(spark).select("id", scoring.rescued_class(F.col("cls"), F.col("name")).alias("rescued"))


@REGISTRY.add(f"""WITH {ENTITIES.values('e')}, t AS (SELECT *, lower(trim(name || ' ' || description)) AS nm FROM e)
SELECT id, {case_first([(n, any_of("nm", w)) for n, w in V.FAMILY_KEYWORDS.items()], quoted("unknown"))} AS family FROM t""")
def entity_family(spark, sf_dir):
    return ENTITIES.frame(spark).select("id", scoring.family(F.concat_ws(" ", "name", "description")).alias("family"))


@REGISTRY.add(f"""WITH {ENTITIES.values('e')}, t AS (SELECT *, strip_accents(lower(trim(description))) AS ctx, trim(regexp_replace(regexp_replace(strip_accents(lower(name)), '\\b(la|el|los|las|un|una|de|del|al)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS own FROM e),
r AS (SELECT id, own, lower(trim(name)) AS nm, {case_first([(n, any_of("ctx", w)) for n, w in scoring.RELATIONS], quoted(""))} AS relation FROM t)
SELECT id, relation, {case_first([("ui_noise", f"own = '' OR nm IN ({_LIST(V.BLOCK_SHORT_UI)})"), ("primary_resource", "own = 'plaza mayor' OR contains('plaza mayor', own) OR contains(own, 'plaza mayor')"),
    ("related_entity", "relation IN ('nearby', 'located_in', 'editorial_reference')"), ("location_context", "regexp_matches(strip_accents(nm), '^(calle|plaza|avenida|avda|paseo|camino) ')")], quoted("standalone_candidate"))} AS role FROM r""")
def mention_role_case(spark, sf_dir):
    return ENTITIES.frame(spark).select("id", scoring.relation_hint(F.col("description")).alias("relation"), scoring.mention_role(F.col("name"), F.lit("Plaza Mayor"), F.col("description")).alias("role"))


@REGISTRY.add(f"""WITH {ENTITIES.values('e')}, c AS (
 SELECT id, t AS label, 5 AS bonus FROM (SELECT id, cls AS t FROM e) WHERE t IS NOT NULL UNION ALL SELECT id, 'Place', 2 FROM e UNION ALL SELECT id, 'Monument', 2 FROM e WHERE merged > 1),
p(label, priority) AS (VALUES {", ".join(f"({quoted(k)}, {v})" for k, v in V.TYPE_PRIORITY.items())}),
s AS (SELECT id, label, coalesce(priority, 50) + CASE WHEN label IN ({_LIST(V.GENERIC_TYPES)}) THEN 0 ELSE 15 END + bonus AS score FROM c LEFT JOIN p USING (label))
SELECT id, label AS primary_class FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, lower(label)) AS rn FROM s) WHERE rn = 1""")
def class_priority(spark, sf_dir):
    types = F.when(F.col("merged") > 1, F.array(F.lit("Place"), F.lit("Monument"))).otherwise(F.array(F.lit("Place")))
    return ENTITIES.frame(spark).select("id", scoring.primary_class(F.col("cls"), types, F.lit(None).cast("string")).alias("primary_class"))
