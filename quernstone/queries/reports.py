"""Report, gate and discovery queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.operators import reports
from quernstone.queries.common import Registry, any_of, quoted, table

REGISTRY = Registry()


@REGISTRY.add("""WITH r AS (SELECT lower(source) AS key, doc_id, source, n_chars, coalesce(trim(substring(text, 1, 40)), '') AS said, lang FROM documents),
l AS (SELECT key, lang, min(doc_id) AS first FROM r WHERE lang IS NOT NULL GROUP BY ALL)
SELECT r.key, arg_min(source, doc_id) AS source, max(n_chars) AS n_chars, count(*) AS rows, md5(arg_max(said, (length(said), -doc_id))) AS said, (SELECT string_agg(lang, ',' ORDER BY first) FROM l WHERE l.key = r.key) AS langs
FROM r WHERE r.key <> '' GROUP BY r.key""")
def report_dedupe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", F.coalesce(F.trim(F.substring("text", 1, 40)), F.lit("")).alias("said"), F.array("lang").alias("langs"))
    merged = reports.report_entities(docs, "source", "doc_id", "n_chars", ["said"], ["langs"])
    return merged.select("key", "source", "n_chars", "rows", F.md5("said").alias("said"), F.concat_ws(",", "langs").alias("langs"))


@REGISTRY.add("SELECT user_id, event_type, max(value) AS best_score, arg_max(event_id, value) AS event_id FROM events GROUP BY ALL")
def best_image_per_source(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    # The first event of equal values, as DuckDB has it on one thread; its SQL leaves that open.
    return reports.best_images(events, ["user_id"], "event_type", F.col("value"), F.bitwise_not("event_id")).select("user_id", "event_type", "best_score", "event_id")


_PRIORITY = "CASE lang " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in (("en", "review"), ("de", "likely_false_negative"), ("fr", "correct_empty"))) + " ELSE 'odd' END"


@REGISTRY.add(f"""SELECT doc_id, label, priority FROM (SELECT doc_id, {_PRIORITY} AS label, source, CASE {_PRIORITY} WHEN 'likely_false_negative' THEN 0 WHEN 'review' THEN 1 WHEN 'correct_empty' THEN 3 ELSE 9 END AS priority FROM documents)
ORDER BY priority, source, doc_id, label LIMIT 40""")
def zero_page_priority(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.expr(_PRIORITY).alias("label"))
    return reports.zero_pages_first(docs, "label", "source", "doc_id", 40).select("doc_id", "label", "priority")


# Some texts tell of places, which the invented prose doesn't.
_TOLD = "CASE doc_id % 5 WHEN 0 THEN 'La Ruta de Leyre en Navarra. ' WHEN 1 THEN 'Festival de Olite y Playa de Zarautz. ' WHEN 2 THEN 'Un puente cerca de Burgos. ' ELSE '' END || text"
_CLASSES = " || ".join(f"list_transform(regexp_extract_all(said, {quoted(p)}, 1), lambda x: x || {quoted(c)})" for c, p in reports.CLASS_PATTERNS)


@REGISTRY.add(f"WITH t AS (SELECT doc_id, {_TOLD} AS said FROM documents) SELECT doc_id, array_to_string({_CLASSES}, ',') AS classes, {any_of('lower(said)', reports.EVENT_WORDS)} AS event FROM t")
def discovered_classes(spark, sf_dir):
    said = table(spark, sf_dir, "documents").select("doc_id", F.expr(_TOLD).alias("said"))
    return said.select("doc_id", F.concat_ws(",", reports.told_classes(F.col("said"))).alias("classes"), reports.is_event(F.col("said")).alias("event"))


_TELLS = " UNION ALL ".join(f"SELECT doc_id, {quoted(n)} AS relation, unnest(regexp_extract_all(said, {quoted(s + p)}, 1)) AS subject, unnest(regexp_extract_all(said, {quoted(s + p)}, 2)) AS object FROM t" for n, s, p in reports.RELATION_PATTERNS)


@REGISTRY.add(rf"WITH t AS (SELECT doc_id, {_TOLD} AS said FROM documents) SELECT doc_id, relation, md5(trim(subject)) AS subject, md5(trim(object)) AS object, (relation <> 'located_in') AS allowed FROM ({_TELLS})")
def told_relations(spark, sf_dir):
    said = table(spark, sf_dir, "documents").select("doc_id", F.explode(reports.told_relations(F.expr(_TOLD))).alias("r"))
    allowed = reports.relation_allowed(F.when(F.col("r.relation") == "located_in", "locatedIn").otherwise(F.col("r.relation")), F.lit("Museum"))
    return said.select("doc_id", "r.relation", F.md5("r.subject").alias("subject"), F.md5("r.object").alias("object"), allowed.alias("allowed"))


_RUN = r"' ' || trim(regexp_replace(lower(c.c_name || ' lives in ' || n.n_name), '[^\p{L}\p{N}]+', ' ', 'g')) || ' '"


@REGISTRY.add(rf"SELECT c.c_custkey, p.n_name AS place FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN nation p ON contains({_RUN}, ' ' || trim(regexp_replace(lower(p.n_name), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' ')")
def gazetteer_places(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    said = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat("c_name", F.lit(" lives in "), "n_name").alias("said"))
    return reports.known_places(said, nation.select(F.col("n_name").alias("place")), "c_custkey", "said")


_SCORE = "(event_id % 11)::DOUBLE"
_DECIDED = "CASE WHEN event_id % 3 = 0 THEN 'discard' WHEN event_id % 3 = 1 THEN 'review' ELSE 'promote' END"


@REGISTRY.add(f"""WITH e AS (SELECT event_id, {_DECIDED} AS decision, {_SCORE} AS quality, value / 100 AS evidence, event_type = 'click' AS strict, event_type = 'view' AS listing, event_type = 'signup' AS detail, event_id % 2 = 0 AS anchored, event_id % 5 = 0 AS main, event_id % 7 = 0 AS abstract FROM events),
p AS (SELECT *, CASE WHEN strict THEN 2.2 WHEN listing THEN 2.6 WHEN detail THEN 2.2 ELSE 3.4 END AS rescue, strict OR listing OR detail AS review_ok FROM e),
r AS (SELECT *, decision = 'discard' AND evidence >= rescue AND (anchored OR (detail AND NOT listing AND NOT strict AND main)) AND NOT abstract AS rescued FROM p)
SELECT event_id, decision <> 'discard' OR rescued AS keep, CASE WHEN rescued THEN 'tourism_evidence' WHEN decision = 'review' AND review_ok THEN 'review_allowed_by_page_profile' ELSE '' END AS why, floor((quality + greatest(0, evidence) * 0.6) * 1000 + 0.5) / 1000 AS score FROM r""")
def quality_gate(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    i, kind = F.col("event_id"), F.col("event_type")
    decision = F.when(i % 3 == 0, "discard").when(i % 3 == 1, "review").otherwise("promote")
    gate = reports.quality_gate(reports.page_profile(kind == "click", kind == "view", kind == "signup"), decision, (i % 11).cast("double"), F.col("value") / 100, i % 2 == 0, i % 5 == 0, i % 7 == 0)
    return e.select("event_id", gate.alias("g")).select("event_id", "g.keep", "g.why", "g.score")


@REGISTRY.add("""WITH i AS (SELECT doc_id, source AS name, lang AS cls, n_chars / 1000.0 AS score FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY lower(trim(name)), lower(trim(cls)) ORDER BY doc_id) AS rn FROM i WHERE trim(name) <> '' AND length(name) >= 3 AND cls IN ('en', 'de', 'fr') AND score >= 0.45) SELECT doc_id, name, cls FROM k WHERE rn = 1""")
def model_guards(spark, sf_dir):
    items = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("name"), F.col("lang").alias("cls"), (F.col("n_chars") / 1000.0).alias("score"))
    return reports.guarded(items, "name", "cls", "score", "doc_id", F.length("name") < 3, F.col("cls").isin("en", "de", "fr")).select("doc_id", "name", "cls")
