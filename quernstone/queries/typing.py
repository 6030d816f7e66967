"""Typing, plausibility and evaluation matching, on rows that make their rules speak."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.operators import evaluation, ontology, plausible, typing
from quernstone.queries.common import Literal, Registry, quoted, table

REGISTRY = Registry()

MENTIONS = Literal("id long, mention string, context string, description string, page string, expected string, declared string, seen_as string, likeness double", [
    (1, "Catedral de Burgos", "La catedral gótica", "Visita la catedral", "catedral burgos", None, None, None, None),
    (2, "Visitas guiadas", "", "", "", None, None, None, None),
    (3, "Plaza Mayor", "", "", "", None, "Place", None, None),
    (4, "Hotel Tres Reyes", "habitaciones y recepción", "Hotel de cuatro estrellas", "hoteles en pamplona", "hotel", "Hotel", None, None),
    (5, "Café Iruña", "bar y pintxos en la plaza", "Pintxos y cafetería", "bares", None, "FoodEstablishment", None, None),
    (6, "Txoko", "", "", "", None, None, None, None),
    (7, "El Mirador", "fecha y horario del concierto", "", "", "event", None, None, None),
    (8, "Mercado de Santo Domingo", "puestos de producto local", "Mercado con puestos", "mercados", None, None, None, None),
    (9, "Parque natural de Urbasa", "sendero y ruta", "", "", None, None, "NaturalPark", 0.91),
    (10, "San Fermín", "", "", "", None, None, None, None),
    (11, "Casa consistorial", "", "", "", None, None, None, None),
    (12, "Torre del Rey", "iglesia y museo junto al puente", "", "", "Place", "http://x/onto#Tower", "Tower", 0.80),
    (13, None, None, None, None, None, None, None, None),
    (14, "Restaurante Rodero", "cocina", "Menú degustación y cocina", "donde comer", None, "restaurant", None, None),
    (15, "Ciclo de cine", "programacion", "Festival y conciertos", "agenda", "festival", None, None, None),
    (16, "Muralla y baluarte", "", "Sistema defensivo", "", None, "Organization", "Wall", 0.75),
    (17, "Bodega Otazu", "visita guiada, ruta del vino", "Bodega y plato", "tours", None, "TourismService", None, None),
    (18, "Estación de autobuses", "", "", "", None, None, None, None),
    (19, "Museoa", "un museo, una capilla, un convento, un teatro y un acuario", "", "", None, None, None, None),
    (20, "Trucha a la navarra", "", "", "", None, None, None, None),
])

_PLAIN = lambda c: f"trim(regexp_replace(strip_accents(lower(coalesce({c}, ''))), '[^a-z0-9]+', ' ', 'g'))"
_LABEL = lambda c: f"regexp_extract(rtrim(coalesce({c}, ''), '/'), '([^#/]*)$', 1)"
_ALIASES = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in typing.ALIASES.items())
_WEIGH = "CASE WHEN EXISTS (SELECT 1 FROM goes g WHERE g.family = f.family) AND NOT EXISTS (SELECT 1 FROM goes g WHERE g.family = f.family AND g.label = v.label) THEN 0.45 ELSE 1.0 END"
_TYPE_SQL = rf"""WITH {MENTIONS.values('m')},
alias(k, label) AS (VALUES {_ALIASES}),
lexical(ord, words, label, weight) AS (VALUES {", ".join(f"({k}, {quoted(w)}, {quoted(c)}, {s})" for k, (w, c, s) in enumerate(typing.LEXICAL))}),
said(words, label, weight) AS (VALUES {", ".join(f"({quoted(w)}, {quoted(c)}, {s})" for w, c, s in typing.DESCRIPTION_VOTES)}),
goes(family, label) AS (VALUES {", ".join(f"({quoted(k)}, {quoted(c)})" for k, v in typing.FAMILY_CLASSES.items() for c in v)}),
generic(label) AS (VALUES {", ".join(f"({quoted(c)})" for c in typing.GENERIC)}),
n AS (SELECT *, {_PLAIN('mention')} AS name, {_PLAIN('context')} AS around, {_PLAIN('description')} AS told, ' || ' || {_PLAIN('page')} AS onpage FROM m),
f AS (SELECT *, CASE {" ".join(f"WHEN regexp_matches(name, {quoted(chr(92) + 'b(' + w + ')' + chr(92) + 'b')}) THEN {quoted(k)}" for k, w in typing.FAMILY_WORDS)}
  WHEN regexp_matches(name || ' ' || around, '\b({typing.EVENT_CONTEXT})\b') THEN 'event' ELSE 'unknown' END AS family FROM n),
raw AS (
  SELECT id, label, weight FROM f JOIN lexical ON regexp_matches(name, '\b(' || words || ')\b')
  UNION ALL {" UNION ALL ".join(f"SELECT id, {quoted(c)}, {s} FROM f WHERE {' OR '.join(f'starts_with(name, {quoted(h)})' for h in heads)}" for heads, c, s in typing.MENTION_HEADS)}
  UNION ALL {" UNION ALL ".join("SELECT id, " + quoted(c) + ", CASE WHEN " + (" OR ".join(f"starts_with(name, {quoted(h)})" for h in heads) or "FALSE") + f" THEN {strong} ELSE {weak} END FROM f WHERE (" + " OR ".join(f"contains(onpage, {quoted(w)})" for w in on) + ") AND (" + " OR ".join([f"contains(name, {quoted(w)})" for w in words] + [f"starts_with(name, {quoted(h)})" for h in heads]) + ")" for on, heads, words, c, strong, weak in typing.PAGE_VOTES)}
  UNION ALL SELECT id, label, weight FROM f JOIN said ON regexp_matches(told, '\b(' || words || ')\b')
  UNION ALL SELECT id, coalesce(a.label, {_LABEL('expected')}), 1.1 FROM f LEFT JOIN alias a ON a.k = {_PLAIN(_LABEL('expected'))} WHERE expected IS NOT NULL
  UNION ALL SELECT id, coalesce(a.label, {_LABEL('declared')}), 2.0 FROM f LEFT JOIN alias a ON a.k = {_PLAIN(_LABEL('declared'))} WHERE declared IS NOT NULL
  UNION ALL SELECT id, coalesce(a.label, {_LABEL('seen_as')}), CASE WHEN likeness >= 0.86 THEN 2.4 ELSE 1.1 END FROM f LEFT JOIN alias a ON a.k = {_PLAIN(_LABEL('seen_as'))} WHERE likeness >= 0.74),
vote AS (
  SELECT f.id, v.label, v.weight * CASE WHEN v.label IN (FROM generic) THEN 0.35 ELSE 1.0 END * {_WEIGH} AS weight
  FROM raw v JOIN f USING (id) WHERE v.label <> '' AND v.label NOT IN ('Thing', 'Entity', 'Item', 'Location') AND lower(v.label) NOT IN ({", ".join(map(quoted, typing.WEAK))})),
strongest AS (SELECT id, max(s) AS s FROM (SELECT id, label, sum(weight) AS s FROM vote GROUP BY ALL) GROUP BY id),
behind AS (
  SELECT id, label, weight FROM (
    SELECT f.id, v.label, least(2.0, v.weight * 0.35) * CASE WHEN v.label IN (FROM generic) THEN 0.35 ELSE 1.0 END * {_WEIGH} AS weight, row_number() OVER (PARTITION BY f.id ORDER BY ord) AS k
    FROM f JOIN lexical v ON regexp_matches(f.around, '\b(' || v.words || ')\b') LEFT JOIN strongest t ON t.id = f.id WHERE coalesce(t.s, 0) < 5.0) WHERE k <= 4),
total AS (SELECT id, label, sum(weight) AS score, label IN (FROM generic) AS general FROM (FROM vote UNION ALL FROM behind) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER w AS k, coalesce(lead(score) OVER w, 0) AS second FROM total WINDOW w AS (PARTITION BY id ORDER BY score DESC, general, label)),
hard AS (SELECT id, CASE WHEN regexp_matches(name, '^({"|".join(typing.NO_ENTITY)})$') THEN 'Unknown|unknown|0' {" ".join(f"WHEN regexp_matches(name, {quoted(p)}) THEN {quoted(c + '|' + k + '|10')}" for p, c, k in typing.DECISIVE)} END AS said FROM f)
SELECT f.id, CASE WHEN said IS NOT NULL THEN split_part(said, '|', 1) WHEN r.id IS NULL OR general OR score < 3.2 OR score - second < CASE WHEN score >= 5.0 THEN 0.65 ELSE 1.0 END THEN 'Unknown' ELSE label END AS label,
  CASE WHEN said IS NOT NULL THEN split_part(said, '|', 2) ELSE f.family END AS family, round(CASE WHEN said IS NOT NULL THEN split_part(said, '|', 3)::DOUBLE ELSE coalesce(score, 0) END, 4) AS score,
  round(CASE WHEN said IS NOT NULL THEN split_part(said, '|', 3)::DOUBLE ELSE coalesce(score - second, 0) END, 4) AS margin
FROM f JOIN hard USING (id) LEFT JOIN ranked r ON r.id = f.id AND r.k = 1"""


@REGISTRY.add(_TYPE_SQL)
def entity_type_resolve(spark, sf_dir):
    none = F.lit(None).cast("string")
    declared = F.when(F.col("declared").isNotNull(), F.array(F.struct(F.lit("class").alias("source"), F.col("declared").alias("label"))))
    near = F.when(F.col("seen_as").isNotNull(), F.array(F.struct(F.col("seen_as").alias("label"), F.col("likeness").alias("score"))))
    found = typing.entity_type(F.col("mention"), F.col("context"), none, F.col("page"), none, F.col("description"), none, declared, F.col("expected"), none, near)
    return MENTIONS.frame(spark).select("id", found.alias("x")).select("id", "x.label", "x.family", "x.score", "x.margin")


RAW_TYPES = Literal("id long, raw string, name string", [
    (1, "Museum", ""), (2, "museo", ""), (3, "Hotel ", "x"), (4, "plaza de toros", ""), (5, "un festival de cine", ""), (6, "event_attendance_facility", ""), (7, "nada", "el Museo Oteiza"), (8, None, "taxi a Burgos"),
    (9, "sports center", ""), (10, "Public Service", ""), (11, "retail", ""), (12, "tourist-attraction", ""), (13, "Bus turístico", ""), (14, "cosa", "colegio y parking"), (15, "ESTACIÓN", ""), (16, "", ""),
    (17, "Centro_Cultural", ""), (18, "Thing", "catedral"), (19, "food establishment", ""), (20, "zzz", "zzz"),
])
_FOLD = lambda c: f"trim(regexp_replace(regexp_replace(strip_accents(lower(trim(coalesce({c}, '')))), '[_/-]+', ' ', 'g'), '\\s+', ' ', 'g'))"


@REGISTRY.add(rf"""WITH {RAW_TYPES.values('t')}, k AS (SELECT *, {_FOLD('raw')} AS key, {_FOLD("coalesce(name, '') || ' '")} AS said,
  list_aggregate(list_transform(list_filter(regexp_split_to_array(trim(coalesce(raw, '')), '[_\-\s]+'), lambda w: w <> ''), lambda w: upper(w[1]) || w[2:]), 'string_agg', '') AS joined FROM t),
valid(v) AS (VALUES {", ".join(f"({quoted(c)})" for c in evaluation.EVAL_TYPES)}), alias(a, c) AS (VALUES {", ".join(f"({quoted(a)}, {quoted(c)})" for a, c in evaluation.EVAL_ALIASES.items())}),
word(ord, w, c) AS (VALUES {", ".join(f"({n}, {quoted(w)}, {quoted(c)})" for n, (w, c) in enumerate(evaluation.EVAL_WORDS))}),
near(ord, w, c) AS (VALUES {", ".join(f"({n}, {quoted(w)}, {quoted(c)})" for n, (w, c) in enumerate(evaluation.EVAL_CONTEXT))}),
typed AS (SELECT *, coalesce((SELECT v FROM valid WHERE v = trim(raw)), (SELECT c FROM alias WHERE a = key), (SELECT arg_min(c, ord) FROM word WHERE contains(key, w)), (SELECT v FROM valid WHERE v = joined), 'Thing') AS type FROM k)
SELECT id, type, CASE WHEN type <> 'Thing' THEN type ELSE coalesce((SELECT arg_min(c, ord) FROM near WHERE regexp_matches(said, '\b' || w || '\b')), 'Thing') END AS in_context FROM typed""")
def eval_type_normalise(spark, sf_dir):
    rows = RAW_TYPES.frame(spark)
    return rows.select("id", evaluation.eval_type(F.col("raw")).alias("type"), evaluation.eval_type_in_context(F.col("raw"), F.col("name"), F.lit("")).alias("in_context"))


@REGISTRY.add(rf"""WITH e(k, v) AS (VALUES {", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in evaluation.TYPE_EQUIVALENCES.items())}),
t AS (SELECT DISTINCT lower(regexp_extract(url, '([^/#]*)/*$', 1)) AS raw, CASE WHEN page_id % 4 = 0 THEN 'http://x.org/onto#Hotel' WHEN page_id % 4 = 1 THEN 'LocalBusiness/' WHEN page_id % 4 = 2 THEN 'CultureCentre' ELSE 'Museum' END AS type, page_id FROM pages),
s AS (SELECT page_id, type, trim(regexp_replace(lower(type), '/+$', '')) AS low FROM t), l AS (SELECT page_id, CASE WHEN contains(low, '#') THEN split_part(low, '#', 2) ELSE regexp_extract(low, '([^/]*)$', 1) END AS local FROM s)
SELECT page_id, coalesce(v, local) AS type FROM l LEFT JOIN e ON k = local""")
def type_equivalence(spark, sf_dir):
    part = F.col("page_id") % 4
    raw = F.when(part == 0, "http://x.org/onto#Hotel").when(part == 1, "LocalBusiness/").when(part == 2, "CultureCentre").otherwise("Museum")
    return table(spark, sf_dir, "pages").select("page_id", evaluation.equivalent_type(raw).alias("type"))


CANDIDATES = Literal("id long, name string, cls string, page_type string, role string, description string", [
    (1, "", "Museum", "place_detail", "", ""), (2, "Palacio de", "Palace", "place_detail", "", ""), (3, "Continuamos hacia el puente", "Bridge", "place_detail", "", ""), (4, "Plaza de Madrid", "Square", "place_detail", "", ""),
    (5, "Qué ver", "Square", "place_detail", "", ""), (6, "Plaza Mayor", "", "place_detail", "", ""), (7, "Plaza Mayor", "Concept", "place_detail", "", ""), (8, "Plaza Mayor", "Square", "blog_page", "related_entity", ""),
    (9, "Casa Grande", "Museum", "place_detail", "", ""), (10, "La catedral vieja", "Cathedral", "place_detail", "", ""), (11, "Catedral", "Cathedral", "place_detail", "", ""), (12, "Castillo Viejo", "Castle", "place_detail", "", ""),
    (13, "Los fueros de Navarra", "Monument", "blog_page", "", ""), (14, "Todos los lugares, qué ver", "Bridge", "listing_page", "", ""), (15, "Palacio Museo Real", "Palace", "category_page", "", ""),
    (16, "Aa bb cc dd ee ff gg", "Place", "blog_page", "", ""), (17, "Bar a b c d e f g h i j", "Bar", "blog_page", "", ""), (18, "Puente viejo", "Bridge", "blog_page", "", "categorias " * 121), (19, "Puente viejo", "Bridge", "blog_page", "", "corta"),
    (20, "Monumento a los fueros", "Monument", "place_detail", "", ""), (21, "Monumentos y más", "Monument", "place_detail", "", ""), (22, "Ayuntamiento de Pamplona", "TownHall", "place_detail", "", ""), (23, "Ayuntamiento ruta tour", "TownHall", "place_detail", "", ""),
    (24, "San Fermín Txikito", "Event", "place_detail", "", ""), (25, "Fiestas de San Fermín concierto", "Event", "place_detail", "", ""), (26, "Festival Flamenco", "Event", "place_detail", "", ""), (27, "Museo del Prado", "Museum", "place_detail", "", ""),
    (28, "Castillo de Javier", "Castle", "place_detail", "", ""), (29, "Catedral de Burgos", "Cathedral", "place_detail", "", ""), (30, None, None, None, None, None),
])


@REGISTRY.add()
def candidate_verdict(spark, sf_dir):
    rows = CANDIDATES.frame(spark)
    verdict = plausible.candidate_verdict(*[F.col(c) for c in ("name", "cls", "page_type", "role", "description")])
    return rows.select("id", verdict.alias("reason"), plausible.canonical_by_class(F.col("name"), F.col("cls")).alias("name"), plausible.monument_replacement(F.col("name"), F.lit("")).alias("instead"))


TRUE_ENTITIES = Literal("gt_id long, url string, name string, type string", [(1, "a", "Museo del Prado", "museo"), (2, "a", "Café Gijón", "bar"), (3, "b", "Catedral de Burgos", "Cathedral"), (4, "c", "Nada", "Hotel"), (5, "b", "Plaza Mayor", "Square")])
PREDICTED = Literal("url string, name string, type string, rank long", [("a", "Museo Prado", "Museum", 1), ("a", "museo del prado", "Monument", 2), ("a", "Cafe Gijon", "FoodEstablishment", 3), ("b", "Catedral de Burgos", "Church", 1), ("b", "Plaza", "Place", 2)])


@REGISTRY.add()
def truth_best_match(spark, sf_dir):
    reach = ontology.closure(ontology.edges(spark))
    return evaluation.best_pairs(TRUE_ENTITIES.frame(spark), PREDICTED.frame(spark), reach)
