"""The conservative name filter: an additive score of a candidate name, with reasons; and the entity quality score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions import text as X
from quernstone.functions.rules import any_in, clamped, count_in, first_case, let, reasons, weighted

# Word lists of the name filter, without accents.
UI = ["ir al contenido", "reserva tu actividad", "todos los derechos reservados", "accesibilidad", "guias convention bureau", "area profesional", "ver mas", "leer mas", "mostrar mas", "google maps", "copiar direccion", "contacto", "newsletter", "suscribete", "apuntate", "mapas"]
NAVIGATION = ["inicio", "home", "siguiente", "anterior", "breadcrumb", "menu", "volver", "subir", "todos los lugares", "que ver", "que hacer", "donde alojarse", "donde comer", "descubre pamplona", "planifica tu viaje", "moverse por pamplona"]
GENERIC = ["agenda", "programa", "experiencias", "familias", "viajar", "vista", "aqui", "ademas", "locales", "lugares", "actividad", "actividades", "preguntas frecuentes", "noticias"]
INSTANCE = ["ayuntamiento", "catedral", "iglesia", "basilica", "capilla", "monasterio", "convento", "castillo", "alcazar", "palacio", "museo", "mercado", "plaza", "parque", "jardin", "teatro", "auditorio", "puente", "festival", "feria", "congreso", "camino", "ruta", "sendero", "fronton", "baluarte", "hotel", "hostal", "albergue", "camping", "balneario", "centro de interpretacion", "centro de acogida", "ciudadela", "archivo real", "caballo blanco", "plaza del castillo", "acuario", "oficina de turismo", "estacion de tren", "estacion de autobuses", "parque natural", "espacio"]
VERBS = ["es", "son", "fue", "fueron", "ser", "hay", "combina", "combinan", "ofrece", "ofrecen", "permite", "permiten", "comenzaremos", "comenzara", "visitaremos", "llegaremos", "disfruta", "disfrutar", "tiene", "tienen", "puede", "pueden", "ocurre", "ocurren", "data", "incluye", "incluyen", "vivir", "piensa", "piensan", "transforma", "transforman"]
OPENERS = ["a quien", "aqui", "si quieres", "si estas", "cuando", "como", "por supuesto", "tambien", "ademas", "no hay", "no te", "te invitamos"]
TRAILING = ["tambien", "comenzaremos", "comenzara", "ver", "mas", "monumento", "monumentos", "espacios", "museo", "museos", "lugar", "lugares", "pago", "recomendado", "precio", "precios"]
LEADING = ["actividad", "agenda", "programa", "experiencias", "por supuesto", "por", "tambien"]
TECHNICAL = ["tecnologia", "tecnologias", "agroalimentaria", "agroalimentarias", "infraestructura", "infraestructuras", "investigacion", "innovacion", "desarrollo", "biotecnologia", "laboratorio", "industrial", "agronomica", "agronomicas"]
CATEGORY = ["visitas guiadas", "actividades", "actividad", "culturales", "rutas", "eventos", "gastronomia", "postres", "excursiones desde", "para todos", "para jovenes", "restaurantes", "hoteles", "mercados", "albergues", "campings", "pensiones y hostales", "areas de autocaravanas", "paseos y rutas", "todas las noticias", "todos los lugares", "categorias", "donde comer", "planifica tu viaje"]
THEMES = ["sostenibilidad turistica", "produccion agraria", "interes turistico internacional", "turismo responsable", "desarrollo sostenible"]
PHRASES = ["multitud de actividades", "gran variedad de", "mejor manera de", "calidad de vida", "servicio integral de", "tratamientos de", "gastronomia de alta calidad", "centros de investigacion", "envolturas de fango", "pamplona agenda", "agenda multitud", "actividad san fermin", "por supuesto san fermin", "quien fue san fermin", "san fermin es mucho mas", "catedral hotel"]
EVENT_HINTS = ["festival", "feria", "congreso", "evento", "san fermin", "punto de vista", "ecozine", "jotas", "flamenco on fire"]
ROUTE_HINTS = ["camino de santiago", "ruta", "sendero", "itinerario", "recorrido", "peregrinacion"]
STRONG = ["cathedral", "church", "chapel", "basilica", "castle", "alcazar", "palace", "museum", "townhall", "square", "park", "garden", "route", "event", "market", "stadium", "monument", "bridge", "theater", "auditorium", "trainstation", "busstation"]
LOOSE = ["agenda", "actividad", "actividades", "experiencias", "lugares", "lugar", "espacios", "ver", "mas", "programa"]
HARD = -8.0
REJECT = -4.0


def clean_edges(name: Column) -> Column:
    return X.strip_edges(name, LEADING, TRAILING)


def _folded(c: Column) -> Column:
    return X.strip_accents(X.normalised(c))


def _held(words: Column, table: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(table)))


def name_score(name: Column, context: Column, cls: Column) -> Column:
    """(score, decision, reasons) of a name: fragments of interface or prose fail at once, the rest adds up."""
    def judged(x: Column) -> Column:
        total = F.when(x["hard"] == "empty_name", -10.0).when(x["hard"].isNotNull(), HARD).otherwise(x["soft"])
        why = F.when(x["hard"].isNotNull(), F.array(x["hard"])).otherwise(x["why"])
        return F.struct(total.alias("score"), F.when(total > REJECT, "keep").otherwise("reject").alias("decision"), why.alias("reasons"))

    def rules(x: Column) -> Column:
        clean, low, words, both, instance = x["clean"], x["low"], x["words"], x["both"], x["instance"]
        n = F.size(words)
        supported = instance | any_in(both, INSTANCE)
        asks = F.arrays_overlap(words, F.array(*[F.lit(w) for w in ("quien", "como", "cuando")]))
        phrase = (n == 0) | ((n >= 9) & ~instance) | reduce(Column.__or__, [F.startswith(low, F.lit(o)) for o in OPENERS]) | ((n >= 5) & (_held(words, VERBS) > 0) & ~instance) | asks
        technical = ~instance & ((count_in(both, TECHNICAL) >= 2) | any_in(low, TECHNICAL))
        category = ~instance & (low.isin(CATEGORY + THEMES) | any_in(low, THEMES) | (any_in(low, CATEGORY) & (F.size(F.split(low, " ")) <= 4)))
        hard = first_case([("empty_name", clean == ""), ("ui_fragment", any_in(low, UI)), ("foreign_noise", any_in(low, NAVIGATION)), ("phrase_fragment", any_in(low, PHRASES) | phrase), ("technical_fragment", technical), ("category_fragment", category)])
        compound = ~instance & (((n >= 6) & (_held(words, LOOSE) >= 2)) | (n >= 9) | (_held(words, ["ver", "mas", "comenzaremos", "tambien"]) > 0))
        person = X.person_like(clean)
        soft = [
            ("generic_name", -4.0, low.isin(GENERIC + NAVIGATION + UI)), ("single_token", -2.0, n == 1), ("multiword_name", 1.0, n >= 2), ("instance_indicator", 3.0, instance),
            ("supportive_context", 2.0, supported), ("event_lexical_hint", 2.0, any_in(both, EVENT_HINTS)), ("route_lexical_hint", 2.0, any_in(both, ROUTE_HINTS)),
            ("person_name_weak_signal", 1.0, person), ("strong_type", 2.0, x["cls"].isin(STRONG)), ("bad_compound_name", -5.0, compound), ("unsupported_person", -1.0, person & ~supported),
        ]
        return let(judged, hard=hard, soft=weighted([(w, c) for _, w, c in soft]), why=reasons([(r, c) for r, _, c in soft]))

    def folded(x: Column) -> Column:
        low = _folded(x["clean"])
        return let(rules, clean=x["clean"], low=low, words=X.tokens(X.strip_accents(x["clean"])), both=F.concat_ws(" || ", low, _folded(x["context"])), instance=any_in(low, INSTANCE), cls=x["cls"])

    return let(folded, clean=clean_edges(F.coalesce(name, F.lit(""))), context=F.coalesce(context, F.lit("")), cls=F.lower(F.coalesce(cls, F.lit(""))))


# Classes of the quality score.
STRONG_TYPES = ["Event", "TouristAttraction", "Museum", "Monument", "Castle", "Alcazar", "Church", "Cathedral", "Basilica", "Chapel", "Monastery", "Abbey", "Convent", "Square", "Route", "AccommodationEstablishment", "FoodEstablishment", "TransportInfrastructure", "CultureCenter", "ExhibitionHall", "TownHall", "BullRing", "SportsCenter", "Stadium"]
MIDDLE_TYPES = ["Place", "Organization", "LocalBusiness", "Service", "TourismService", "PublicService", "PublicSpace", "ReligiousSite", "NaturalResource", "TourismDestination", "Accommodation", "RetailAndFashion", "SportFacility", "DestinationExperience"]
STOP_WORDS = ["de", "la", "el", "los", "las", "en", "y", "a", "del"]
EDITORIAL = ["descubre", "sumérgete", "sumergite", "vive", "experiencia única", "no te pierdas", "te sorprenderá", "te sorprendera"]
QUALITY_UI = ["todos los derechos reservados", "ir al contenido", "reserva tu", "convention bureau", "área profesional", "area profesional", "ver todas las noticias", "newsletter", "suscríbete", "apúntate"]


def entity_quality(name: Column, short: Column, long: Column, urls: Column, types: Column, cls: Column, held: list[tuple[float, Column]], h1: Column, title: Column, slug: Column) -> Column:
    """(score within 0 and 10, decision): name, descriptions, addresses, properties, types and place on the page.

    ``held`` are (weight, condition) of properties that are there, such as 1.0 for coordinates.
    """
    def judged(x: Column) -> Column:
        return F.struct(x["score"].alias("score"), first_case([("promote", x["score"] >= 5.0), ("review", x["score"] >= 2.0)], "discard").alias("decision"))

    def rules(x: Column) -> Column:
        low, words, s, d, urls, types, met = x["low"], x["words"], x["s"], x["d"], x["urls"], x["types"], x["met"]
        n = F.size(words)
        meaningful = F.size(F.filter(words, lambda w: ~w.isin(STOP_WORDS)))
        strong, middle = F.exists(types, lambda t: t.isin(STRONG_TYPES)), F.exists(types, lambda t: t.isin(MIDDLE_TYPES))
        within = lambda c: (low != "") & (c != "") & (F.contains(c, low) | F.contains(low, c))
        table = [
            (2.0, n.between(2, 8)), (-1.0, n == 1), (-1.0, n > 12), (1.0, meaningful >= 2), (-0.5, (n > 0) & (meaningful < 2)), (-3.0, any_in(low, QUALITY_UI)), (-3.0, n == 0),
            (0.75, s != ""), (1.5, F.length(d) > 80), (0.75, (d != "") & (F.length(d) <= 80)), (-1.0, (s == "") & (d == "")), (-0.5, any_in(F.lower(d), EDITORIAL)),
            (-0.5, (F.size(urls) > 0) & (met == 0)), (-0.5, (F.size(urls) > 5) & (met <= 1)),
            (2.0, strong), (1.0, ~strong & middle), (-0.5, F.size(types) == 0), (0.5, F.size(types) >= 2), (1.0, F.array_contains(types, x["cls"])), (-0.5, (F.size(types) == 0) & (F.coalesce(x["cls"], F.lit("")) == "")),
            (2.0, within(x["h1"])), (1.0, within(x["title"])), (1.0, F.exists(x["long"], lambda w: F.contains(x["slug"], w))),
        ]
        affinity = F.when(met > 0, F.least(F.lit(2.5), 1.0 + met * 0.5)).otherwise(0.0)
        return let(judged, score=clamped(F.round(weighted(table) + x["held"] + affinity, 2), 0.0, 10.0))

    def measured(x: Column) -> Column:
        held_by = lambda u: F.exists(x["long"], lambda w: F.array_contains(F.split(F.lower(u), r"[^\p{L}\p{N}_]+"), w))
        met = F.size(F.filter(x["urls"], held_by))
        return let(rules, met=met, **{k: x[k] for k in ("low", "words", "long", "s", "d", "urls", "types", "cls", "h1", "title", "slug", "held")})

    words = X.tokens(name)
    blank = lambda c: X.squeeze(F.coalesce(c, F.lit("")))
    return let(
        measured, low=X.normalised(name), words=words, long=F.filter(words, lambda w: F.length(w) > 3), s=blank(short), d=blank(long), urls=urls, types=types, cls=cls,
        h1=X.normalised(h1), title=X.normalised(title), slug=X.normalised(slug), held=weighted(held),
    )
