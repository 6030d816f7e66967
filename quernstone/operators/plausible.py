"""Whether a name can be what its class says: class names, monuments, and the whole candidate filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import text as X
from quernstone.functions import vocabulary as V
from quernstone.functions.rules import any_in, count_in, first_case, let
from quernstone.operators.scoring import filled, n_words

# Words that a name of the class has.
CLASS_ANCHORS = {
    "TownHall": ["ayuntamiento", "casa consistorial"],
    "Cathedral": ["catedral", "cathedral", "conjunto catedralicio"],
    "Church": ["iglesia", "church"],
    "Museum": ["museo", "museum", "museoa"],
    "Palace": ["palacio", "palace"],
    "Castle": ["castillo", "castle"],
    "Square": ["plaza", "square"],
    "Event": ["festival", "congreso", "simposio", "convencion", "convención", "jornadas", "jornada", "concierto", "feria", "evento", "exposicion", "exposición", "day", "week", "weekend"],
}
EVENT_PHRASES = ["san fermin", "san fermín", "gora san fermin", "gora san fermín", "san fermin txikito", "san fermín txikito", "semana santa"]
TOWN_HALL_WORDS = ["ayuntamiento", "pamplona", "de", "del", "plaza", "consistorial", "casa", "en", "y"]

# Words of the surroundings of a name.
CONTEXT_WORDS = [
    "historia", "paseo", "paseos", "primer", "primera", "noticias", "news", "grupo", "motor", "espazioa", "espacio", "servicio", "ruta", "tour", "visita", "guia", "blog", "post", "articulo", "article",
    "descubre", "sorpresa", "razones", "alternativas", "horario", "horarios", "localizacion", "localización", "puntos", "zona", "infantil", "exposicion", "exposición", "tarde", "cafes", "cafés", "tras",
    "dos", "tres", "con", "opcion", "opción", "origen", "preparando", "bebidas", "gastronomia", "gastronomía", "iluminacion", "iluminación", "naturaleza", "llegar", "mercados", "evolucion", "evolución",
    "cultura", "considerada", "punto", "finalizacion", "finalización", "rodeando", "durante", "mientras", "otras", "viajar", "descargar", "frecuentaba", "convocatoria", "porque", "por", "para", "desde",
    "sobre", "sf365", "pstd",
]
BAD_NAME_PARTS = [
    "categorías", "categorias", "todos los lugares", "planifica tu viaje", "qué ver", "que ver", "qué hacer", "que hacer", "dónde alojarse", "donde alojarse", "dónde comer", "donde comer",
    "qué visitar desde pamplona-iruña", "que visitar desde pamplona-iruna", "lugares", "espacios culturales", "restaurantes del reyno", "albergues", "individual", "grupos", "ver más", "ver mas", "page",
]

# Names of monuments, and what only looks like one.
MONUMENT_ANCHORS = ["monumento", "estatua", "escultura", "memorial", "busto"]
MONUMENT_NOISE = ["espazioa", "alternativas", "otras", "mientras", "viajar", "descargar", "frecuentaba", "convocatoria", "noticias", "visitar", "visita", "guia", "guía", "que", "qué"]
MONUMENT_TERMS = ["fueros", "encierro", "hemingway", "teobaldo", "gayarre", "eslava", "sarasate", "mari", "blanca"]
MONUMENT_HEADS = ["centro de", "rutas de", "prensa", "datos", "producto", "capital", "invierno en", "union", "interes", "interés", "imprescindibles", "asociacion", "asociación", "pequeña empresa", "arte municipal", "mejor actriz", "guerra civil", "edad media", "nueva york"]
MONUMENT_REJECTED = ["flamenco on fire", "the sun also rises", "casco antiguo", "capital mundial", "prensa dossier", "producto local", "iruña capital", "invierno en pamplona", "rutas de pintxos", "monumento nacional", "paseos y", "un dia", "un día", "excursiones desde pamplona"]
MONUMENT_KNOWN = ["monumento a ernest hemingway", "monumento a los fueros", "monumento al encierro", "monumento al rey teobaldo i de champaña", "estatua de la mari blanca", "monumento a san ignacio de loyola", "monumento a hilarión eslava", "monumento a julian gayarre", "monumento a pablo sarasate", "taconera esculturas"]

# What a supposed monument is in its place.
BROAD_PLACES = ["casco antiguo", "media luna", "segundo ensanche", "primer ensanche", "baja navarra", "zizur mayor", "monte ezkaba"]
BROAD_WORDS = ["valle", "foz", "selva", "pirineo", "ensanche", "ciudadela", "juderia", "judería", "fabrica", "fábrica", "claustros", "campana", "portal", "calle", "parques", "luna"]
NATURAL_PLACES = ["valle de roncal", "roncal el valle", "baztan el valle", "lumbier la foz", "orreaga roncesvalles", "pirineo navarro", "selva negra"]
SHOWS = ["festival", "concierto", "conciertos", "exposicion", "exposiciones", "evento", "eventos", "rock"]
WALKS = ["ruta", "rutas", "paseo", "paseos", "camino", "senderismo", "teatralizadas"]
CASTLE_HEADS = ["castillo de ", "castillo del ", "castillo de la ", "castillo de los ", "castillo de las "]


def token_text(c: Column) -> Column:
    """Lower case; anything but letters, digits, blanks, ``/`` and ``-`` is a space."""
    return X.squeeze(F.regexp_replace(X.normalised(X.clean_text(F.coalesce(c, F.lit("")))), r"[^\p{L}\p{N}_\s/-]", " "))


def _held(words: Column, table: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(table)))


def _starts(c: Column, heads: list[str]) -> Column:
    return reduce(Column.__or__, [F.startswith(c, F.lit(h)) for h in heads])


def plausible_monument(name: Column, words: Column) -> Column:
    """``name`` is token text, ``words`` its words."""
    first, last = F.element_at(words, 1), F.element_at(words, -1)
    rejected = name.isin(MONUMENT_REJECTED) | _starts(F.concat(name, F.lit(" ")), [f"{h} " for h in MONUMENT_HEADS])
    anchored = any_in(name, MONUMENT_ANCHORS)
    noisy = first.isin(MONUMENT_NOISE) | last.isin(MONUMENT_NOISE) | (_held(words, MONUMENT_NOISE) >= 2)
    known = name.isin(MONUMENT_KNOWN)
    return (
        F.when((F.size(words) == 0) | rejected, False).when(anchored, ~F.contains(name, F.lit("monumentos")) | known)
        .when(noisy, False).when(known, True).otherwise((_held(words, MONUMENT_TERMS) > 0) | (F.size(words) > 4))
    )


def plausible_name(name: Column, cls: Column) -> Column:
    """Whether a name can be an entity of the class."""
    def judged(x: Column) -> Column:
        text, words, cls = x["text"], x["words"], x["cls"]
        first, last = F.element_at(words, 1), F.element_at(words, -1)
        has_anchors = cls.isin(list(CLASS_ANCHORS))
        anchored = reduce(Column.__or__, [(cls == c) & any_in(text, table) for c, table in CLASS_ANCHORS.items()])
        phrase = (cls == "Event") & text.isin(EVENT_PHRASES)
        saint = (cls == "Event") & (F.contains(text, F.lit("san fermin")) | F.contains(text, F.lit("san fermín")))
        opens_event = (cls == "Event") & F.exists(F.array(*[F.lit(h) for h in CLASS_ANCHORS["Event"]]), lambda h: F.startswith(h, first))
        outside = (first.isin(CONTEXT_WORDS) & ~opens_event) | last.isin(CONTEXT_WORDS)
        extra = F.filter(words, lambda w: ~w.isin(TOWN_HALL_WORDS))
        hall = (cls == "TownHall") & ((_held(extra, CONTEXT_WORDS) > 0) | (F.size(extra) >= 2))
        crowded = has_anchors & (cls != "TownHall") & (_held(words, CONTEXT_WORDS) >= 2)
        return (
            F.when(text == "", False).when(cls == "Monument", plausible_monument(text, words)).when(has_anchors & ~anchored & ~phrase, False)
            .when(phrase, True).when(saint, False).otherwise(~(outside | hall | crowded))
        )

    def cut(x: Column) -> Column:
        return let(judged, text=x["text"], words=F.filter(F.split(x["text"], " "), lambda w: w != ""), cls=x["cls"])

    return let(cut, text=token_text(name), cls=F.trim(F.coalesce(cls, F.lit(""))))


def bad_name(text: Column) -> Column:
    """Whether a name, as token text, looks like a page's furniture."""
    return (n_words(text) == 0) | (n_words(text) > 12) | text.rlike(r"\b\d+\s*…\s*\d+\b") | (count_in(text, BAD_NAME_PARTS) >= 2) | (count_in(text, CONTEXT_WORDS) >= 2)


def monument_replacement(name: Column, url: Column) -> Column:
    """The class that fits better what was taken for a monument; empty if none does."""
    def judged(x: Column) -> Column:
        text = x["text"]
        event_url = F.contains(x["url"], F.lit("/evento/")) & any_in(text, ["miradas", "eventos", "conciertos", "festival", "rock"])
        return first_case([
            ("Event", (text != "") & (any_in(text, SHOWS) | event_url)),
            ("Route", any_in(text, WALKS)),
            ("Street", F.startswith(text, F.lit("calle "))),
            ("Stadium", any_in(text, ["fronton", "frontón"])),
            ("NaturalResource", text.isin(NATURAL_PLACES)),
            ("HistoricalOrCulturalResource", text.isin(BROAD_PLACES) | any_in(text, BROAD_WORDS)),
            ("Cathedral", any_in(text, ["catedral", "claustros", "campana"])),
            ("Gate", F.startswith(text, F.lit("portal ")) | F.endswith(text, F.lit(" el portal"))),
        ], "")

    return let(judged, text=token_text(X.entity_name(name)), url=token_text(url))


def canonical_by_class(name: Column, cls: Column) -> Column:
    """A clean name without the words of its surroundings behind it, for classes whose names have anchors."""
    def judged(x: Column) -> Column:
        clean, text, cls = x["clean"], x["text"], x["cls"]
        anchored = reduce(Column.__or__, [(cls == c) & any_in(text, table) for c, table in CLASS_ANCHORS.items()])
        has_anchors = cls.isin(list(CLASS_ANCHORS))
        named = F.contains(text, F.lit(" de ")) & reduce(Column.__or__, [(cls == c) & ((text == h) | F.startswith(text, F.lit(f"{h} ")) | F.contains(text, F.lit(f"{h} de "))) for c, table in CLASS_ANCHORS.items() for h in table])
        words = F.split(clean, " ")
        places = F.filter(F.sequence(F.lit(1), F.size(words)), lambda k: (k >= 3) & token_text(F.element_at(words, k)).isin(CONTEXT_WORDS))
        tail = F.when(F.size(places) > 0, F.btrim(F.concat_ws(" ", F.slice(words, 1, F.element_at(places, 1) - 1)), F.lit(" -|,;:")))
        stays = (cls == "Route") | named | (text == "") | (has_anchors & ~anchored)
        return F.when(stays, clean).otherwise(F.coalesce(F.when(tail != "", tail), clean))

    def cut(x: Column) -> Column:
        return let(judged, clean=x["clean"], text=token_text(x["clean"]), cls=x["cls"])

    return let(cut, clean=X.entity_name(name), cls=F.trim(F.coalesce(cls, F.lit(""))))


def candidate_verdict(name: Column, cls: Column, page_type: Column, role: Column, description: Column) -> Column:
    """Why a candidate goes: the first failing rule, with the page's type where it matters; ``keep`` if none fails."""
    def judged(x: Column) -> Column:
        text, cls, kind, role, said = x["text"], x["cls"], x["kind"], x["role"], x["said"]
        strict = kind.isin(V.STRICT_PAGE_TYPES)
        on_page = lambda reason: F.concat(F.lit(f"{reason}_on_"), kind)
        ends = reduce(Column.__or__, [F.endswith(text, F.lit(t)) for t in V.TRUNCATED_TAILS])
        anchors = F.size(F.array_intersect(F.split(text, " "), F.array(*[F.lit(w) for w in V.ANCHOR_WORDS])))
        cathedral, castle = cls == "Cathedral", cls == "Castle"
        rules: list[tuple[Column, Column | str]] = [
            (x["name"] == "", "missing_name"),
            (ends | _starts(text, V.TRUNCATED_HEADS), "truncated_name_tail"),
            (any_in(text, V.CONTEXT_FRAGMENTS), "context_fragment_name"),
            (any_in(text, V.OUT_OF_SCOPE), "out_of_scope_name"),
            (text.isin(V.UTILITY_NAMES), "utility_or_navigation_page"),
            (~filled(cls), "missing_primary_class"),
            (cls.isin(V.NON_FINAL_CLASSES), "non_final_generic_class"),
            ((role == "related_entity") & strict, on_page("related_entity")),
            (cls.isin([*CLASS_ANCHORS, "Monument"]) & ~plausible_name(x["name"], cls), F.concat(F.lit("implausible_"), F.lower(cls), F.lit("_name"))),
            (cathedral & ~(F.startswith(text, F.lit("catedral ")) | F.startswith(text, F.lit("conjunto catedralicio"))), "implausible_cathedral_structure"),
            (cathedral & (text == "catedral"), "generic_cathedral_name"),
            (castle & ~_starts(text, CASTLE_HEADS), "implausible_castle_structure"),
            ((cls == "Monument") & strict & ~any_in(text, MONUMENT_ANCHORS), on_page("generic_monument")),
            (strict & bad_name(text), "bad_name_pattern_on_strict_page"),
            (strict & (anchors >= 2) & ~_starts(text, ["ruta ", "rutas "]), "composite_navigation_name_on_strict_page"),
            (strict & cls.isin("Place", "Service", "Organization") & (n_words(x["name"]) > 6), on_page("generic")),
            (strict & (n_words(x["name"]) > 10), on_page("name_too_long")),
            (strict & (n_words(said) > 120) & F.contains(token_text(said), F.lit("categorias")), on_page("listing_description")),
        ]
        named = [F.when(F.coalesce(c, F.lit(False)), r if isinstance(r, Column) else F.lit(r)) for c, r in rules]
        return F.coalesce(*named, F.lit("keep"))

    blank = lambda c: F.trim(X.clean_text(F.coalesce(c, F.lit(""))))
    plain = lambda c: F.trim(F.coalesce(c, F.lit("")))
    return let(judged, name=blank(name), text=token_text(name), cls=plain(cls), kind=plain(page_type), role=plain(role), said=blank(description))


def keep_candidates(entities: DataFrame, key: str, reason: str = "reason") -> DataFrame:
    """The entities whose verdict is ``keep``; where a key (a page) would lose all of its entities, it keeps them."""
    kept = entities.groupBy(key).agg(F.max(F.col(reason) == "keep").alias("__any")).filter("__any").select(key)
    some = entities.filter(F.col(reason) == "keep")
    return some.unionByName(entities.join(kept, key, "left_anti").select(entities.columns))
