"""The weighted vote on an entity's class: the mention first, then properties, page, ontology and context.

Votes are arrays inside a row, summed by label there, so a table of any size is typed in one pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions import text as X
from quernstone.functions.rules import any_in, first_case, let, looked_up

# Classes that are never final, and spellings of classes.
WEAK = ["", "thing", "unknown", "entity", "item", "location", "person"]
GENERIC = ["Thing", "Entity", "Item", "Location", "Place", "TourismEntity", "TourismResource", "TourismService", "TourismOrRelatedFacility", "TourismOrganisation", "Organization", "Service", "Concept", "ConceptScheme", "Accommodation"]
FORBIDDEN = ["Thing", "Entity", "Item", "Location"]
ALIASES = {
    "activity": "DestinationExperience", "airport": "Airport", "bar": "Bar", "basilica": "Basilica", "bus station": "BusStation", "busstation": "BusStation", "cafe": "FoodEstablishment",
    "cathedral": "Cathedral", "chapel": "Chapel", "church": "Church", "concept": "ConceptScheme", "event": "Event", "excursion": "DestinationExperience", "festival": "Event", "guided tour": "Tour",
    "guidedtour": "Tour", "healthcarefacility": "PublicService", "healthcareorganization": "PublicService", "hotel": "Hotel", "museum": "Museum", "organisation": "TourismOrganisation",
    "organization": "TourismOrganisation", "park": "NaturalPark", "restaurant": "Restaurant", "route": "Route", "ruta": "Route", "stadium": "Stadium", "theatre": "Theater",
    "tourist attraction": "TouristAttractionSite", "touristattraction": "TouristAttractionSite", "touristattractionsite": "TouristAttractionSite", "train station": "TrainStation", "trainstation": "TrainStation",
}

# Fixed values: (words, class, weight) by which a text votes, in order.
LEXICAL = [
    ("oficina de turismo|punto de informacion turistica", "TouristInformationOffice", 6.0), ("estacion de tren|estacion ferroviaria|apeadero", "TrainStation", 6.0),
    ("estacion de autobuses|terminal de autobuses", "BusStation", 6.0), ("aeropuerto", "Airport", 6.0), ("ayuntamiento|casa consistorial", "TownHall", 6.0), ("catedral", "Cathedral", 6.0),
    ("basilica", "Basilica", 6.0), ("iglesia|parroquia", "Church", 5.8), ("capilla|ermita", "Chapel", 5.8), ("monasterio", "Monastery", 5.8), ("convento", "Convent", 5.8), ("museo|pinacoteca", "Museum", 5.8),
    ("alcazar", "Alcazar", 5.8), ("castillo|fortaleza", "Castle", 5.8), ("palacio", "Palace", 5.7), ("torre|campanario|mirador torre", "Tower", 5.4), ("muralla|murallas", "Wall", 5.4), ("puente", "Bridge", 5.4),
    ("plaza", "Square", 5.2), ("jardin|jardines", "Garden", 5.0), ("parque natural", "NaturalPark", 5.4), ("parque de atracciones|parque tematico|isla magica", "AmusementPark", 5.4), ("parque", "Garden", 4.2),
    ("monumento|estatua|escultura|busto|conjunto escultorico", "Monument", 5.1), ("yacimiento|sitio arqueologico|restos arqueologicos|antiquarium", "ArcheologicalSite", 5.2),
    ("archivo de indias|archivo historico", "HistoricalOrCulturalResource", 5.0), ("teatro", "Theater", 5.1), ("auditorio|auditorium", "Auditorium", 5.1), ("plaza de toros|real maestranza", "BullRing", 5.2),
    ("estadio|campo de futbol", "Stadium", 5.2), ("acuario", "Aquarium", 5.2), ("biblioteca", "Library", 5.0), ("mercado de abastos|mercado tradicional", "TraditionalMarket", 5.2),
    ("mercado|mercadillo|zoco", "TraditionalMarket", 4.6), ("hotel|hostal|parador|albergue", "Hotel", 5.0), ("restaurante", "Restaurant", 5.0), ("bar|taberna|cerveceria|bodega", "Bar", 4.8),
    ("cafeteria|cafe", "FoodEstablishment", 4.8), ("pump track|skatepark|skate", "SportsCenter", 4.8), ("casco antiguo|barrio|casco historico", "Neighborhood", 4.6),
    ("festival|bienal|concierto|exposicion|evento|feria|semana santa|procesion|via crucis|ciclo", "Event", 5.2), ("ruta|camino|sendero|itinerario|recorrido|via verde", "Route", 5.0),
    ("visita guiada|tour guiado|excursion", "Tour", 4.8),
]

# The classes that go with a family of names, and the words that tell the family.
FAMILY_CLASSES = {
    "accommodation": ["Hotel", "AccommodationEstablishment"],
    "event": ["Event"],
    "experience": ["DestinationExperience", "Tour"],
    "food": ["Bar", "FoodEstablishment", "Restaurant", "TraditionalMarket", "WineBar"],
    "place": [
        "Airport", "Alcazar", "AmusementPark", "Aquarium", "ArcheologicalSite", "Auditorium", "Basilica", "Bridge", "BullRing", "BusStation", "Castle", "Cathedral", "Chapel", "Church", "Convent",
        "EventAttendanceFacility", "Garden", "HistoricalOrCulturalResource", "Library", "Monastery", "Monument", "Museum", "NaturalPark", "Palace", "Square", "Stadium", "Theater", "TouristAttractionSite",
        "TouristInformationOffice", "Tower", "TownHall", "TraditionalMarket", "TrainStation", "Wall",
    ],
    "route": ["Itinerary", "Route", "Trail", "Tour"],
    "service": ["PublicService", "TourGuide", "TourismIntermediary"],
}
FAMILY_WORDS = [
    ("event", "festival|evento|concierto|bienal|feria|semana santa|procesion|via crucis|exposicion"), ("route", "camino|ruta|sendero|itinerario|recorrido|via verde"),
    ("experience", "visita guiada|tour guiado|excursion"), ("food", "restaurante|bar|cafeteria|cafe|taberna|bodega|cerveceria"), ("accommodation", "hotel|hostal|parador|albergue"),
    ("place", "ayuntamiento|catedral|museo|castillo|plaza|parque|jardin|iglesia|capilla|basilica|palacio|alcazar|torre|puente|monasterio|convento|mercado|estadio|teatro"),
]
EVENT_CONTEXT = "fecha|horario|entradas|programacion|concierto|festival"

# Mentions that are no entity, and mentions that decide at once.
NO_ENTITY = [
    "visitas guiadas", "actividades", "culturales visitas", "produccion agraria ecologica", "sostenibilidad turistica", "interes turistico internacional", "postres queso roncal", "actividades .* skate",
    "actividades .* pump track", "informacion general", "reserva", "preguntas", "planes", "cultura", "verde", "mercados", "actas", "queso roncal", "queso idiazabal", "patxaran", "ajoarriero",
    "trucha( a la navarra)?", "pochas", "esparragos", "cuajada", "chistorra", "goxua", "pantxineta", "fritos", "hoteles", "restaurantes", "albergues", "campings", "pensiones", "pensiones y hostales",
    "paseos y rutas", "excursiones", "todos los lugares", "todas las noticias", "categorias",
]
DECISIVE = [
    (r"\bplaza de toros\b", "BullRing", "place"), (r"\b(estacion de autobuses|estacion de bus|terminal de autobuses)\b", "BusStation", "place"), (r"\b(plaza de armas|prado de san sebastian)\b", "BusStation", "place"),
    (r"\b(estacion de santa justa|estacion de tren|estacion ferroviaria)\b", "TrainStation", "place"), (r"^(ayuntamiento|casa consistorial)\b", "TownHall", "place"), (r"\bcamino de santiago\b", "Route", "route"),
    (r"\bsan fermin(es)?\b", "Event", "event"), (r"\bsemana santa\b", "Event", "event"), (r"^plaza\b", "Square", "place"), (r"^museo\b", "Museum", "place"), (r"^castillo\b", "Castle", "place"),
    (r"^palacio\b", "Palace", "place"), (r"^parque\b", "Garden", "place"),
]

# Page words, heads and words of the mention, and the votes for a head and for a word.
PAGE_VOTES = [
    (["hotel", "hoteles", "hostal", "hostales", "alojamiento", "alojarse"], ["hotel ", "hostal ", "albergue ", "parador "], ["hotel", "hostal", "albergue", "parador"], "Hotel", 3.4, 2.4),
    (["restaurante", "restaurantes", "gastronomia", "donde comer"], ["restaurante "], ["restaurante"], "Restaurant", 3.1, 2.2),
    (["bar", "bares", "taberna", "cafeteria", "cafeterias"], ["bar ", "taberna ", "cafeteria ", "cafe "], ["bar", "taberna", "cafeteria", "cafe"], "Bar", 3.0, 2.0),
    (["visitas guiadas", "tour", "tours", "guias turistico culturales"], [], ["tour", "visita", "guiada"], "Tour", 0.0, 2.0),
    (["museo", "museos"], [], ["museo"], "Museum", 0.0, 2.0),
    (["mercado", "mercados"], [], ["mercado"], "TraditionalMarket", 0.0, 2.0),
]
DESCRIPTION_VOTES = [
    ("hotel|hostal|alojamiento|habitaciones|estrellas|recepcion", "Hotel", 2.8), ("restaurante|cocina|gastronomia|gastronomica|menu degustacion", "Restaurant", 2.4), ("bar|pintxos|pinchos|taberna|cerveceria", "Bar", 2.2),
    ("museo|coleccion|exposicion", "Museum", 2.4), ("muralla|baluarte|fortificacion|sistema defensivo", "Wall", 2.3), ("festival|programacion cultural|conciertos|actuaciones|teatro|circo", "Event", 2.3),
    ("mercado|producto local|puestos|artesano", "TraditionalMarket", 2.1), ("queso|postre|licor|embutido|plato|gastronomico", "FoodEstablishment", 1.6),
    ("hostal|hostelet|pamplona beds|room pamplona|apartamento|apartamentos", "Hotel", 2.4), ("hostel|albergue|albergues|pensiones y hostales", "Hostel", 2.7), ("teatro|coliseo|escenario|espectaculos", "Theater", 2.4),
    ("pump track|skate park|skatepark|skateboarding|rocodromo|rocopolis|deporte sobre ruedas", "SportsCenter", 2.5), ("casco antiguo|barrio historico|centro historico", "Neighborhood", 2.4),
    ("ruta cicloturista|cicloturismo|senderismo|peregrinos|via verde", "Route", 2.4),
]
IMAGE_VOTES = [
    (["hotel", "hostal", "hostelet", "alojamiento"], "Hotel", 1.6), (["skate", "rocopolis"], "SportsCenter", 1.5),
    (["queso", "patxaran", "piquillo", "cuajada", "goxua", "pantxineta", "chistorra", "fritos"], "FoodEstablishment", 1.2),
]
MENTION_HEADS = [(["hotel ", "gran hotel ", "hostal ", "alojamientos ", "apartamentos "], "Hotel", 3.2), (["restaurante ", "asador "], "Restaurant", 3.0)]
STRONG_SOURCES = ["class", "type", "primaryClass"]


def plain(c: Column) -> Column:
    """Lower case without accents; anything but a-z and 0-9 is one space."""
    return F.trim(F.regexp_replace(X.strip_accents(F.lower(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", " "))


def resolved_label(c: Column) -> Column:
    """A class's local name, by its alias where it has one."""
    def named(x: Column) -> Column:
        key = plain(x["raw"])
        return F.coalesce(looked_up(ALIASES, key), looked_up(ALIASES, F.replace(key, F.lit(" "), F.lit(""))), x["raw"])

    return let(named, raw=F.trim(X.local_name(F.trim(F.coalesce(c, F.lit(""))))))


def _word(text: Column, words: str) -> Column:
    return text.rlike(rf"\b(?:{words})\b")


def name_family(mention: Column, context: Column) -> Column:
    """The family that a mention's words tell, or its context's where they tell none."""
    cases = [(name, _word(mention, words)) for name, words in FAMILY_WORDS]
    return first_case([*cases, ("event", _word(context, EVENT_CONTEXT))], "unknown")


def _weight(label: str, weight: float, family: Column) -> Column:
    """A vote's weight: generic classes count little, and classes that don't go with the family less."""
    weight = weight * 0.35 if label in GENERIC else weight
    against = [name for name, classes in FAMILY_CLASSES.items() if label not in classes]
    return F.when(family.isin(against), F.lit(weight * 0.45)).otherwise(F.lit(weight))


def _vote(condition: Column, label: str, weight: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.struct(F.lit(label).alias("label"), weight.alias("weight")))


def _free_votes(labels: Column, family: Column) -> Column:
    """Votes (label, weight) for labels that only the data know."""
    fair = F.filter(labels, lambda v: (v["label"] != "") & ~v["label"].isin(FORBIDDEN) & ~F.lower(v["label"]).isin(WEAK))
    goes = lambda label: F.coalesce(F.array_contains(family_classes(family), label), F.lit(True))
    generic = lambda v: F.when(v["label"].isin(GENERIC), v["weight"] * 0.35).otherwise(v["weight"])
    return F.transform(fair, lambda v: F.struct(v["label"].alias("label"), F.when(goes(v["label"]), generic(v)).otherwise(generic(v) * 0.45).alias("weight")))


def family_classes(family: Column) -> Column:
    """The classes of a family; null for the unknown one."""
    table = F.create_map(*[x for k, v in FAMILY_CLASSES.items() for x in (F.lit(k), F.array(*[F.lit(c) for c in v]))])
    return F.try_element_at(table, family)


def _totals(votes: Column) -> Column:
    """(label, score) with the votes of each label added up in their order."""
    labels = F.array_distinct(F.transform(votes, lambda v: v["label"]))
    total = lambda label: F.aggregate(F.filter(votes, lambda v: v["label"] == label), F.lit(0.0), lambda s, v: s + v["weight"])
    return F.transform(labels, lambda label: F.struct(label.alias("label"), total(label).alias("score")))


def elected(totals: Column) -> Column:
    """(label, score, margin): the best label, Unknown where its score or its lead is too small or it is generic."""
    def judged(x: Column) -> Column:
        best = F.get(x["ranked"], F.lit(0))
        score = F.coalesce(-best["a"], F.lit(0.0))
        margin = score - F.coalesce(-F.get(x["ranked"], F.lit(1))["a"], F.lit(0.0))
        fails = best.isNull() | best["b"] | (score < 3.2) | (margin < F.when(score >= 5.0, 0.65).otherwise(1.0))
        return F.struct(F.when(fails, "Unknown").otherwise(best["label"]).alias("label"), F.round(score, 4).alias("score"), F.round(margin, 4).alias("margin"))

    ranked = F.array_sort(F.transform(totals, lambda t: F.struct((-t["score"]).alias("a"), t["label"].isin(GENERIC).alias("b"), t["label"].alias("label"))))
    return let(judged, ranked=ranked)


def entity_type(mention: Column, context: Column, block: Column, page: Column, html: Column, description: Column, image: Column, declared: Column, expected: Column, page_expected: Column, ontology: Column) -> Column:
    """(label, family, score, margin) of a mention.

    ``page`` is the page's title, heading, breadcrumb, slug and address in one text, ``html`` the attributes around the
    mention, ``description`` the entity's descriptions with title and heading; ``declared`` an array of (source, label),
    ``ontology`` an array of (label, score), the likeliest first. All may be null.
    """
    def result(label, family, score, margin) -> Column:
        return F.struct(label.alias("label"), family.alias("family"), score.alias("score"), margin.alias("margin"))

    def decided(x: Column) -> Column:
        name = x["name"]
        none = name.rlike("^(?:" + "|".join(NO_ENTITY) + ")$")
        label = first_case([(c, name.rlike(p)) for p, c, _ in DECISIVE], None)
        kin = first_case([(k, name.rlike(p)) for p, _, k in DECISIVE], None)
        best = x["best"]
        return (
            F.when(none, result(F.lit("Unknown"), F.lit("unknown"), F.lit(0.0), F.lit(0.0)))
            .when(label.isNotNull(), result(label, kin, F.lit(10.0), F.lit(10.0)))
            .otherwise(result(best["label"], x["family"], best["score"], best["margin"]))
        )

    def closed(x: Column) -> Column:
        most = F.coalesce(F.array_max(F.transform(_totals(x["votes"]), lambda t: t["score"])), F.lit(0.0))
        said = F.slice(F.array_compact(F.array(*[_vote(_word(x["around"], w), c, _context_weight(c, s, x["family"])) for w, c, s in LEXICAL])), 1, 4)
        votes = F.concat(x["votes"], F.when(most < 5.0, said).otherwise(F.slice(said, 1, 0)), x["last"])
        return let(decided, name=x["name"], family=x["family"], best=elected(_totals(votes)))

    def voted(x: Column) -> Column:
        name, family, both = x["name"], x["family"], x["page"]
        fixed = [_vote(_word(name, w), c, _weight(c, s, family)) for w, c, s in LEXICAL]
        starts = lambda heads: any_in(F.concat(F.lit("^"), name), [f"^{h}" for h in heads])
        fixed += [_vote(starts(heads), c, _weight(c, s, family)) for heads, c, s in MENTION_HEADS]
        lead = _free_votes(F.array(F.struct(x["expected"].alias("label"), F.lit(1.1).alias("weight"))), family)
        later = []
        for on_page, heads, words, c, strong, weak in PAGE_VOTES:
            head = starts(heads) if heads else F.lit(False)
            later.append(F.coalesce(_vote(any_in(both, on_page) & head, c, _weight(c, strong, family)), _vote(any_in(both, on_page) & any_in(name, words), c, _weight(c, weak, family))))
        later += [_vote(_word(x["description"], w), c, _weight(c, s, family)) for w, c, s in DESCRIPTION_VOTES]
        later += [_vote(any_in(x["image"], words), c, _weight(c, s, family)) for words, c, s in IMAGE_VOTES]
        own = _free_votes(F.transform(x["declared"], lambda d: F.struct(resolved_label(d["label"]).alias("label"), F.when(d["source"].isin(STRONG_SOURCES), 2.0).otherwise(1.2).alias("weight"))), family)
        known = F.filter(F.slice(x["ontology"], 1, 5), lambda o: o["score"] >= 0.74)
        close = _free_votes(F.transform(known, lambda o: F.struct(resolved_label(o["label"]).alias("label"), F.when(o["score"] >= 0.86, 2.4).otherwise(1.1).alias("weight"))), family)
        votes = F.concat(F.array_compact(F.array(*fixed)), lead, F.array_compact(F.array(*later)), own, close)
        last = _free_votes(F.array(F.struct(x["page_expected"].alias("label"), F.lit(0.7).alias("weight"))), family)
        return let(closed, name=name, family=family, around=x["around"], votes=votes, last=last)

    def begun(x: Column) -> Column:
        return let(voted, family=name_family(x["name"], F.concat_ws(" ", x["name"], x["near"])), **{k: x[k] for k in ("name", "around", "page", "description", "image", "declared", "expected", "page_expected", "ontology")})

    text = lambda c: F.coalesce(c, F.lit(""))
    near = F.when(text(context) != "", text(context)).otherwise(text(block))
    return let(
        begun, name=plain(mention), near=plain(F.substring(near, 1, 500)), around=plain(F.concat_ws(" ", F.substring(text(block), 1, 1200), F.substring(text(context), 1, 1800))),
        page=F.concat(plain(html), F.lit(" || "), plain(page)), description=plain(description), image=plain(image),
        declared=F.coalesce(declared, F.array().cast("array<struct<source:string,label:string>>")), expected=resolved_label(expected), page_expected=resolved_label(page_expected),
        ontology=F.coalesce(ontology, F.array().cast("array<struct<label:string,score:double>>")),
    )


def _context_weight(label: str, weight: float, family: Column) -> Column:
    return _weight(label, min(2.0, weight * 0.35), family)
