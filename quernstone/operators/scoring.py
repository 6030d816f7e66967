"""Scores and classifications of entities as expressions over rule tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions import text as X
from quernstone.functions import vocabulary as V
from quernstone.functions.rules import any_in, clamped, count_in, first_case, let, looked_up, reasons, weighted, word_in


def filled(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def n_words(c: Column) -> Column:
    return F.size(F.filter(F.split(F.trim(F.coalesce(c, F.lit(""))), r"\s+"), lambda x: x != ""))


def evidence(name: Column, context: Column, linked: Column, located: Column, pictured: Column) -> Column:
    """(score, decision): signs that a name means a place to visit."""
    def judged(x: Column) -> Column:
        return F.struct(x["score"].alias("score"), first_case([("strong", x["score"] >= 4.0), ("medium", x["score"] >= 1.5)], "weak").alias("decision"))

    def rules(x: Column) -> Column:
        both = F.concat_ws(" ", x["name"], x["context"])
        table = [(w, F.contains(x["name"], F.lit(t))) for t, w in V.EVIDENCE_NAME.items()]
        table += [(w, F.contains(x["context"], F.lit(t))) for t, w in V.EVIDENCE_CONTEXT.items()]
        table += [(0.7, n_words(x["name"]) >= 2), (1.5, x["linked"]), (1.2, x["located"]), (0.8, x["pictured"]), (-2.0, n_words(x["name"]) >= 6)]
        table += [(-2.5, F.contains(both, F.lit(t))) for t in V.EVIDENCE_AGAINST]
        return let(judged, score=F.when(x["name"] == "", F.lit(-5.0)).otherwise(F.round(weighted(table), 3)))

    return let(rules, name=X.normalised(name), context=X.normalised(context), linked=linked, located=located, pictured=pictured)


def quality_rules(name: Column, cls: Column, matched: Column, description: Column, page_type: Column, role: Column, located: Column, image: Column, merged: Column) -> list[tuple[str, float, Column]]:
    """(reason, weight, condition) of the export quality; conditions of one concern exclude each other."""
    words = n_words(name)
    noisy = description.rlike(r"(?i)ES\s+EN\s+FR\s+IT\s+PT\s+DE|(?<![\p{L}])(?:Saber|Leer|Mostrar)\s+m[aá]s(?![\p{L}])|(?<![\p{L}])Ir a(?![\p{L}])")
    weak = page_type.isin(V.STRICT_PAGE_TYPES)
    return [
        ("has_name", 1.0, filled(name)),
        ("good_name_length", 1.0, words.between(2, 8)),
        ("long_name", -1.0, words > 10),
        ("has_class", 1.5, filled(cls)),
        ("ontology_match", 1.5, filled(cls) & matched),
        ("has_description", 1.0, filled(description)),
        ("rich_description", 0.75, F.length(F.trim(description)) >= 80),
        ("navigation_noise", -2.0, filled(description) & noisy),
        ("missing_description", -1.0, ~filled(description)),
        ("place_detail_page", 1.0, page_type == "place_detail"),
        ("weak_page_type", -0.75, weak),
        ("primary_resource", 1.0, role == "primary_resource"),
        ("related_entity", -0.75, role == "related_entity"),
        ("has_coordinates", 1.25, located),
        ("missing_physical_coordinates", -0.75, ~located & cls.isin(V.PHYSICAL_CLASSES)),
        ("specific_image", 0.75, image == "specific"),
        ("only_weak_image_candidates", -0.25, image == "candidates"),
        ("weak_image", -0.5, image.isin("missing", "generic", "rejected")),
        ("merged_evidence", 0.5, merged > 1),
    ]


def export_quality(rules: list[tuple[str, float, Column]]) -> tuple[Column, Column]:
    """(score within 0 and 10, sorted reasons)."""
    return clamped(F.round(weighted([(w, c) for _, w, c in rules]), 2), 0.0, 10.0), reasons([(n, c) for n, _, c in rules])


def final_score(extraction: Column, ontology: Column, quality: Column) -> Column:
    """(score, decision) of an exported entity: a fifth extraction, three tenths ontology, a half quality."""
    blend = clamped(extraction * 2.0, 0.0, 10.0) * 0.2 + ontology * 10.0 * 0.3 + quality * 0.5
    score = F.floor(blend * 100 + 0.5) / 100  # rounds the binary value, where F.round rounds its decimal spelling
    return F.struct(score.alias("score"), first_case([("promote", score >= 7.0), ("review", score >= 4.5)], "weak").alias("decision"))


def ontology_score(cls: Column, matched: Column) -> Column:
    return F.when(filled(cls) & matched, 1.0).when(filled(cls), 0.65).otherwise(0.0)


def rescued_class(primary: Column, text: Column) -> Column:
    """The class of the first rule whose word a generic entity's text holds."""
    rescued = let(lambda x: first_case([(cls, word_in(x["text"], words)) for words, cls in V.RESCUE_RULES], x["primary"]), text=X.normalised(text), primary=primary)
    return F.when(primary.isin(V.GENERIC_TYPES), rescued).otherwise(primary)


def family(text: Column) -> Column:
    return let(lambda x: first_case([(name, any_in(x["text"], words)) for name, words in V.FAMILY_KEYWORDS.items()], "unknown"), text=X.normalised(text))


def clean_type(c: Column) -> Column:
    raw = X.squeeze(F.coalesce(c, F.lit("")))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in V.CANONICAL_TYPES.items() for x in p]), F.lower(raw)), raw)


def sane_types(types: Column) -> Column:
    """Cleaned, allowed and distinct, in their order."""
    return F.array_distinct(F.filter(F.transform(types, clean_type), lambda t: (t != "") & ~t.isin(V.FORBIDDEN_TYPES)))


def primary_class(declared: Column, types: Column, primary: Column) -> Column:
    """The candidate of the largest priority; specific classes and trusted sources weigh more."""
    def candidates(source: Column, bonus: int) -> Column:
        return F.transform(sane_types(source), lambda t: F.struct((-(looked_up(V.TYPE_PRIORITY, t, 50) + F.when(t.isin(V.GENERIC_TYPES), 0).otherwise(15) + bonus)).alias("a"), F.lower(t).alias("b"), t.alias("label")))

    every = F.concat(candidates(F.array(declared), 5), candidates(types, 2), candidates(F.array(primary), 7))
    return F.coalesce(F.array_min(every)["label"], F.lit("SIN_TIPO"))


def class_quality(label: Column) -> Column:
    return F.when(label == "SIN_TIPO", "missing").when(label.isin(V.GENERIC_TYPES), "generic").otherwise("specific")


def leading_class(name: Column) -> Column:
    """The class that a name's first word implies."""
    starts = lambda x, word: (x["plain"] == word) | F.startswith(x["plain"], F.lit(f"{word} "))
    return let(lambda x: first_case([(cls, starts(x, word)) for word, cls in V.LEADING_CLASSES.items()], ""), plain=X.canonical_name(name))


def candidate_reason(name: Column, primary: Column, page_type: Column, role: Column) -> Column:
    """Why a candidate goes: the first failing rule; ``keep`` if none fails."""
    def judged(x: Column) -> Column:
        plain, primary, page_type, role = x["plain"], x["primary"], x["page_type"], x["role"]
        strict = page_type.isin(V.STRICT_PAGE_TYPES)
        ends = reduce(Column.__or__, [F.endswith(plain, F.lit(t)) for t in V.TRUNCATED_TAILS])
        starts = reduce(Column.__or__, [F.startswith(plain, F.lit(t)) for t in V.TRUNCATED_HEADS])
        anchors = F.size(F.array_intersect(F.split(plain, " "), F.array(*[F.lit(w) for w in V.ANCHOR_WORDS])))
        return first_case([
            ("missing_name", plain == ""),
            ("truncated_name_tail", ends | starts),
            ("context_fragment_name", any_in(plain, V.CONTEXT_FRAGMENTS)),
            ("out_of_scope_name", any_in(plain, V.OUT_OF_SCOPE)),
            ("utility_or_navigation_page", plain.isin(V.UTILITY_NAMES)),
            ("missing_primary_class", ~filled(primary)),
            ("non_final_generic_class", primary.isin(V.NON_FINAL_CLASSES)),
            ("related_entity_on_strict_page", (role == "related_entity") & strict),
            ("implausible_cathedral_structure", (primary == "Cathedral") & ~plain.rlike("^(?:catedral |conjunto catedralicio)")),
            ("implausible_castle_structure", (primary == "Castle") & ~plain.rlike("^castillo (?:de|del|de la|de los|de las) ")),
            ("composite_navigation_name_on_strict_page", strict & (anchors >= 2) & ~plain.rlike("^rutas? ")),
            ("generic_on_strict_page", strict & primary.isin("Place", "Service", "Organization") & (n_words(plain) > 6)),
            ("name_too_long_on_strict_page", strict & (n_words(plain) > 10)),
        ], "keep")

    return let(judged, plain=X.normalised(name), primary=primary, page_type=page_type, role=role)


# Words and address parts that tell a page's intent.
LEGAL = ["aviso legal", "politica de privacidad", "politica de cookies", "declaracion de accesibilidad", "declaracion accesibilidad", "privacy policy", "cookie policy", "legal notice"]
LEGAL_URL = ["/aviso-legal", "privacidad", "cookies", "accesibilidad"]
TECHNICAL = ["elementor_library", "wp-json", "feed", "preview=true", "replytocom"]
INSTITUTIONAL = ["area profesional", "estrategias y planes", "estudios e informes", "licitaciones", "plan de sostenibilidad", "pstd", "sf365"]
PROGRAMMATIC = ["plan", "estrategia", "estrategias", "informe", "informes", "licitacion", "licitaciones", "sostenibilidad", "promocion", "promociones", "marketing"]
LISTING_URL = ["/tipo-lugar/", "/lugares", "/category/", "/page/", "/blog"]


def page_intent(title: Column, h1: Column, url: Column) -> Column:
    """legal, technical, programmatic, institutional, detail or listing, whichever is told first."""
    low = F.lower(F.coalesce(url, F.lit("")))
    said = F.concat_ws(" | ", X.strip_accents(X.normalised(title)), X.strip_accents(X.normalised(h1)), low)
    institutional = any_in(said, INSTITUTIONAL)
    return first_case([
        ("legal", any_in(said, LEGAL) | any_in(low, LEGAL_URL)),
        ("technical", any_in(said, TECHNICAL)),
        ("programmatic", institutional & any_in(said, PROGRAMMATIC)),
        ("institutional", institutional),
        ("detail", F.contains(low, F.lit("/lugar/"))),
        ("listing", any_in(low, LISTING_URL)),
    ], "detail")


# Words that relate a mention to a page's subject.
RELATIONS = [
    ("nearby", ["junto a ", "junto al ", "cerca de ", "a pocos kilometros de "]),
    ("located_in", ["en la comarca de ", "en la provincia de ", "en el entorno de "]),
    ("includes", ["incluye ", "incluyen ", "forma parte de ", "pertenece a "]),
    ("editorial_reference", ["que hacer", "planes para inspirarte", "la historia de", "ruta del", "camino del"]),
]


def relation_hint(context: Column) -> Column:
    return let(lambda x: first_case([(name, any_in(x["plain"], words)) for name, words in RELATIONS], ""), plain=X.strip_accents(X.normalised(context)))


def mention_role(name: Column, subject: Column, context: Column) -> Column:
    """What a mention is to its page."""
    def judged(x: Column) -> Column:
        own, main = x["own"], x["main"]
        related = x["hint"].isin("nearby", "located_in", "editorial_reference")
        contact = X.strip_accents(x["low"]).rlike(r"^(?:calle|plaza|avenida|avda|paseo|camino) |(?:^|\s)(?:s/?n|cp\s+\d{3,5}|\d{5})(?:\s|$)")
        return first_case([
            ("ui_noise", (own == "") | x["low"].isin(V.BLOCK_SHORT_UI)),
            ("primary_resource", (main != "") & ((own == main) | F.contains(main, own) | F.contains(own, main))),
            ("related_entity", related),
            ("location_context", contact),
        ], "standalone_candidate")

    return let(judged, own=X.canonical_name(name), main=X.canonical_name(subject), low=X.normalised(name), hint=relation_hint(context))


def block_noise(text: Column, attributes: Column) -> Column:
    """Whether a block is menu, contact or interface rather than content."""
    from quernstone.functions.properties import has_email, has_phone

    low = F.lower(text)
    hits = count_in(low, V.BLOCK_CONTACT)
    contact = (hits >= 2) | (has_phone(text) & has_email(text)) | (has_phone(text) & (hits >= 1))
    return any_in(F.lower(attributes), V.BLOCK_NOISE) | contact | any_in(low, V.BLOCK_UI) | low.isin(V.BLOCK_SHORT_UI)


def image_score(tokens: Column, src: Column, alt: Column, title: Column) -> Column:
    """How well an image fits an entity, by its address and captions."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    held = lambda c: F.exists(tokens, lambda t: F.contains(low(c), t))
    s = low(src)
    return weighted([
        (-5, any_in(s, ["logo", "icon", "iconos", "sprite", "banner", "placeholder"])),
        (-6, any_in(s, ["_next/static/", "_next/image?", "/static/media/", "financion"])),
        (6, held(alt)), (5, held(title)), (3, held(src)), (1, low(alt) != ""), (1, low(title) != ""),
        (2, s.rlike(r"\.(?:jpg|jpeg|webp|png|avif)$")),
        (2, any_in(s, ["/sites/default/files/", "/migration/", "/images/"])),
        (-3, any_in(s, ["home", "portada", "hero", "cabecera", "header", "cover"])),
        (-3, any_in(s, ["thumbnail", "thumb", "menu", "nav", "mapa"])),
        (-2, F.length(s) < 15),
    ])
