"""Text projections: Column to Column, all in Spark's own functions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions import vocabulary as V


def _accent_table() -> tuple[str, str]:
    """Letters of the Latin blocks that are an ASCII letter and a mark."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if a != b and b.isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _PLAIN = _accent_table()
MARKS = "[̀-ͯ]"


def nz(c: Column) -> Column:
    """Null where a string is empty or blank: the one spelling of missing."""
    return F.when(F.trim(c) != "", F.trim(c))


def first_filled(*columns: Column | str) -> Column:
    """The first of the columns that is neither null nor blank."""
    return F.coalesce(*[nz(F.col(c) if isinstance(c, str) else c) for c in columns])


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_accents(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, _ACCENTED, _PLAIN), MARKS, "")


def normalised(c: Column) -> Column:
    """Lower case, single spaces."""
    return F.lower(squeeze(F.coalesce(c, F.lit(""))))


def plain_words(c: Column) -> Column:
    """Lower case without accents; anything but a-z, 0-9 and a hyphen is a space."""
    return F.trim(F.regexp_replace(F.regexp_replace(strip_accents(F.lower(F.coalesce(c, F.lit("")))), r"[^a-z0-9\s-]", " "), r"\s+", " "))


def spanish_words(c: Column) -> Column:
    """Lower case; keeps word characters and Spanish letters."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}_\s]", " "), r"(?U)\s+", " "))


def canonical_name(c: Column) -> Column:
    """The resolver's name: no accents, quotes, articles or prepositions."""
    s = strip_accents(F.lower(F.trim(F.coalesce(c, F.lit("")))))
    s = F.regexp_replace(s, "[«»\"'`´]", " ")
    s = F.regexp_replace(s, r"\b(la|el|los|las|un|una|de|del|al)\b", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"[^a-z0-9\s]", " "), r"\s+", " "))


def eval_name(c: Column) -> Column:
    """The evaluation's name: no accents, noise words or list punctuation."""
    s = F.lower(strip_accents(F.trim(F.coalesce(c, F.lit("")))))
    s = F.regexp_replace(s, rf"\b(?:{'|'.join(V.EVAL_NOISE)})\b", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(s, "[|·•,;:()]+", " "), r"\s+", " "))


def repair_mojibake(c: Column) -> Column:
    """Literal replacements, one after the other."""
    for wrong, right in V.MOJIBAKE:
        c = F.replace(c, F.lit(wrong), F.lit(right))
    return c


LANGUAGE_BAR = r"(?i)^(?:\s*(?:(?:ES\s*[▼▾]?\s*)?ES\s+EN\s+FR\s+IT\s+PT\s+DE\s+|(?:Leer|Saber|Mostrar)\s+m[aá]s\s+))+"
INLINE_TAIL = r"(?i)\s+(?:Leer|Mostrar)\s+m[aá]s(?![\p{L}\p{N}_]).*$"
INNER_BAR = r"(?i)(?<![\p{L}\p{N}_])(?:ES\s*[▼▾]\s*)?ES\s+EN\s+FR\s+IT\s+PT\s+DE(?![\p{L}\p{N}_])"


def strip_navigation(c: Column) -> Column:
    """Language bars and calls to read on, at the start to a fixpoint and inside a text once.

    A repeated group in one pattern reaches the same fixpoint as replacing until nothing changes.
    """
    s = F.regexp_replace(squeeze(c), LANGUAGE_BAR, "")
    s = F.trim(F.regexp_replace(s, INLINE_TAIL, ""))
    s = F.regexp_replace(F.regexp_replace(s, INNER_BAR, " "), r"(?i)\s+Ir a\s+", " ")
    return F.btrim(F.regexp_replace(s, r"\s+", " "), F.lit(" -|,.;:"))


def clean_text(c: Column) -> Column:
    return strip_navigation(repair_mojibake(c))


def cut_at_first(c: Column, markers: list[str]) -> Column:
    """The text ahead of the first marker that isn't at its very start, case ignored."""
    places = [F.when(F.locate(m.lower(), F.lower(c)) > 1, F.locate(m.lower(), F.lower(c))) for m in markers]
    first = F.least(*places) if len(places) > 1 else places[0]
    return F.when(first.isNotNull(), F.trim(F.substr(c, F.lit(1), first - 1))).otherwise(c)


def heading(c: Column) -> Column:
    """A heading without the site's name behind a separator."""
    for mark in (" | ", " - ", " – ", " — ", " » "):
        c = F.substring_index(c, mark, 1)
    return squeeze(c)


def strip_edges(c: Column, leading: list[str], trailing: list[str]) -> Column:
    """Take noise words off both ends until none is left; one pattern for each end does it at once."""
    head = rf"(?i)^(?:(?:{'|'.join(leading)})\s+)+"
    tail = rf"(?i)(?:\s+(?:{'|'.join(trailing)}))+$"
    return F.btrim(F.regexp_replace(F.regexp_replace(squeeze(c), head, ""), tail, ""), F.lit(" -|,;:"))


def cut_repeated_start(c: Column) -> Column:
    """Cut a text where its first four words come again."""
    return F.regexp_replace(squeeze(c), r"(?i)^((?:\S+\s+){3}\S+)(\s.*?)?\s+\1.*$", "$1$2")


def entity_name(c: Column) -> Column:
    """A name without the sentence or site part behind it."""
    s = F.split(clean_text(c), r"[.:;]\s+").getItem(0)
    for mark in (" – ", " - ", " | "):
        s = F.substring_index(s, mark, 1)
    return squeeze(s)


def short_description(c: Column) -> Column:
    """The first sentence."""
    return F.trim(F.split(squeeze(c), r"\.").getItem(0))


def long_description(c: Column) -> Column:
    return F.substring(squeeze(c), 1, 300)


def around(text: Column, mention: Column, margin: int = 280) -> Column:
    """The text within ``margin`` characters of a mention, case ignored; null without it."""
    at = F.instr(F.lower(text), F.lower(mention))
    start = F.greatest(at - margin, F.lit(1))
    return F.when(at > 0, F.substr(text, start, at + F.length(mention) + margin - start))


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}_]+"), lambda x: x != "")


def slug(c: Column, joiner: str = "_") -> Column:
    plain = F.regexp_replace(strip_accents(F.lower(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", joiner)
    return F.btrim(plain, F.lit(joiner)) if joiner else plain


def local_name(uri: Column) -> Column:
    """What follows the last ``#`` or ``/`` of a class's address."""
    return F.regexp_extract(F.rtrim(F.coalesce(uri, F.lit("")), F.lit("/")), r"([^#/]*)$", 1)


def last_words(c: Column, n: int = 4) -> Column:
    words = F.split(squeeze(c), " ")
    return F.when(F.size(words) > n, F.concat_ws(" ", F.slice(words, -n, n))).otherwise(c)


def listed(c: Column) -> Column:
    """The items of a list that was written as ``[a, b]``, ``a|b`` or lines."""
    bare = F.regexp_replace(F.trim(c), r"^\[|\]$", "")
    parts = F.split(bare, r"\s*(?:\||\n|,)\s*")
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.btrim(x, F.lit(" '\""))), lambda x: x != ""))


def person_like(c: Column) -> Column:
    """Two to four words, at least two of them capitalised."""
    words = F.split(squeeze(c), " ")
    proper = F.filter(words, lambda w: F.btrim(w, F.lit(".,;:!?()[]{}\"'")).rlike("^[A-ZÁÉÍÓÚÑ][a-záéíóúñü-]+$"))
    return F.size(words).between(2, 4) & (F.size(proper) >= 2)


def fix_latin1(c: Column) -> Column:
    """UTF-8 that was read as Latin-1."""
    return F.decode(F.encode(c, "ISO-8859-1"), "UTF-8")


# Words that candidate, route and description cleaning take off.
CALLS = ["PAGO RECOMENDADO", "Ver", "Más", "Mas", "También", "Tambien", "Comenzaremos", "Saber", "Ir", "Qué", "Que", "Tradiciones", "Recomendaciones", "Descubrir", "Descubre"]
LISTING_HEADS = ["Todos los lugares", "Todas las noticias", "Categorias", "Categorías", "Que ver", "Qué ver", "Que hacer", "Qué hacer", "Donde comer", "Dónde comer", "Pensiones y hostales", "Albergues", "Campings", "Excursiones desde Pamplona", "Paseos y rutas", "Hoteles", "Restaurantes", "Mercados"]
SITE_HEADS = ["ir al contenido", "reserva tu actividad", "descubre pamplona", "planifica tu viaje"]
MERGE_NOISE = ["compartir", "abrir", "google maps", "copiar direccion", "direccion"]
HEADING_ANCHORS = ["Festival", "Mercado", "Feria", "Ruta", "Camino", "Museo", "Catedral", "Iglesia", "Capilla", "Castillo", "Palacio", "Plaza", "Ayuntamiento", "Parque", "Puente", "Estacion", "Oficina de Turismo"]
LOST_TAILS = ["palacio", "parque", "catedral", "iglesia", "museo"]
_EDGE = " -|,;:"


def _one_of(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def candidate_name(c: Column) -> Column:
    """A candidate without a call to act behind it, or a listing's heading or town hall ahead of it."""
    s = F.regexp_replace(squeeze(c), rf"(?i)(?<![\p{{L}}]){_one_of(CALLS)}$", "")
    s = F.regexp_replace(F.trim(s), r"(?i)^Ayuntamiento\s+de\s+Pamplona\s+", "")
    s = F.regexp_replace(s, rf"(?i)^(?:{_one_of(LISTING_HEADS)}\s+)+", "")
    return F.btrim(squeeze(s), F.lit(_EDGE))


def merge_name(c: Column) -> Column:
    """The key that merges a consolidated record with a raw one."""
    s = strip_accents(F.lower(F.trim(F.coalesce(c, F.lit("")))))
    s = F.regexp_replace(s, rf"\b{_one_of(MERGE_NOISE)}\b", " ")
    return squeeze(F.regexp_replace(s, r"[^\p{L}\p{N}_\s]", " "))


def route_name(c: Column) -> Column:
    """A route's name: no site part, site heading, distance or time."""
    s = squeeze(c)
    for mark in (" | ", " - "):
        s = F.trim(F.substring_index(s, mark, 1))
    s = F.regexp_replace(s, rf"(?i)^(?:{_one_of(SITE_HEADS)}\s+)+", "")
    s = F.regexp_replace(s, r"(?i)(?<![\p{L}])(?:Distancia|Tiempo recomendado)(?![\p{L}]).*$", "")
    return F.btrim(squeeze(s), F.lit(_EDGE))


def stop_name(c: Column) -> Column:
    """The name of a stop on a route: no day, side, distance, stray article or class word behind it."""
    s = candidate_name(c)
    s = F.regexp_replace(s, r"(?i)\s*/\s*(?:Derecha|Izquierda)(?![\p{L}]).*$", "")
    s = F.btrim(F.regexp_replace(s, r"(?i)(?<![\p{L}])Distancia(?![\p{L}]).*$", ""), F.lit(_EDGE))
    s = F.regexp_replace(s, r"(?i)^(?:D[IÍ]A\s*\d+|Mañana|Tarde)(?![\p{L}\d])[:-]?\s*", "")
    s = F.regexp_replace(s, r"(?i)^de\s+(?=\S)", "")
    s = F.regexp_replace(s, rf"(?i)^(\S+\s+.*\S)\s+{_one_of(LOST_TAILS)}$", "$1")
    return F.btrim(squeeze(s), F.lit(_EDGE))


def heading_names(c: Column, most_words: int = 18) -> Column:
    """Names in a heading: the whole of a short one, and what stands behind an anchor word."""
    clean = F.btrim(heading(c), F.lit(" ,.;:-|"))
    anchored = F.regexp_extract_all(clean, F.lit(rf"(?i)(?<![\p{{L}}])({_one_of(HEADING_ANCHORS)}(?:\s+[\p{{L}}0-9'’-]+){{0,16}})"), F.lit(1))
    whole = F.when((clean != "") & (F.size(F.split(clean, " ")) <= most_words), F.array(clean)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.concat(whole, F.transform(anchored, lambda x: candidate_name(x))), lambda x: x != ""))


def compact_description(c: Column, name: Column) -> Column:
    """A description in which its entity's name isn't repeated and no site call remains."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(F.trim(F.coalesce(name, F.lit(""))), F.lit(r"\E"), F.lit("")), F.lit(r"\E"))
    once = F.regexp_replace(squeeze(c), F.concat(F.lit(r"(?i)(?<![\p{L}\p{N}_])("), quoted, F.lit(r")(?:\s+\1)+")), F.lit("$1"))
    s = F.when(F.coalesce(F.trim(name), F.lit("")) != "", once).otherwise(squeeze(c))
    s = F.regexp_replace(s, r"(?i)(?<![\p{L}])(?:compartir|guardar favorito|eliminar favorito|ir a mis favoritos|qu[eé]\s+hacer|planes\s+para\s+inspirarte)(?![\p{L}]).*$", "")
    return F.btrim(squeeze(s), F.lit(_EDGE))
