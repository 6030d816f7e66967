"""What a page and its parts give evidence of: images, places in markup, blocks of text, and pages without entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions import properties as P
from quernstone.functions import text as X
from quernstone.functions import urls as U
from quernstone.functions import vocabulary as V
from quernstone.functions.rules import any_in, count_in, first_case, let, reasons, weighted

# Parts of an image's address, and why such an image shows no entity; the first decides.
IMAGE_REASONS = [
    (".svg", "svg_or_vector_asset"), ("logo", "logo_or_brand_asset"), ("icon", "icon_asset"), ("iconos", "icon_asset"), ("sprite", "sprite_asset"), ("banner", "layout_asset"), ("menu-navegacion", "navigation_asset"),
    ("placeholder", "placeholder_asset"), ("default", "default_asset"), ("avatar", "avatar_asset"), ("header", "layout_asset"), ("footer", "layout_asset"), ("og-image", "generic_open_graph_asset"),
    ("share", "social_or_share_asset"), ("social", "social_or_share_asset"), ("twitter", "social_or_share_asset"), ("twitter+x", "social_or_share_asset"), ("twitter%2bx", "social_or_share_asset"),
    ("/x+1.", "social_or_share_asset"), ("/x_1.", "social_or_share_asset"), ("facebook", "social_or_share_asset"), ("instagram", "social_or_share_asset"), ("youtube", "social_or_share_asset"),
    ("separador", "decorative_asset"), ("separator", "decorative_asset"), ("feeling", "decorative_asset"), ("negativo", "decorative_asset"), ("_next/static/", "static_bundle_asset"),
    ("_next/image?", "proxy_or_transformed_asset"), ("/static/media/", "static_bundle_asset"), ("financion", "sponsor_asset"), ("fav", "favicon_asset"), ("favicon", "favicon_asset"),
    ("visita_burgos_fondo", "generic_background_asset"), ("burgos_fondo", "generic_background_asset"), ("_fondo", "generic_background_asset"), ("fondo.png", "generic_background_asset"),
    ("desliza.png", "generic_slider_placeholder"),
]
IMAGE_ENDINGS = [".jpg", ".jpeg", ".png", ".webp", ".gif", ".avif"]


def image_rejection(src: Column) -> Column:
    """Why an image can't show an entity; empty if it can."""
    low = F.lower(F.coalesce(src, F.lit("")))
    return first_case([("missing_src", low == ""), *[(reason, F.contains(low, F.lit(part))) for part, reason in IMAGE_REASONS]], "")


def usable_image(src: Column) -> Column:
    return any_in(F.lower(F.coalesce(src, F.lit(""))), IMAGE_ENDINGS) & (image_rejection(src) == "")


# The box of a country's places, with a margin for its islands.
COUNTRY_BOXES = {"es": (27.0, 44.5, -18.5, 5.5)}


def plausible_for_host(lat: Column, lng: Column, url: Column) -> Column:
    """Whether a point can belong to a page of its host's country; hosts without a country's ending don't tell."""
    host = U.host(url)
    inside = [(F.endswith(F.regexp_replace(host, r":\d*$", ""), F.lit(f".{tld}")), lat.between(south, north) & lng.between(west, east)) for tld, (south, north, west, east) in COUNTRY_BOXES.items()]
    fits = reduce(lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), inside, F.lit(True))
    return F.coalesce(lat.isNotNull() & lng.isNotNull() & fits, F.lit(False))


def _point(lat: Column, lng: Column, source: str) -> Column:
    place = P.valid_point(P.number(lat), P.number(lng))
    return F.when(place.isNotNull(), F.struct(place["lat"].alias("lat"), place["lng"].alias("lng"), F.lit(source).alias("source")))


def markup_points(html: Column) -> Column:
    """(lat, lng, source) of all places in a page's markup: linked data, data attributes and map frames, best source first."""
    html = F.coalesce(html, F.lit(""))
    scripts = F.regexp_extract_all(html, F.lit(r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    geo = F.flatten(F.transform(scripts, lambda s: F.regexp_extract_all(s, F.lit(r'"geo"\s*:\s*(\{[^{}]*\})'), F.lit(1))))
    linked = F.transform(geo, lambda g: _point(F.get_json_object(g, "$.latitude"), F.get_json_object(g, "$.longitude"), "jsonld"))
    attribute = lambda tag, name: F.regexp_extract(tag, rf"""(?i)data-{name}=["']([^"']+)["']""", 1)
    tags = F.regexp_extract_all(html, F.lit(r"""(?i)(<[^>]*data-(?:lat|lng)=["'][^"']+["'][^>]*data-(?:lat|lng)=["'][^"']+["'][^>]*>)"""), F.lit(1))
    attributes = F.transform(tags, lambda t: _point(attribute(t, "lat"), attribute(t, "lng"), "data-attrs"))
    frames = F.transform(F.regexp_extract_all(html, F.lit(r"""(?i)<iframe[^>]+src=["']([^"']+)["']"""), F.lit(1)), lambda s: F.coalesce(F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B"))), s))
    number = r"(-?\d+(?:\.\d+)?)"
    patterns = [rf"@{number},{number}", rf"[?&]q={number},{number}"]
    framed = F.transform(frames, lambda s: F.coalesce(*[_point(F.regexp_extract(s, p, 1), F.regexp_extract(s, p, 2), "iframe") for p in patterns]))
    return F.array_compact(F.concat(linked, attributes, framed))


# Words of navigation, for the quality of blocks.
NAVIGATION_TERMS = [
    "inicio", "home", "menu", "menú", "contacto", "privacy", "privacidad", "cookies", "aviso legal", "legal", "mapa web", "sitemap", "facebook", "instagram", "twitter", "youtube", "linkedin", "leer más", "mostrar más",
    "ver más", "more", "read more",
]


def block_quality(text: Column) -> Column:
    """(score, decision, flags) of a block: its length, diversity, navigation words, lists, and what it tells."""
    def judged(x: Column) -> Column:
        raw, n = x["raw"], F.size(x["words"])
        unique = F.size(F.array_distinct(x["words"])) / F.greatest(n, F.lit(1))
        parts = F.filter(F.transform(F.split(raw, r"[|•·\-–—/]+"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " "))), lambda p: p != "")
        short = F.size(F.filter(parts, lambda p: F.size(F.split(p, " ")) <= 4)) / F.greatest(F.size(parts), F.lit(1))
        hits = count_in(x["norm"], NAVIGATION_TERMS)
        score = weighted([
            (3, n >= 40), (2, n.between(20, 39)), (1, n.between(10, 19)), (-2, n < 10), (1, unique > 0.6), (-1, unique < 0.35), (-3, hits >= 3), (-2, hits == 2), (-3, short > 0.7), (-1, (short > 0.5) & (short <= 0.7)),
            (1, raw.rlike("[.:;]")), (0.5, raw.rlike(r"\b\d{4}\b")), (0.5, raw.rlike(r"(?i)\bhttps?://")), (0.5, raw.rlike(P.EMAIL)),
        ])
        flags = reasons([
            ("too_short", n < 10), ("low_lexical_diversity", unique < 0.35), ("navigation_like", hits >= 3), ("some_navigation_noise", hits == 2), ("link_list_like", short > 0.7),
            ("partly_list_like", (short > 0.5) & (short <= 0.7)),
        ])
        empty = x["norm"] == ""
        total = F.when(empty, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(10.0), F.round(score, 2))))
        return F.struct(total.alias("score"), first_case([("keep", total >= 5), ("review", total >= 3)], "discard").alias("decision"), F.when(empty, F.array(F.lit("empty_block"))).otherwise(flags).alias("flags"))

    return let(judged, raw=F.coalesce(text, F.lit("")), norm=X.normalised(text), words=X.tokens(text))


# Parts of addresses that no entity is expected on, and first segments of which one is.
IGNORED_PAGES = ["elementor_library", "wp-json", "/aviso-legal", "privacidad", "cookies", "accesibilidad", "/feed", "/tag/", "/category/", "/author/", "/search/"]
VALUABLE_SEGMENTS = ["area-profesional", "ayuntamiento", "en", "lugar", "que-ver-en-pamplona-lugares-imprescindibles", "planifica-tu-viaje", "tipo-lugar"]


def zero_page_kind(url: Column) -> Column:
    """What to do about a page without entities."""
    parts = U.segments(url)
    return first_case([
        ("ignore", any_in(F.lower(F.coalesce(url, F.lit(""))), IGNORED_PAGES)), ("homepage_or_portal", F.size(parts) == 0), ("likely_rescatable", F.get(parts, F.lit(0)).isin(VALUABLE_SEGMENTS)),
        ("review_by_family", F.size(parts) >= 2),
    ], "review_single_segment")


def address_pattern(url: Column) -> Column:
    """The family of an address: its first segment, and whether more follow."""
    parts = U.segments(url)
    first = F.concat(F.lit("/"), F.get(parts, F.lit(0)))
    return (
        F.when(F.size(parts) == 0, "/").when(F.contains(U.query(url), F.lit("elementor_library")), "?elementor_library")
        .when(F.size(parts) == 1, first).otherwise(F.concat(first, F.lit("/...")))
    )


# How a name is cut short.
CUT_TAILS, CUT_HEADS = [" de", " del", " la", " el", " los", " las", " y"], ["de ", "del ", "y "]


def review_bucket(name: Column, cls: Column, description: Column, located: Column, pictured: Column, candidates: Column) -> Column:
    """Why an entity waits for review, the first reason that holds."""
    plain = X.normalised(name)
    ends = reduce(Column.__or__, [F.endswith(plain, F.lit(t)) for t in CUT_TAILS] + [F.startswith(plain, F.lit(h)) for h in CUT_HEADS])
    noisy = F.coalesce(description, F.lit("")).rlike(r"(?i)ES\s+EN\s+FR\s+IT\s+PT\s+DE|\b(?:Saber|Leer|Mostrar)\s+m[aá]s\b|\bIr a\b")
    physical = cls.isin(V.PHYSICAL_CLASSES)
    return first_case([
        ("suspicious_name", ends), ("navigation_noise", noisy), ("missing_geo_and_image", physical & ~located & ~pictured), ("missing_geo", physical & ~located),
        ("only_weak_image_candidates", ~pictured & candidates), ("missing_image", ~pictured),
    ], "manual_review")
