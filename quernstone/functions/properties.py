"""Properties of an entity, read from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of properties.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONES = [r"\+34\s?\d{3}\s?\d{3}\s?\d{3}", r"\d{3}\s?\d{3}\s?\d{3}", r"\+?\d[\d\s-]{7,}\d"]
ADDRESS = r"(?i)(?:calle|plaza|avenida|paseo|avda\.?|c/)\s+[^,.;\n]{3,60}(?:,\s*\d{1,4})?"
HOURS = r"\d{1,2}:\d{2}\s*[-–a]\s*\d{1,2}:\d{2}"
PRICE = r"\d+[.,]?\d*\s?€"
RATING = r"([0-5](?:[.,][0-9])?)\s*/\s*5"
YEAR = r"(?:1[0-9]{3}|20[0-9]{2})"
NUMBER = r"([-+]?[0-9]+(?:\.[0-9]+)?)"
COORDINATES = [
    ("latlng", rf"(?i)(?:latitude|lat)[\s:=]+{NUMBER}.{{0,25}}?(?:longitude|lon|lng)[\s:=]+{NUMBER}"),
    ("map", rf"@{NUMBER},{NUMBER}"),
    ("query", rf"q={NUMBER},{NUMBER}"),
]
#: Priority of a coordinate's source.
GEO_SOURCES = {"jsonld": 4, "data-attrs": 3, "iframe": 2, "regex": 1}


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    got = F.regexp_extract(F.coalesce(text, F.lit("")), pattern, group)
    return F.when(got != "", F.trim(got))


def email(text: Column) -> Column:
    return _found(text, EMAIL)


def phone(text: Column) -> Column:
    """The first pattern's match that has nine digits."""
    tries = [_found(text, p) for p in PHONES]
    return F.coalesce(*[F.when(F.length(F.regexp_replace(t, r"\D", "")) >= 9, t) for t in tries])


def address(text: Column) -> Column:
    return _found(text, ADDRESS)


def hours(text: Column) -> Column:
    return _found(text, HOURS)


def price(text: Column) -> Column:
    return _found(text, PRICE)


def rating(text: Column) -> Column:
    return F.replace(_found(text, RATING, 1), F.lit(","), F.lit("."))


def number(text: Column) -> Column:
    """A decimal number that may have a comma."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def valid_point(lat: Column, lng: Column) -> Column:
    """A point where both numbers are in range, else null."""
    fine = lat.between(-90, 90) & lng.between(-180, 180)
    return F.when(fine, F.struct(lat.alias("lat"), lng.alias("lng")))


def coordinates(text: Column) -> Column:
    """The first of the written forms of a point."""
    text = F.coalesce(text, F.lit(""))
    points = [valid_point(F.regexp_extract(text, p, 1).try_cast("double"), F.regexp_extract(text, p, 2).try_cast("double")) for _, p in COORDINATES]
    return F.coalesce(*points)


def has_phone(text: Column) -> Column:
    return text.rlike(r"\+?\d[\d\s-]{7,}\d")


def has_email(text: Column) -> Column:
    return text.rlike(r"[^\s@]+@[^\s@]+\.[^\s@]+")
