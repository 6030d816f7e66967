"""URL projections and predicates."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.functions import vocabulary as V
from quernstone.functions.rules import any_in, first_case

_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(?:#.*)?$"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _PARTS, 1))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _PARTS, 2))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 4)


def segments(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda x: x != "")


def crawl_url(url: Column) -> Column:
    """http(s) only; lower-case host, no fragment, no doubled or trailing slash; else null."""
    p = F.regexp_replace(F.when(path(url) == "", F.lit("/")).otherwise(path(url)), "//", "/")
    p = F.when(p == "/", p).otherwise(F.regexp_replace(p, "/+$", ""))
    return F.when(scheme(url).isin("http", "https"), F.concat(scheme(url), F.lit("://"), host(url), p, query(url)))


def eval_url(url: Column) -> Column:
    """The key of the evaluation: lower case, https, no www, fragment or trailing slash."""
    s = F.replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), F.lit("http://"), F.lit("https://"))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"^https://www\.", "https://"), "#.*$", ""), "/+$", "")


def source_url(url: Column) -> Column:
    """The key of a source page: language prefix, query and fragment dropped, escapes decoded."""
    p = F.regexp_replace(F.try_url_decode(F.replace(path(url), F.lit("+"), F.lit("%2B"))), "/+$", "")
    p = F.regexp_replace(p, "^/(?:web/guest|es|en|fr|it|pt|de)(?=/|$)", "")
    return F.concat(scheme(url), F.lit("://"), host(url), F.when(p == "", F.lit("/")).otherwise(p))


def slug_text(url: Column) -> Column:
    """The last path segment as words."""
    return F.coalesce(F.trim(F.regexp_replace(F.try_element_at(segments(url), F.lit(-1)), "[-_]+", " ")), F.lit(""))


def path_tokens(url: Column) -> Column:
    return F.filter(F.split(F.lower(path(url)), "[^a-z0-9]+"), lambda x: x != "")


def prefix(url: Column, depth: int) -> Column:
    return F.concat(F.lit("/"), F.concat_ws("/", F.slice(segments(url), 1, depth)))


def in_scope(url: Column, hosts: list[str], base: str = "/") -> Column:
    """On one of the hosts and below the base path."""
    return host(url).isin(hosts) & below(url, base)


def below(url: Column, base: str = "/") -> Column:
    """At or below the base path."""
    return F.lit(True) if base == "/" else (path(url) == base) | F.startswith(path(url), F.lit(base + "/"))


def skipped(url: Column, languages: list[str] | None = None) -> Column:
    """Other languages, files, feeds and technical addresses, which a crawl leaves out."""
    languages = V.BLOCKED_LANGUAGES if languages is None else languages
    first = F.lower(F.coalesce(F.try_element_at(segments(url), F.lit(1)), F.lit("")))
    language = first.rlike(f"^(?:{'|'.join(languages)})(?:-.*)?$") if languages else F.lit(False)
    ending = reduce(Column.__or__, [F.endswith(F.lower(path(url)), F.lit(x)) for x in V.BAD_EXTENSIONS])
    return language | ending | any_in(F.lower(url), V.BAD_URL_PARTS) | any_in(F.lower(query(url)), V.BAD_QUERY_PARTS)


def plausible_link(link: Column) -> Column:
    """A raw link with two path segments that isn't cut off in mid-slug."""
    p = F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), path(link)).otherwise(link)
    parts = F.filter(F.split(p, "/"), lambda x: x != "")
    last = F.lower(F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("")))
    return ~link.rlike(r"^[{\[]| ") & F.startswith(p, F.lit("/")) & (F.size(parts) >= 2) & ~last.isin(V.CUT_SLUG_TAILS)


def page_type(url: Column) -> Column:
    """The type that the first matching part of the URL tells."""
    low = F.lower(F.coalesce(url, F.lit("")))
    return first_case([(name, any_in(low, parts)) for name, parts in V.PAGE_TYPES], "unknown")


@F.pandas_udf(T.StringType())
def absolute(base: pd.Series, link: pd.Series) -> pd.Series:
    """A link resolved against its page; null where it can't be."""
    from urllib.parse import urljoin

    def join(b, u):
        try:
            return urljoin(b or "", u) if u is not None else None
        except ValueError:
            return None

    return pd.Series([join(b, u) for b, u in zip(base, link, strict=True)])
