"""Similarity of names, sets, vectors and places."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_KM = 6371.0


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity, which no built-in has; only for pairs that a block has brought together."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)])


def jaccard(a: Column, b: Column) -> Column:
    """Common over all elements; 0 where either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    """Common over the larger set's elements."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y))).otherwise(F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms)


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    half = lambda x, y: F.pow(F.sin(F.radians(y - x) / 2), 2)
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lng1, lng2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def in_box(lat: Column, lng: Column, south: float, north: float, west: float, east: float) -> Column:
    return lat.between(south, north) & lng.between(west, east)
