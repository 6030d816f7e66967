"""Joins whose hot keys are split off by arithmetic, not by luck."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most this many keys can each hold more than 1/HEAVY_KEYS of the rows, so they may be broadcast.
HEAVY_KEYS = 10_000


def heavy_light_join(rows: DataFrame, keyed: DataFrame, on: list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``keyed``, which has one row per key and the key's number of rows in ``count``.

    Keys with over ``total / HEAVY_KEYS`` rows number fewer than HEAVY_KEYS whatever the data are; they
    are broadcast. No key of the rest can make a partition hot, so the rest is an ordinary shuffled join.
    ``how`` is inner or left_semi.
    """
    cut = total // HEAVY_KEYS + 1
    heavy = keyed.filter(F.col(count) >= cut).drop(count)
    light = keyed.filter(F.col(count) < cut).drop(count)
    hot = rows.join(F.broadcast(heavy), on, how)
    rest = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(light, on, how)
    return hot.unionByName(rest)
