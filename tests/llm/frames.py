"""Small documents with every awkward row, and the reference computations that tests compare with."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed):
    r = random.Random(seed)
    return [r.choice(["alpha", "beta", "gamma", "delta", "Épée", "o", "river", "stone", "x1", "blue"]) + str(r.randrange(40)) for _ in range(n)]


def awkward(spark, extra=()):
    """Nulls in every column, empty and very long texts, repeated rows and ids, and copies."""
    base = " ".join(words(60, 1))
    near = base.split(" ")
    near[30] = "changed"
    rows = [
        (1, base, "en", "s", 1), (2, base, None, None, None), (3, " ".join(near), "en", "s", 2), (4, None, "en", "s", 0), (5, "", "en", "s", 0),
        (None, "no id here\nand a second line", "en", "s", 3), (None, None, None, None, None), (7, "\n\n \t\n", "en", "s", 4), (8, "one", "en", "s", 3),
        (9, "repeated row", "en", "s", 3), (9, "repeated row", "en", "s", 3), (10, "same id", "en", "s", 1), (10, "same id, other text", "en", "s", 1),
        (11, " ".join(words(30_000, 2)), "en", "s", 5), (12, "tab\there  and ▁ marks Ünïcode 日本語 \U0001f600", "en", "s", 6), *extra,
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df, *names):
    """The same rows with columns that an operator adds, under other types."""
    return df.select("*", *[F.lit("mine").alias(n) for n in names])


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
