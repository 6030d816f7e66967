"""Rule tables as expressions: ordered cases, weighted sums and reasons, all inside Catalyst."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_in(text: Column, parts: list[str]) -> Column:
    """Whether a text holds one of the parts."""
    return reduce(Column.__or__, [F.contains(text, F.lit(p)) for p in parts])


def count_in(text: Column, parts: list[str]) -> Column:
    """How many of the parts a text holds."""
    return reduce(Column.__add__, [F.contains(text, F.lit(p)).cast("int") for p in parts])


def word_in(text: Column, words: list[str]) -> Column:
    """Whether a text holds one of the words, whole, also beside accented letters."""
    return text.rlike(rf"(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(words)})(?![\p{{L}}\p{{N}}_])")


def first_case(cases: list[tuple[str, Column]], otherwise: Column | str | None = None) -> Column:
    """The name of the first condition that holds."""
    named = [F.when(F.coalesce(condition, F.lit(False)), F.lit(name)) for name, condition in cases]
    last = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return F.coalesce(*named, last)


def weighted(rules: list[tuple[float, Column]]) -> Column:
    """The sum of the weights of the conditions that hold."""
    return reduce(Column.__add__, [F.when(F.coalesce(c, F.lit(False)), F.lit(float(w))).otherwise(F.lit(0.0)) for w, c in rules])


def reasons(cases: list[tuple[str, Column]]) -> Column:
    """The sorted names of all conditions that hold."""
    return F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in cases])))


def clamped(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def let(body, **values: Column) -> Column:
    """``body`` of a struct of the values, each of which is planned and computed once.

    A Column that many rules mention would otherwise be copied into every one of them.
    """
    bound = F.array(F.struct(*[v.alias(n) for n, v in values.items()]))
    return F.element_at(F.transform(bound, lambda x: body(x)), 1)


def mapping(table: dict[str, object]) -> Column:
    """A literal map."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def looked_up(table: dict[str, object], key: Column, default: object | None = None) -> Column:
    found = F.try_element_at(mapping(table), key)
    return found if default is None else F.coalesce(found, F.lit(default))
