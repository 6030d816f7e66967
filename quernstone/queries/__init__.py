"""Queries over the driver's tables, one for each operator family, with DuckDB equivalents."""

from __future__ import annotations

from quernstone.queries import consolidation, evidence, ontology, pages, relational, reports, resolve, rules, scoring, streams, text, typing
from quernstone.queries.common import Registry

MODULES = (pages, relational, scoring, text, rules, ontology, resolve, consolidation, streams, typing, evidence, reports)


def registry() -> Registry:
    found = Registry()
    for module in MODULES:
        found.merge(module.REGISTRY)
    return found
