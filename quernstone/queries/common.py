"""The registry of queries, and relations of literals that both engines read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        """Register a query under its function's name, with its equivalent where SQL has one."""

        def put(f):
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return put

    def merge(self, other: Registry) -> None:
        self.queries |= other.queries
        self.sql |= other.sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(x: object) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).upper()
    if isinstance(x, (int, float)):
        return repr(x)
    return "'" + str(x).replace("'", "''") + "'"


class Literal:
    """A small relation of fixed rows: a DataFrame here, VALUES there."""

    def __init__(self, schema: str, rows: list[tuple]):
        self.schema, self.rows = schema, rows
        self.names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.schema)

    def values(self, name: str) -> str:
        """A common table expression of this name."""
        kinds = {"string": "VARCHAR", "double": "DOUBLE", "long": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}
        casts = ", ".join(f"CAST({n} AS {kinds[c.strip().split(' ')[1]]}) AS {n}" for n, c in zip(self.names, self.schema.split(","), strict=True))
        rows = ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in self.rows)
        return f"{name} AS (SELECT {casts} FROM (VALUES {rows}) v({', '.join(self.names)}))"


def case_first(cases: list[tuple[str, str]], otherwise: str) -> str:
    """A CASE of (name, condition) in DuckDB's SQL."""
    return "CASE " + " ".join(f"WHEN {c} THEN {quoted(n)}" for n, c in cases) + f" ELSE {otherwise} END"


def any_of(text: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {quoted(p)})" for p in parts) + ")"


def sum_of(text: str, weights: dict[str, float]) -> str:
    return " + ".join(f"CASE WHEN contains({text}, {quoted(t)}) THEN {w} ELSE 0.0 END" for t, w in weights.items())
