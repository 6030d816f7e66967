"""Small helpers for mapInArrow functions."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: Rows that are worked on at once; Spark's own batches are ten thousand rows, long texts or not.
SLICE = 512


#: Bytes of an Arrow batch, each of which is held several times over by a task and its Python worker.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bound(spark: SparkSession, most: int) -> None:
    now = spark.conf.get(_BATCH_SETTING)
    if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= most:
        spark.conf.set(_BATCH_SETTING, str(most))


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches bounded to BATCH_BYTES; a smaller bound that is set stays."""
    _bound(df.sparkSession, BATCH_BYTES)
    return df


@contextmanager
def smaller_batches(spark: SparkSession, most: int):
    """Meanwhile the session's Arrow batches end with the row that reaches ``most`` bytes, or a smaller bound that is set."""
    before = spark.conf.get(_BATCH_SETTING)
    _bound(spark, most)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def trim() -> None:
    """Give freed memory back to the system."""
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give:
        give(0)


def frugal(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Batches in slices; freed memory goes back to the system, since Python workers outlive their tasks."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        trim()


def to_bytes(value: str | None) -> bytes:
    """UTF-8; null counts as empty, and a lone surrogate is kept."""
    return b"" if value is None else value.encode("utf-8", "surrogatepass")


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 of each value of a string column, null as empty, without decoding it."""
    values = batch.column(batch.schema.get_field_index(column))
    return [x or b"" for x in values.cast(pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()).to_pylist()]


def values(batch: pa.RecordBatch, column: str) -> list:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row at a time as Python values, for batches of few large rows."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to add, whatever case the input spells them in."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def unused(df: DataFrame, name: str) -> str:
    """A column name like this one that the input doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def mapped(df: DataFrame, make: Callable[[pa.RecordBatch], dict[str, list]], added: list[T.StructField], drop: tuple[str, ...] = ()) -> DataFrame:
    """Append columns computed from each Arrow batch; ``make`` returns a list per added field.

    Columns named in ``drop`` feed ``make`` and then go. An added field that the input has replaces it.
    """
    gone = {f.name for f in added} | set(drop)
    kept = [f for f in df.schema.fields if f.name not in gone]
    schema = T.StructType(kept + added)
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = to_arrow_schema(T.StructType(added))
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frugal(batches):
            out = make(batch)
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
            arrays += [x if isinstance(x := out[f.name], pa.Array) else pa.array(x, type=f.type) for f in wanted]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *wanted.names])

    return small_batches(df).mapInArrow(run, schema)
