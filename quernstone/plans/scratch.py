"""Tables that cut lineage, written where every executor and the driver can read them."""

from __future__ import annotations

import atexit
import gc
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no shared folder and all of Spark runs on this machine, as in tests.
LOCAL_FOLDER = "/tmp/checkpoints/quernstone"

_made: list[tuple[SparkSession, str]] = []
#: What the steps in progress have stored, where they are some of ``temporary``.
_step: ContextVar[list[str] | None] = ContextVar("step", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or a local one where that is unset and the master is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return LOCAL_FOLDER


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; it is deleted when the driver's Python ends."""
    path = f"{shared_folder(spark).rstrip('/')}/quernstone-{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path with the file system that it belongs to."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Files of a stored table for each core of the cluster, at most; more partitions are written one after the other by a task.
FILES = 2


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Unlike ``checkpoint()`` this keeps the columnar form and the table's size for the optimizer;
    unlike ``localCheckpoint()`` it outlives an executor. A chain of many small tables would otherwise be mostly files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (step := _step.get()) is not None:
        step.append(path)
    df.coalesce(max(1, FILES * spark.sparkContext.defaultParallelism)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession):
    """What is stored meanwhile goes at the end, and so do its shuffle files, but for the tables that a kept frame reads.

    Gives a function that keeps a frame and returns it. What a step within a step keeps is the outer one's.
    """
    outer, own = _step.get(), []
    kept: list[str] = []
    token = _step.set(own)

    def keep(df: DataFrame) -> DataFrame:
        kept.extend(df.inputFiles())
        return df

    try:
        yield keep
    finally:
        _step.reset(token)
        for path in own:
            folder = f"/{path.rsplit('/', 1)[1]}/"
            if not any(folder in file for file in kept):
                drop_path(spark, path)
            elif outer is not None:
                outer.append(path)
        release(spark)


class Bucketed:
    """Tables of one call, each bucketed by a key in the shared folder, so that joins on it move one side only.

    ``large`` is for rows of several packed MB. Each is a row group of its own, since writers and readers hold a
    whole group, and isn't compressed again, since codecs keep buffers outside the heap for their largest page.
    """

    LARGE = {"compression": "none", "parquet.block.size": str(1 << 20), "parquet.page.size.row.check.min": "1"}

    def __init__(self, spark: SparkSession, key: str, large: bool = False):
        self.spark, self.key, self.names = spark, key, []
        self.options = self.LARGE if large else {}
        self.folder = scratch_path(spark, "bucketed")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def store(self, df: DataFrame) -> DataFrame:
        """``df``, which is dealt out by the key already, as a table."""
        name = f"quernstone_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, self.key).options(path=f"{self.folder}/{name}", **self.options).format("parquet").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        """Forget the tables and delete their files, when what was read from them is written."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = []
        drop_path(self.spark, self.folder)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files and broadcasts of steps that are done.

    Spark removes them when the driver collects garbage, which by itself it does every half hour or when its
    heap is full; a chain of stored tables would keep all of its shuffles on the executors' disks until then.
    """
    gc.collect()
    spark._jvm.System.gc()


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            drop_path(spark, path)
        except Exception:  # the JVM may have ended before the interpreter
            return
