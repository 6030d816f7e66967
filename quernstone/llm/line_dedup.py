"""Line de-duplication over levelled sorted runs of line hashes.

A run is a table of (h1, h2, n, again): the 128-bit hash of a line's key and in how many documents it was met,
bucketed and sorted by the hash. Every batch of documents is merged with the run of lines that are known to be
repeated: the counts of its other lines are a run of level 0, those of known lines are marked in it and go on
being counted. When a level has ``fanout`` runs they are merged into one run of the next level; lines whose count
reaches ``min_docs`` move to the run of repeated lines, with what is marked. Nothing is held in memory or sent to
the driver, and the next batch of a crawl only reads runs, never earlier documents.

The counts of the repeated lines are whole, so they tell which lines are hot when the lines go back to their documents.

Cases: a null text is one empty line; a very long text is split like others; an empty key (below ``min_length`` code
points) is never dropped; each row is a document, also where a doc_id comes twice or is null; bytes that aren't UTF-8
are kept; an empty table gives an empty table; other columns are kept, and those named like an added one replaced.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm.arrow import frugal, mapped, small_batches, texts, unused, values, without
from quernstone.plans.joins import heavy_light_join
from quernstone.plans.scratch import drop_path, release, scratch_path, stored

SPACE = b" \t\n\v\f\r"
HASH = ["h1", "h2"]
ADDED = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return line.strip(SPACE).lower()


def _code_points(key: bytes) -> int:
    return len(key) - sum(0x80 <= b < 0xC0 for b in key)


def key_hashes(text: bytes, min_length: int) -> set[bytes]:
    """The 128-bit hashes of the distinct keys of at least ``min_length`` code points."""
    keys = {line_key(x) for x in text.split(b"\n")}
    if min_length > 1:
        keys = {k for k in keys if _code_points(k) >= min_length}
    keys.discard(b"")
    return {xxhash.xxh3_128_digest(k) for k in keys}


def row_key() -> Column:
    """A number for a row. Rows that share one only share the list of their repeated lines, which are dropped anyway."""
    return F.xxhash64("doc_id", "text")


def line_rows(docs: DataFrame, batches: int, min_length: int) -> DataFrame:
    """(row, batch, h1, h2): one row for each document and distinct line key."""

    def run(parts):
        for part in frugal(parts, 4096):
            found = [key_hashes(t, min_length) for t in texts(part, "text")]
            rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
            pairs = np.frombuffer(b"".join(h for x in found for h in x), dtype="<i8").reshape(-1, 2)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["row", "batch", *HASH])

    batch = F.pmod(F.col("row"), F.lit(batches)).cast("int").alias("batch")
    return small_batches(docs).select(row_key().alias("row"), "text").select("row", batch, "text").mapInArrow(run, "row long, batch int, h1 long, h2 long")


class LineRuns:
    """Levelled sorted runs of line hashes below one folder of the shared store."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 3, folder: str | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.folder = folder or scratch_path(spark, "runs")
        self.levels: list[list[str]] = [[]]
        self.repeated_run: str | None = None
        self.held: set[str] = set()
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, rows: DataFrame) -> str:
        name = f"quernstone_run_{uuid.uuid4().hex}"
        (rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name))
        self.held.add(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_path(self.spark, f"{self.folder}/{name}")
        self.held.discard(name)

    def close(self) -> None:
        """Drop all runs."""
        for name in list(self.held):
            self._drop(name)

    def add(self, lines: DataFrame) -> None:
        """Count a batch's lines and add them as a run, those that are known to be repeated marked."""
        counted = lines.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"))
        if self.repeated_run:
            known = self.spark.table(self.repeated_run).select(*HASH, F.lit(True).alias("again"))
            counted = counted.join(known, HASH, "left").select(*HASH, "n", F.coalesce("again", F.lit(False)).alias("again"))
        else:
            counted = counted.withColumn("again", F.lit(False))
        self.levels[0].append(self._write(counted))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self.compact(level)
            level += 1

    def _part(self, name: str, again: bool) -> DataFrame:
        return self.spark.table(name).filter(F.col("again") == again).select(*HASH, "n")

    def _merged(self, parts: list[DataFrame]) -> DataFrame:
        """Parts of runs merged like sorted lists: each has a key once, so full outer joins on their buckets add them up."""
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.join(part.withColumnRenamed("n", "m"), HASH, "full_outer").select(*HASH, (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
        return rows

    def _repeated_with(self, names: list[str]) -> DataFrame:
        """The run of repeated lines, with those of other runs that reach ``min_docs`` together and what is marked in them."""
        fresh = self._merged([self._part(name, False) for name in names]).filter(F.col("n") >= self.min_docs)
        held = [self.spark.table(self.repeated_run).select(*HASH, "n"), *(self._part(name, True) for name in names)] if self.repeated_run else []
        return self._merged([fresh, *held])

    def compact(self, level: int) -> None:
        """Merge a level's runs into one run of the next; lines met often enough become repeated ones."""
        old, self.levels[level] = self.levels[level], []
        if level + 1 == len(self.levels):
            self.levels.append([])
        was, self.repeated_run = self.repeated_run, self._write(self._repeated_with(old))
        rest = self._merged([self._part(name, False) for name in old]).filter(F.col("n") < self.min_docs)
        self.levels[level + 1].append(self._write(rest.withColumn("again", F.lit(False))))
        for name in [*old, *([was] if was else [])]:
            self._drop(name)

    def repeated(self) -> DataFrame:
        """(h1, h2, n) of all lines in at least ``min_docs`` documents."""
        return self._repeated_with([name for runs in self.levels for name in runs])


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_length: int = 1, batches: int = 4, fanout: int = 3, digest: bool = False) -> DataFrame:
    """Drop every line whose key is in at least ``min_docs`` documents; adds n_lines and n_dropped.

    The text keeps its other lines, joined by a line feed. With ``digest`` the column kept_sha256 takes
    the text's place.
    """
    spark = docs.sparkSession
    docs = without(docs, "n_lines", "n_dropped", "kept_sha256")
    rows = stored(line_rows(docs, batches, min_length), "lines")
    runs = LineRuns(spark, min_docs, fanout)
    for batch in range(batches):
        runs.add(rows.filter(F.col("batch") == batch))
    repeated = stored(runs.repeated(), "repeated")
    runs.close()
    release(spark)
    total = repeated.agg(F.sum("n")).first()[0] or 0
    met = heavy_light_join(rows.select("row", *HASH), repeated, HASH, "n", total, "left_semi")
    key, drops = unused(docs, "__row"), unused(docs, "__drops")
    listed = met.groupBy(F.col("row").alias(key)).agg(F.collect_set(F.struct(*HASH)).alias(drops))
    joined = docs.withColumn(key, row_key()).join(listed, key, "left").drop(key)

    def strip(part: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {"n_lines": [], "n_dropped": [], "text": [], "kept_sha256": []}
        raw = part.column(part.schema.get_field_index("text"))
        for text, drop, null in zip(texts(part, "text"), values(part, drops), raw.is_null().to_pylist(), strict=True):
            lines = text.split(b"\n")
            kept = lines
            if drop:
                gone = {np.array([x["h1"], x["h2"]], "<i8").tobytes() for x in drop}
                kept = [x for x in lines if not (k := line_key(x)) or xxhash.xxh3_128_digest(k) not in gone]
            out["n_lines"].append(len(lines))
            out["n_dropped"].append(len(lines) - len(kept))
            joined_text = text if len(kept) == len(lines) else b"\n".join(kept)
            if digest:
                out["kept_sha256"].append(hashlib.sha256(joined_text).hexdigest())
            else:
                out["text"].append(None if null else joined_text)
        out["text"] = pa.array(out["text"], pa.binary()).view(pa.string())
        return out

    if digest:
        return mapped(joined, strip, [*ADDED, T.StructField("kept_sha256", T.StringType())], ("text", drops))
    out = mapped(joined, strip, [*ADDED, T.StructField("text", T.StringType())], (drops,))
    return out.select(*docs.columns, "n_lines", "n_dropped")

