"""The same steps over streams of files: distinct pages, running mention counts, windows of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import urls as U


def pages_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def distinct_pages(pages: DataFrame, time: str, late: str = "1 hour", url: str = "url") -> DataFrame:
    """The first page of each normalised address within the watermark; state for older ones is dropped."""
    return pages.withColumn("page_key", U.crawl_url(F.col(url))).withWatermark(time, late).dropDuplicatesWithinWatermark(["page_key"])


def mention_counts(rows: DataFrame, name: str) -> DataFrame:
    """Running counts of names, case ignored."""
    return rows.groupBy(F.lower(F.trim(name)).alias("name")).agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(events: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Tumbling counts with a watermark for late rows."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def run_once(stream: DataFrame, path: str, mode: str, checkpoint: str) -> None:
    """Work through what is there, write it as Parquet and stop. A complete result is written anew by each batch."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        writer = writer.format("parquet").option("path", path)
    else:
        writer = writer.foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(path))
    writer.start().awaitTermination()
