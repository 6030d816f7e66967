"""The streaming variants, run over what is there and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.plans.scratch import scratch_path
from quernstone.queries.common import Registry, table
from quernstone.streaming import streams

REGISTRY = Registry()


def _sink(stream, mode):
    spark = stream.sparkSession
    path = scratch_path(spark, "sink")
    streams.run_once(stream, path, mode, scratch_path(spark, "stream"))
    return spark.read.schema(stream.schema).parquet(path)


def _events(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events*").withColumn("ts", F.col("ts").cast("timestamp"))


@REGISTRY.add("SELECT lower(trim(event_type)) AS name, count(*) AS n FROM events GROUP BY 1")
def stream_mention_counts(spark, sf_dir):
    return _sink(streams.mention_counts(_events(spark, sf_dir), "event_type"), "complete")


@REGISTRY.add("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, sf_dir):
    rows = _events(spark, sf_dir).withWatermark("ts", "3650 days").dropDuplicatesWithinWatermark(["user_id", "event_type"])
    return _sink(rows.select("user_id", "event_type"), "append")


@REGISTRY.add("SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_windowed_counts(spark, sf_dir):
    rows = streams.windowed_counts(_events(spark, sf_dir), "ts", "event_type", "1 day", "3650 days")
    return _sink(rows, "complete").withColumn("start", F.col("start").cast("timestamp_ntz"))
