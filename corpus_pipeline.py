"""The corpus pipeline: five stages over documents, each written as Parquet and read by the next.

Toxic documents go; lines that many documents share go from their texts; of each group of near copies one
document stays; documents that hold a benchmark passage go; what is left is encoded in pieces. All stages
but the last return the columns of documents, with the other columns as they were.

Cases, in all stages: nulls in any column are kept, a null text counting as empty; texts of any length, also without
words, are read whole; repeated rows and ids are judged each, but for near copies, where equal rows are one; extra
columns pass through, whatever their names; an empty table gives an empty table, and empty labels or an empty
benchmark let every document pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import toxicity
from quernstone.llm.decontaminate import mark_contaminated
from quernstone.llm.line_dedup import dedup_lines
from quernstone.llm.sentencepiece_viterbi import encode_texts
from quernstone.llm.simhash_groups import drop_near_copies
from quernstone.plans.scratch import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain's last model rejects go; ties at one half are rejected. Without labels none goes."""
    chain = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, chain).filter("toxic_predicted = 0").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go; a text may become empty, and n_chars follows the text."""
    kept = dedup_lines(docs, min_docs=10).drop("n_lines", "n_dropped")
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; documents without an id all stay."""
    return drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or all of a shorter item, go."""
    return mark_contaminated(docs, _table(spark, sf_dir, "benchmark")).filter("NOT contaminated").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids, which decode to the text; an empty text has none."""
    return encode_texts(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dedup", drop_copies), ("decontamination", drop_contaminated), ("sentencepiece", encode)]

#: Toxicity is a fitted model, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
