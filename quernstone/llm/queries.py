"""The thin queries that apply each operator to its whole table, and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import quality, toxicity
from quernstone.llm.additive_quantisation import nearest_neighbours
from quernstone.llm.decontaminate import mark_contaminated
from quernstone.llm.licence_scan import scan_licences, scan_sql
from quernstone.llm.line_dedup import dedup_lines
from quernstone.llm.linear import crc_fold
from quernstone.llm.lm_score import held_out, score_texts
from quernstone.llm.sentencepiece_viterbi import digest_round_trip
from quernstone.llm.simhash import simhash_components
from quernstone.llm.url_rules import judge_urls

#: The rules that the query of the URL filter judges by.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0, k=10)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), modulus=3, held=1)
    held = F.coalesce(crc_fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    return quality.score_quality(docs, model).select("doc_id", held, "score", "predicted")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), size=3)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), modulus=5, held=0)
    held = F.coalesce(crc_fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")
    return toxicity.score_toxicity(docs, chain).withColumn("held_out", held).drop("text")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, min_docs=10, min_length=1, digest=True).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mark_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10).drop("text")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 7, 2))


_UP, _LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

SQL = {
    "op5_line_dedup": rf"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
line AS (
  SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM doc),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_UP}, {_LOW}) AS k FROM line),
hot AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (k IN (FROM hot)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (k NOT IN (FROM hot)), '')) AS kept_sha256
FROM keyed GROUP BY r, doc_id""",
    "op6_url_filter": rf"""
WITH rule(host, path, verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
page AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {_UP}, {_LOW}) AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
best AS (
  SELECT p.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM page p JOIN rule r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM page p LEFT JOIN best b USING (page_id)""",
    "op8_licence_scan": scan_sql(),
    "op9_decontamination": rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UP}, {_LOW}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_UP}, {_LOW}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_aggregate(w[i : i + 9], 'string_agg', ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM win),
cut AS (
  SELECT doc_id, i, n, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size WHERE len(w) >= n)),
met AS (SELECT c.doc_id, c.i, c.n, w.item_id FROM cut c JOIN win w ON c.n = w.n AND c.win = w.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS listed FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM met) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
}

QUERIES = {"op2_quality": op2_quality, "op4_toxicity": op4_toxicity, "op1_nearest": op1_nearest, "op7_sentencepiece": op7_sentencepiece, "op8_licence_scan": op8_licence_scan, "op3_simhash": op3_simhash, "op10_lm_score": op10_lm_score, "op5_line_dedup": op5_line_dedup, "op6_url_filter": op6_url_filter, "op9_decontamination": op9_decontamination}
