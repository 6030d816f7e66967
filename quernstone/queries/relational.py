"""Ranking, merging and joining queries over documents, events, orders and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.operators import evaluation, ranking
from quernstone.queries.common import Registry, table

REGISTRY = Registry()


@REGISTRY.add("SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def keep_first_distinct(spark, sf_dir):
    return ranking.keep_first(table(spark, sf_dir, "documents"), ["text"], ["doc_id"]).select("doc_id", "source", "lang")


@REGISTRY.add("SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn FROM documents) WHERE rn = 1")
def dedupe_best_of(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return ranking.best_of(docs, ["source"], F.struct("n_chars", -F.col("doc_id")))


@REGISTRY.add("""SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS o_orderkey, array_to_string(list_sort(list_distinct(list(o_orderpriority))), '|') AS priorities, count(*) AS merged_count
FROM orders GROUP BY o_custkey""")
def group_merge_arrays(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", F.array("o_orderpriority").alias("priorities"))
    merged = ranking.merge_group(orders, "o_custkey", [F.col("o_totalprice")], ["priorities"], "o_orderkey")
    return merged.select("o_custkey", "o_orderkey", F.concat_ws("|", "priorities").alias("priorities"), "merged_count")


@REGISTRY.add("SELECT l_orderkey, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_quantity DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1")
def argmax_tiebreak(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    by = F.struct("l_extendedprice", "l_quantity", -F.col("l_linenumber"), -F.col("l_partkey"), -F.col("l_suppkey"))
    return ranking.best_of(rows, ["l_orderkey"], by).select("l_orderkey", "l_partkey", "l_linenumber")


@REGISTRY.add("SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def topk_per_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ranking.top_k(orders, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "rank")


@REGISTRY.add("""WITH v AS (SELECT user_id, event_type, count(*)::DOUBLE AS score FROM events GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS rn, coalesce(lead(score) OVER w, 0) AS second FROM v WINDOW w AS (PARTITION BY user_id ORDER BY score DESC, event_type))
SELECT user_id, event_type, score, score - second AS margin FROM r WHERE rn = 1""")
def best_second_margin(spark, sf_dir):
    votes = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).cast("double").alias("score"))
    return ranking.margins(votes, ["user_id"], "event_type", "score")


@REGISTRY.add("""WITH l AS (SELECT event_id, user_id, CASE event_type WHEN 'click' THEN 'Museum' WHEN 'view' THEN 'Place' WHEN 'purchase' THEN 'Church' ELSE 'Square' END AS label, CASE WHEN value > 50 THEN 1.0 ELSE 0.5 END AS weight FROM events),
t AS (SELECT user_id, label, sum(CASE WHEN label IN ('Unknown','Place','Organization','Service','Concept','Accommodation') THEN weight * 0.35 ELSE weight END) AS score FROM l GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS rn, coalesce(lead(score) OVER w, 0) AS second FROM t WINDOW w AS (PARTITION BY user_id ORDER BY score DESC, label))
SELECT user_id, label, round(score, 6) AS score, CASE WHEN score >= 3.2 AND score - second >= CASE WHEN score >= 5.0 THEN 0.65 ELSE 1.0 END AND label <> 'Place' THEN label ELSE 'Unknown' END AS elected
FROM r WHERE rn = 1""")
def vote_tally(spark, sf_dir):
    label = F.when(F.col("event_type") == "click", "Museum").when(F.col("event_type") == "view", "Place").when(F.col("event_type") == "purchase", "Church").otherwise("Square")
    votes = table(spark, sf_dir, "events").select("user_id", label.alias("label"), F.when(F.col("value") > 50, 1.0).otherwise(0.5).alias("weight"))
    return ranking.elect(votes, ["user_id"], "label", "weight").select("user_id", "label", F.round("score", 6).alias("score"), "elected")


@REGISTRY.add("SELECT doc_id, source || '__' || lang || CASE WHEN rn = 1 THEN '' ELSE '_' || rn END AS entity_id FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS rn FROM documents)")
def collision_suffix_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("__", "source", "lang").alias("base"))
    return ranking.suffixed_ids(docs, "base", ["doc_id"]).select("doc_id", "entity_id")


@REGISTRY.add("""WITH b AS (SELECT 0 AS s, doc_id, lang FROM documents WHERE n_chars > 2000 UNION ALL SELECT 1, doc_id, lang FROM documents WHERE n_chars > 500),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s, doc_id) AS rn FROM b) WHERE rn = 1)
SELECT lang, doc_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY s, doc_id) AS rank FROM k) WHERE rank <= 12""")
def union_dedupe_cap(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return ranking.union_capped(docs.filter("n_chars > 2000"), docs.filter("n_chars > 500"), ["doc_id"], "lang", ["doc_id"], 12).select("lang", "doc_id", "rank")


@REGISTRY.add("""SELECT c.c_custkey, coalesce(NULLIF(c.c_mktsegment, 'BUILDING'), x.o_orderpriority) AS segment
FROM customer c LEFT JOIN (SELECT o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1) x ON c.c_custkey = x.o_custkey""")
def fill_if_missing_left(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"))
    first = ranking.keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"]).select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("segment"))
    return ranking.fill_missing(customers, first, ["c_custkey"], ["segment"])


@REGISTRY.add("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.value > 100)) WHERE rn = 1""")
def missing_parent_anti(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return ranking.rows_for_absent(events, events.filter("event_type = 'purchase' AND value > 100"), events, "user_id", [F.desc("value"), "event_id"]).select("user_id", "event_id")


@REGISTRY.add("""WITH k AS (SELECT doc_id, n_chars, CASE WHEN lang = 'en' AND source <> '' THEN 'classname|museum|' || source WHEN doc_id % 5 = 0 THEN 'id|' || source
  WHEN doc_id % 2 = 0 THEN 'namecoords|' || source || '|' || CAST(round(CAST(doc_id % 7 AS DOUBLE), 4) AS VARCHAR) || '|' || CAST(round(CAST(doc_id % 3 AS DOUBLE), 4) AS VARCHAR) ELSE 'name|' || source END AS dedupe_key FROM documents)
SELECT dedupe_key, count(*) AS merged_count, arg_max(doc_id, (n_chars, -doc_id)) AS doc_id FROM k GROUP BY dedupe_key""")
def dedupe_entities(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cls = F.when(F.col("lang") == "en", "Museum").otherwise("Unknown")
    even = F.col("doc_id") % 2 == 0
    key = ranking.dedupe_key(cls, F.col("source"), F.when(F.col("doc_id") % 5 == 0, F.col("source")), F.when(even, (F.col("doc_id") % 7).cast("double")), F.when(even, (F.col("doc_id") % 3).cast("double")))
    return ranking.merge_group(docs.select("doc_id", "n_chars", key.alias("dedupe_key")), "dedupe_key", [F.col("n_chars")], [], "doc_id").select("dedupe_key", "merged_count", "doc_id")


@REGISTRY.add("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY CUBE(l_returnflag, l_linestatus)")
def eval_rollup(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").filter("l_shipdate <= timestamp'1998-09-02'")
    return rows.cube("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


@REGISTRY.add("""SELECT a.event_type AS a, b.event_type AS b, count(DISTINCT a.user_id) AS n FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type < b.event_type GROUP BY ALL ORDER BY n DESC, a, b LIMIT 20""")
def ambiguous_pairs(spark, sf_dir):
    return evaluation.ambiguous_pairs(table(spark, sf_dir, "events"), "user_id", "event_type", 20)


@REGISTRY.add("SELECT lower(trim(event_type)) AS name, count(*) AS n FROM events GROUP BY 1")
def mention_counts(spark, sf_dir):
    from quernstone.streaming import streams

    return streams.mention_counts(table(spark, sf_dir, "events"), "event_type")


@REGISTRY.add("SELECT n_name, r_name, count(c_custkey) AS customers, round(avg(c_acctbal), 4) AS mean_balance FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def catalog_lookup(spark, sf_dir):
    nation, region, customer = (table(spark, sf_dir, t) for t in ("nation", "region", "customer"))
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey).join(customer, customer.c_nationkey == nation.n_nationkey, "left")
    return joined.groupBy("n_name", "r_name").agg(F.count("c_custkey").alias("customers"), F.round(F.avg("c_acctbal"), 4).alias("mean_balance"))


@REGISTRY.add("SELECT o.o_orderkey, o.o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def cache_left_anti(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")
