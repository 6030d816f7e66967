import hashlib
from collections import Counter

from pyspark.sql import functions as F

from quernstone.llm.line_dedup import LineRuns, dedup_lines, line_rows

from .frames import awkward, clashing, empty, lower_ascii

SPACE = " \t\n\x0b\x0c\r"


def brute(texts, least):
    split = [(t or "").split("\n") for t in texts]
    key = lambda line: lower_ascii(line.strip(SPACE))
    met = Counter(k for lines in split for k in {key(x) for x in lines} if k)
    out = []
    for lines in split:
        kept = [x for x in lines if not key(x) or met[key(x)] < least]
        out.append((len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def shared(spark):
    extra = [(100 + k, f"Own {k}\n  SHARED line\t\nshared LINE\n\nÉ {k % 2}", "en", "s", 1) for k in range(12)]
    return awkward(spark, extra)


def test_equals_brute_force(spark):
    docs = shared(spark)
    for least in (2, 6, 12, 13):
        got = dedup_lines(docs, min_docs=least, digest=True, batches=3, fanout=2).collect()
        assert sorted((r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == brute([r.text for r in docs.collect()], least)


def test_text_and_columns(spark):
    docs = clashing(shared(spark), "n_lines", "h1", "batch")
    got = dedup_lines(docs, min_docs=12, batches=2)
    assert set(got.columns) == {*docs.columns, "n_dropped"} and got.count() == docs.count()
    assert got.filter("doc_id = 100").first().text == "Own 0\n\nÉ 0"
    assert got.filter("doc_id = 4").first().text is None
    assert {r.h1 for r in got.collect()} == {"mine"}


def test_runs_compact_and_remember(spark):
    rows = line_rows(shared(spark), 4, 1).cache()
    runs = LineRuns(spark, 6, fanout=2)
    for batch in range(4):
        runs.add(rows.filter(F.col("batch") == batch))
    true = {(r.h1, r.h2) for r in rows.groupBy("h1", "h2").count().filter("count >= 6").collect()}
    assert {(r.h1, r.h2) for r in runs.repeated().collect()} == true
    assert sum(map(len, runs.levels)) < 4


def test_counts_go_on_after_promotion(spark):
    rows = line_rows(shared(spark), 4, 1).cache()
    runs = LineRuns(spark, 2, fanout=2)
    for batch in range(4):
        runs.add(rows.filter(F.col("batch") == batch))
    true = {(r.h1, r.h2): r["count"] for r in rows.groupBy("h1", "h2").count().filter("count >= 2").collect()}
    assert {(r.h1, r.h2): r.n for r in runs.repeated().collect()} == true
    before = len(spark.catalog.listTables())
    runs.close()
    assert len(spark.catalog.listTables()) < before and not [t for t in spark.catalog.listTables() if t.name in runs.held]


def test_clashing_names_and_bytes_that_are_not_text(spark):
    docs = clashing(shared(spark), "__id", "__drops", "__row", "row")
    assert dedup_lines(docs, min_docs=12).count() == docs.count()
    bad = spark.sql("SELECT id AS doc_id, CAST(unhex(concat('FF0A6C696E650A', hex(CAST(id AS STRING)))) AS STRING) AS text FROM range(12)")
    got = dedup_lines(bad, min_docs=13).select(F.hex(F.col("text").cast("binary")).alias("h"), "n_dropped").collect()
    assert {r.h for r in got} == {"FF0A6C696E650A" + str(k).encode().hex() for k in range(12)}
    got = dedup_lines(bad, min_docs=12).select(F.hex(F.col("text").cast("binary")).alias("h")).collect()
    assert {r.h for r in got} == {str(k).encode().hex() for k in range(12)}


def test_empty(spark):
    assert dedup_lines(empty(spark), digest=True).count() == 0
