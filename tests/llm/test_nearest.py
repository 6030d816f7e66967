import numpy as np
from pyspark.sql import functions as F

from quernstone.llm.additive_quantisation import fit, index, nearest_neighbours, search


def exact(rows, k):
    rows = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q in (i for i in rows if i % 10 == 0):
        d = sorted((float(np.sqrt(((v - rows[q]) ** 2).sum())), i) for i, v in rows.items() if i != q)
        out[q] = d[:k]
    return out


def run(spark, rows, k=10, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in nearest_neighbours(df, F.pmod("vec_id", F.lit(10)) == 0, k=k, **more).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return got


def test_recall_on_random_vectors(spark):
    x = np.random.default_rng(0).normal(size=(3000, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    true, got = exact(rows, 10), run(spark, rows, books=12, size=32, shortlist=128)
    assert set(got) == set(true)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in true[q]}) for q in true)
    assert hits >= 0.9 * 10 * len(true)


def test_ties_and_unusable_rows(spark):
    rows = [(k, [1.0, 0.0]) for k in range(40)] + [(50 + k, [float(k + 2), 1.0]) for k in range(5)]
    bad = [(100, None), (110, []), (120, [0.0, 0.0]), (130, [1.0, None]), (140, [float("nan"), 1.0]), (150, [float("inf"), 1.0]), (160, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    got = run(spark, rows + bad)
    true = exact(rows, 10)
    assert got.keys() == true.keys()
    for q in true:
        assert [i for _, i in got[q]] == [i for _, i in true[q]] and np.allclose([d for d, _ in got[q]], [d for d, _ in true[q]])


def test_a_hot_vector_and_clashing_columns(spark):
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(2000)] + [(5000 + k, [float(k), 0.5, 1.0]) for k in range(200)]
    got = run(spark, rows, shortlist=64)
    true = exact(rows, 10)
    assert all([i for _, i in got[q]] == [i for _, i in true[q]] for q in list(true)[:: 20])
    df = spark.createDataFrame([(k, [float(k + 1)], "x", 1) for k in range(30)], "vec_id long, embedding array<float>, row string, score int")
    assert nearest_neighbours(df, F.col("vec_id") == 4, k=2).collect()[0].asDict() == {"query_id": 4, "rank": 1, "vec_id": 3, "score": 1.0}


def test_results_do_not_depend_on_partitions_or_blocks(spark):
    x = np.random.default_rng(2).normal(size=(900, 12))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = df.select("vec_id", "embedding", F.monotonically_increasing_id().alias("row"), F.col("embedding").alias("v"))
    found = fit(x, 6, 16)
    several = [
        sorted(map(tuple, search(index(rows.repartition(n).select("row", "vec_id", "v"), found), rows.filter("vec_id % 9 = 0").select("vec_id", "v"), found, 5, 40, block).collect()))
        for n, block in ((1, 4096), (5, 30))
    ]
    assert several[0] == several[1] and len(several[0]) == 500


def test_few_rows_and_none(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0]), (2, [-1.0])]) == {0: [(1.0, 1), (2.0, 2)]}
    assert run(spark, [(0, [1.0]), (0, [1.0])]) == {}
    assert run(spark, [(1, [0.0])]) == {}
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert nearest_neighbours(none, F.lit(True)).count() == 0


def test_beam_search_is_no_worse_than_greedy():
    x = np.random.default_rng(1).normal(size=(500, 8))
    found = fit(x, 4, 16, 4, 2)
    error = lambda beam: ((found.decode(found.encode(x, beam)) - x) ** 2).sum()
    assert error(8) <= error(1)
