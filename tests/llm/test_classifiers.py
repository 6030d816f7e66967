import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quernstone.llm import quality, toxicity
from quernstone.llm.linear import Dense, Entries, logistic, sampled_texts, sigmoid, smallest_hashes

from .frames import awkward, clashing, empty, words


def clean(seed):
    return " ".join(words(60 + seed % 50, seed)).capitalize() + "."


def junk(seed):
    r = random.Random(seed)
    return " ".join(w + r.choice(["&&&", "$$$", "%%%"]) for w in words(60, seed))


def test_quality_on_held_out_rows(spark):
    rows = [(k, junk(k) if k % 5 == 0 else clean(k)) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 0 if k % 5 == 0 else 1) for k in range(900) if k % 2], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert abs(model.prior - 0.8) < 0.12
    got = quality.score_quality(docs, model).collect()
    right = sum(r.predicted == (r.doc_id % 5 != 0) for r in got)
    assert right >= 0.97 * len(got) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_prior_estimate():
    rng = np.random.default_rng(0)
    positive = rng.normal(2, 1, 4000)
    for share in (0.3, 0.6, 0.9):
        n = int(4000 * share)
        mixed = np.concatenate([rng.normal(2, 1, n), rng.normal(-3, 1, 4000 - n)])
        assert abs(quality.estimate_prior(positive, mixed) - share) < 0.06


def test_quality_without_labels(spark):
    docs = clashing(awkward(spark), "score")
    none = spark.createDataFrame([(1, None), (99, 1)], "doc_id long, quality int")
    assert {r.score for r in quality.score_quality(docs, quality.train(docs, none)).collect()} == {0.5}
    some = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (8, 1)], "doc_id long, quality int")
    assert quality.score_quality(docs, quality.train(docs, some, 10**6, 1)).count() == docs.count()
    assert quality.score_quality(empty(spark), quality.train(empty(spark), some)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    bad = ["idiot", "trash", "zorkling", "zorkest"]
    rows = [(k, clean(k) + " " + " ".join(random.Random(k).choices(bad, k=3)) if k % 4 == 0 else clean(k)) for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(800)], "doc_id long, toxic int")
    chain = toxicity.train(docs, labels)
    assert chain.names == ["kind1", "kind2", "toxic"] and len(chain.models[2]) == len(chain.place) + 3
    got = toxicity.score_toxicity(docs, chain).withColumn("held", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0).filter("held").collect()
    assert len(got) > 100 and sum(r.toxic_predicted == (r.doc_id % 4 == 0) for r in got) >= 0.97 * len(got)


def test_categories_of_the_caller_and_one_row_of_an_id(spark):
    rows = [(k, clean(k) + (" insulted" * (k % 4 == 0)) + (" threatened" * (k % 8 == 0))) for k in range(400)]
    docs = spark.createDataFrame(rows + [(4, clean(4))] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 8 == 0), int(k % 4 == 0)) for k in range(400)], "doc_id long, threat int, toxic int")
    chain = toxicity.train(docs, labels, categories=["threat"])
    assert chain.names == ["threat", "toxic"]
    got = {r.doc_id: r for r in toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), chain).collect()}
    assert sum((got[k].p_threat >= 0.5) == (k % 8 == 0) for k in got) >= 390
    assert sum(got[k].toxic_predicted == (k % 4 == 0) for k in got) >= 390


def brute_counts(raw):
    """The features of one text, word by word."""
    found = Counter()
    for w in re.findall(r"[^\W\d_]+", raw.decode("utf-8", "replace").lower()):
        found.update(toxicity.word_features(w.encode()))
    return found


def test_features_and_chain_against_plain_loops(spark):
    raws = [(r.text or "").encode() for r in awkward(spark).collect()] + ["“Quoted” words—and Ünïcode".encode(), b"\xff bad bytes"]
    row, feature, count = toxicity.feature_counts(raws, toxicity.Remembered())
    got = [Counter() for _ in raws]
    for r, f, n in zip(row.tolist(), feature.tolist(), count.tolist(), strict=True):
        got[r][f] = n
    assert got == [brute_counts(x) for x in raws]
    rng = np.random.default_rng(3)
    dense = rng.random((60, 5)) * (rng.random((60, 5)) < 0.4)
    y = {"a": (dense[:, 0] > 0.2).astype(float), "b": (dense[:, 1] > 0.3).astype(float)}
    at = np.nonzero(dense)
    fold = np.arange(60) % 4
    chain = toxicity.fit_chain(Entries(*at, dense[at], dense.shape), y, fold, {})
    # The first model, then its out-of-fold probabilities as a sixth column of the second.
    first = Dense(dense)
    assert np.allclose(chain.models[0], logistic(first, y["a"]))
    out = np.zeros(60)
    for k in range(4):
        w = logistic(Dense(dense[fold != k]), y["a"][fold != k])
        out[fold == k] = sigmoid(dense[fold == k] @ w[:-1] + w[-1])
    assert np.allclose(chain.models[1], logistic(Dense(np.column_stack([dense, out])), y["b"]))


def test_risk_and_its_gradient_against_a_plain_loop():
    rng = np.random.default_rng(5)
    p, u, prior, ridge = rng.normal(1, 1, (40, 3)), rng.normal(0, 1, (70, 3)), 0.4, 1e-3

    def risk(w):
        z = lambda row: sum(a * b for a, b in zip(row, w, strict=False)) + w[-1]
        up = sum(math.log1p(math.exp(-z(r))) for r in p) / len(p)
        down = sum(math.log1p(math.exp(z(r))) for r in u) / len(u) - prior * sum(math.log1p(math.exp(z(r))) for r in p) / len(p)
        return prior * up, down, ridge / 2 * sum(x * x for x in w[:-1])

    for w in (np.array([0.1, -0.2, 0.3, 0.05]), np.array([3.0, 2.0, 1.0, -9.0])):
        fits = risk(w)[1] >= 0
        numeric = []
        for k in range(4):
            step = np.eye(4)[k] * 1e-6
            (a0, b0, c0), (a1, b1, c1) = risk(w - step), risk(w + step)
            # Below zero, the step undoes the negatives' part.
            numeric.append(((a1 - a0) + (b1 - b0) if fits else -(b1 - b0)) / 2e-6 + (c1 - c0) / 2e-6)
        got = quality.risk_gradient(p, u, prior, ridge)(w)
        assert np.allclose(got, numeric, atol=1e-5), fits


def test_samples_are_bounded(spark):
    rows = spark.range(5000).withColumnRenamed("id", "doc_id")
    got = [r.doc_id for r in smallest_hashes(rows, "doc_id", 300).collect()]
    assert len(got) == 300 == len(set(got)) and [r.doc_id for r in smallest_hashes(rows.repartition(7), "doc_id", 300).collect()] == got
    docs = spark.createDataFrame([(1, "a")] * 50 + [(1, "b"), (2, None)], "doc_id long, text string")
    chosen = spark.createDataFrame([(1, 5), (2, 6)], "doc_id long, mark int")
    assert sorted((r.doc_id, r.mark) for r in sampled_texts(docs, chosen).collect()) == [(1, 5), (2, 6)]


def test_toxicity_awkward(spark):
    docs = clashing(awkward(spark), "p_toxic", "mark")
    labels = spark.createDataFrame([(1, None), (2, 0), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    assert got.count() == docs.count() and got.filter("toxic_predicted = 1").count() == 0
    nothing = labels.limit(0)
    assert toxicity.score_toxicity(docs, toxicity.train(docs, nothing)).filter("toxic_predicted = 1").count() == 0
    assert toxicity.score_toxicity(empty(spark), toxicity.train(empty(spark), labels)).count() == 0


def test_chain_feeds_earlier_probabilities():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    a = (x[:, 0] > 0).astype(float)
    b = ((x[:, 0] > 0) & (x[:, 1] > 0)).astype(float)
    at = np.nonzero(x)
    x = Entries(*at, x[at], x.shape)
    chain = toxicity.fit_chain(x, {"a": a, "b": b}, np.arange(600) % 4, {})
    assert [len(w) for w in chain.models] == [4, 5] and chain.models[1][3] > 0
    assert ((chain.probabilities(x)[:, 1] > 0.5) == b).mean() > 0.85
