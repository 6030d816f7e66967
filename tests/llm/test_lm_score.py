import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernstone.llm.elias_fano import EliasFano, NgramTrie, WordLevel, log10_of, quantised
from quernstone.llm.lm_score import STRENGTHS, held_out, score_texts

from .frames import awkward, clashing, empty, lower_ascii


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**62), max_size=300), st.lists(st.integers(0, 2**62), min_size=1, max_size=50))
def test_elias_fano(values, targets):
    values = np.array(sorted(values), np.uint64)
    ef = EliasFano(values)
    assert (ef[np.arange(len(values))] == values).all()
    probe = np.concatenate([np.array(targets, np.uint64), values, values + np.uint64(1)])
    place = np.searchsorted(values, probe, "left")
    assert (ef.next_geq(probe) == place).all()
    assert (ef.find(probe) == [p if p < len(values) and values[p] == x else -1 for p, x in zip(place, probe, strict=True)]).all()


def test_elias_fano_dense():
    values = np.repeat(np.arange(0, 4000, 3), 2).astype(np.uint64)
    ef = EliasFano(values)
    probe = np.arange(4100).astype(np.uint64)
    assert (ef.next_geq(probe) == np.searchsorted(values, probe, "left")).all()


def test_trie_lookups():
    rng = np.random.default_rng(1)
    pairs = {(int(a), int(b)): int(n) for a, b, n in zip(rng.integers(0, 60, 900), rng.integers(0, 300, 900), rng.integers(1, 50, 900), strict=True)}
    keys = sorted(pairs)
    v, w = (np.array([k[i] for k in keys], np.uint64) for i in (0, 1))
    present = np.unique(v)
    heads = np.append(np.searchsorted(v, present), len(v))
    p = np.array([pairs[k] / 60 for k in keys])
    words = np.unique(w)
    trie = NgramTrie(heads, words * np.uint64(977), np.searchsorted(words, w), quantised(p))
    asked = [(k, b) for k in range(len(present)) for b in range(310)]
    codes = trie.codes_at(trie.places(np.array([k for k, _ in asked]), trie.numbers(np.array([b for _, b in asked], np.uint64) * np.uint64(977))))
    true = [pairs.get((int(present[k]), b), 0) / 60 for k, b in asked]
    assert [c > 0 for c in codes] == [t > 0 for t in true]
    assert all(abs(log10_of(c) - math.log10(t)) < 2e-4 for c, t in zip(codes, true, strict=True) if t)


def test_word_level():
    rng = np.random.default_rng(2)
    hashes = np.unique(rng.integers(0, 2**64, 500, np.uint64))
    level = WordLevel(hashes[::2], np.arange(len(hashes[::2])) + 1)
    assert level.lookup(hashes).tolist() == [k // 2 + 1 if k % 2 == 0 else 0 for k in range(len(hashes))]
    assert WordLevel(hashes[:0], np.zeros(0, int)).lookup(hashes).sum() == 0


def brute(rows, order=3, strengths=STRENGTHS):
    """(n_tokens, n_known, N, base, score) for each (doc_id, text)."""
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(t)), "\n"] for _, t in rows]
    train = [zlib.crc32(str(d).encode()) % 7 != 2 if d is not None else True for d, _ in rows]
    counts = Counter()
    for t, use in zip(tokens, train, strict=True):
        if use:
            line = ["\r", *t]
            counts["\r",] += 1
            for k in range(1, order + 1):
                counts.update(tuple(line[i : i + k]) for i in range(k == 1, len(line) - k + 1))
    n = sum(c for k, c in counts.items() if len(k) == 1) - counts["\r",]
    v = sum(len(k) == 1 for k in counts) - (("\r",) in counts)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 1) / (n + v + 1)
        s = strengths[len(gram)]
        return (counts[gram] + s * p(gram[1:])) / (counts[gram[:-1]] + s)

    def score(t):
        line = ["\r", *t]
        return sum(math.log10(p(tuple(line[max(0, i - order + 1) : i + 1]))) for i in range(1, len(line)))

    return [(len(t), sum(counts[x,] > 0 for x in t), n, sum(math.log10(p((x,))) for x in t), score(t)) for t in tokens]


@pytest.mark.parametrize("block, shard, order, fan", [(10**6, 10**6, 3, 256), (500, 2000, 3, 256), (500, 400, 3, 4), (300, 500, 2, 3), (800, 3000, 4, 256)])
def test_scores(spark, block, shard, order, fan):
    extra = [(300 + k, f"the cat the dog sat on the mat number {k % 5} the end", "en", "s", 1) for k in range(40)]
    docs = awkward(spark, extra)
    strengths = {2: 40.0, 3: 5.0, 4: 2.0}
    got = score_texts(clashing(docs, "held", "block"), held_out(F.col("doc_id")), block, shard, order, fan, strengths).collect()
    key = lambda r: (str(r[0]), r[1], r[2], round(r[4], 6))
    found = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    true = sorted(((d, *x) for (d, _), x in zip(rows, brute(rows, order, strengths), strict=True)), key=key)
    assert len(found) == len(true)
    for f, t in zip(found, true, strict=True):
        assert f[:4] == t[:4] and abs(f[4] - t[4]) < 1e-6 * max(1, abs(t[4])) and abs(f[5] - t[5]) < 5e-4 * t[1] + 1e-9


def test_scores_do_not_depend_on_blocks(spark):
    docs = awkward(spark, [(300 + k, f"the cat {k % 3} the dog sat on {k % 7} mats", "en", "s", 1) for k in range(60)])
    runs = [{(str(r.doc_id), round(r.score, 9), round(r.base_score, 9)) for r in score_texts(docs, held_out(F.col("doc_id")), *sizes).collect()} for sizes in ((10**6, 10**6), (200, 300))]
    assert runs[0] == runs[1]


def test_hot_contexts_are_dealt_out(spark):
    # One word before everything: its successors must not meet in one shard.
    docs = spark.createDataFrame([(k, " ".join(f"the w{(k * 37 + j) % 500}" for j in range(60))) for k in range(80)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in score_texts(docs, held_out(F.col("doc_id")), 500, 300).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for (d, _), t in zip(rows, brute(rows), strict=True):
        assert abs(got[d] - t[4]) < 5e-4 * t[0]


def test_empty_and_untrained(spark):
    assert score_texts(empty(spark), held_out(F.col("doc_id"))).count() == 0
    got = score_texts(awkward(spark).filter("doc_id = 8"), F.lit(True)).first()
    assert got.n_known == 0 and got.train_tokens == 0 and got.score == got.base_score == 0


def test_bytes_that_are_not_text(spark):
    docs = awkward(spark).select("doc_id", "text").unionAll(spark.sql("SELECT 77L AS doc_id, CAST(X'61FF20FE0A62' AS STRING) AS text"))
    assert {r.doc_id: r.n_tokens for r in score_texts(docs, held_out(F.col("doc_id"))).collect()}[77] == 4


def test_a_relay_holds_what_a_block_does():
    import numpy as np

    from quernstone.llm.lm_score import BLOCK_TOKENS, SHARD_TOKENS, Route

    for tokens in (300_000_000, 1_000_000_000, 20_000_000_000):
        shards, blocks = tokens // SHARD_TOKENS + 1, tokens // BLOCK_TOKENS + 1
        route = Route(shards, blocks)
        held: dict[int, float] = {}
        # Each block sends an equal part of its tokens to each shard; some of the blocks tell the largest relay.
        some = range(0, blocks, max(1, blocks // 2000))
        for block in some:
            for dest, n in zip(*np.unique(route.first(np.arange(shards), block), return_counts=True), strict=True):
                held[int(dest)] = held.get(int(dest), 0) + n / shards * blocks / len(some)
        assert np.mean(list(held.values())) < 2 and len(held) > blocks / 4


def test_a_shard_holds_little_beside_what_is_asked():
    import tracemalloc

    from quernstone.llm.lm_score import Parcel, _serve

    rng = np.random.default_rng(5)
    parcels, n = [], 4000
    for block in range(200):
        contexts = np.unique(rng.integers(0, 200_000, n))
        sizes = rng.integers(1, 3, len(contexts)).astype(np.uint32)
        items = [rng.integers(0, 50_000, sizes.sum()), rng.integers(0, 3, sizes.sum()).astype(np.uint32), rng.integers(1, 60_000, sizes.sum()).astype(np.uint16)]
        index = [np.array([block]), np.array([0]), np.array([len(contexts)], np.int32), np.array([sizes.sum()], np.int32)]
        parcels.append(Parcel(index, [contexts, np.zeros(len(contexts), np.uint32), sizes, np.full(len(contexts), 1000, np.uint64)], items))
    asked = sum(len(p.items[0]) for p in parcels)
    tracemalloc.start()
    try:
        answers, _ = _serve(30.0, True)(parcels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(len(p.items[0]) for p in answers) == asked
    assert peak < 110 * asked  # bytes beside the parcels; when every n-gram was looked up at once they were 176


def test_blocks_are_sent_one_by_one_and_the_setting_stays(spark):
    from quernstone.llm.arrow import smaller_batches
    from quernstone.llm.lm_score import ROW_BYTES

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    with smaller_batches(spark, ROW_BYTES):
        rows = spark.range(6, numPartitions=1).select(F.repeat(F.lit("x"), 3 << 19).alias("x"))
        sizes = rows.mapInArrow(lambda parts: (p.select([]).from_pydict({"n": [p.num_rows]}) for p in parts), "n long").collect()
    assert [r.n for r in sizes] == [1] * 6
    assert spark.conf.get(name) == before
    score_texts(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), F.lit(False)).collect()
    assert int(spark.conf.get(name).rstrip("b")) > ROW_BYTES


def test_large_rows_are_row_groups_of_their_own(spark):
    from urllib.parse import urlparse

    import pyarrow.parquet as pq

    from quernstone.plans.scratch import Bucketed

    tables = Bucketed(spark, "block", large=True)
    try:
        rows = spark.range(6).select(F.col("id").alias("block"), F.repeat(F.lit("x"), 2 << 20).cast("binary").alias("tokens"))
        table = tables.store(rows.repartition(1, "block"))
        groups = [pq.read_metadata(urlparse(f).path) for f in table.inputFiles()]
        assert sum(g.num_row_groups for g in groups) == 6 and table.count() == 6
        assert {g.row_group(0).column(1).compression for g in groups} == {"UNCOMPRESSED"}
    finally:
        tables.drop()
