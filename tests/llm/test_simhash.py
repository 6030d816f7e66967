import random

import numpy as np
import pytest
import xxhash

from quernstone.llm import simhash
from quernstone.llm.simhash import LIMIT, fingerprint, fingerprint_components, simhash_components

from .frames import awkward, clashing, empty, lower_ascii


def brute_print(text, size=3):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", lower_ascii(text)) if x]
    runs = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(pairs):
    """Smallest id reachable, from (id, fingerprint)."""
    ids = [i for i, _ in pairs]
    a = np.array([f & (2**64 - 1) for _, f in pairs], np.uint64)
    label = list(range(len(a)))

    def find(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for i in range(len(a)):
        for j in (i + 1 + np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1 :]) <= LIMIT)).tolist():
            label[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(a))]


def test_fingerprints(spark):
    for row in awkward(spark).filter("doc_id IS NULL OR doc_id <> 11").collect():
        assert fingerprint((row.text or "").encode(), 3) & (2**64 - 1) == brute_print(row.text)


def test_pieces_do_not_matter(monkeypatch):
    from quernstone.llm import text

    long = " ".join(f"w{k % 97}" for k in range(5000)).encode()
    whole = fingerprint(long, 3)
    cut = text.word_pieces
    monkeypatch.setattr(simhash, "word_pieces", lambda t: cut(t, 100))
    assert fingerprint(long, 3) == whole


def test_components_of_documents(spark):
    docs = clashing(awkward(spark), "fp", "component_id")
    got = simhash_components(docs).collect()
    rows = [(r.doc_id, int(r.fingerprint, 16)) for r in got]
    assert len(got) == docs.count()
    assert [r.component_id for r in got] == brute_components(rows)
    assert simhash_components(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_all_links_are_found(spark, seed):
    """Dense groups, chains and single links at every distance, over all segments."""
    r = random.Random(seed)
    prints = set()
    for _ in range(60):
        f = r.getrandbits(64)
        prints.add(f)
        for _ in range(r.choice([1, 2, 40])):
            f ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 4)))
            prints.add(f)
    centre = r.getrandbits(64)
    prints |= {centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for _ in range(400)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in prints)
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
    got = {x.fp: x.label for x in fingerprint_components(nodes).collect()}
    true = brute_components([(f, f) for f in signed])
    groups = {}
    for f, t in zip(signed, true, strict=True):
        groups.setdefault(t, set()).add(got[f])
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)
