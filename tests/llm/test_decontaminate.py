import hashlib
import random
import re

from quernstone.llm.decontaminate import Windows, mark_contaminated, word_ids

from .frames import awkward, clashing, empty, lower_ascii

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text, items, window):
    w = WORD.findall(lower_ascii(text))
    hit, listed = set(), set()
    for item, t in items:
        v = WORD.findall(lower_ascii(t))
        for i in range(max(1, len(v) - window + 1) if v else 0):
            run = v[i : i + window]
            for j in range(len(w) - len(run) + 1):
                if w[j : j + len(run)] == run:
                    hit.update(range(j, j + len(run)))
                    if item is not None:
                        listed.add(str(item))
    return len(w), len(hit), len(listed), hashlib.sha256(",".join(sorted(listed)).encode()).hexdigest(), bool(hit)


def cases(spark):
    r = random.Random(4)
    vocabulary = [f"w{k}" for k in range(12)]
    texts = [" ".join(r.choice(vocabulary) + r.choice(["", ",", "-", "É"]) for _ in range(r.randint(0, 80))) for _ in range(60)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 14)))) for k in range(25)]
    items += [(100, texts[3]), (100, texts[4][:40]), (None, texts[5]), (7, None), (8, ""), (9, "..."), (10, "ONE"), (11, "beta3")]
    extra = [(200 + k, t.upper() if k % 2 else t, "en", "s", 1) for k, t in enumerate(texts)]
    return awkward(spark, extra), items


def columns(r):
    return (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)


def test_equals_brute_force(spark):
    docs, items = cases(spark)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = docs.filter("doc_id IS NULL OR doc_id <> 11")
    for window in (3, 10):
        got = mark_contaminated(clashing(docs, "n_hit", "__hits"), benchmark, window).collect()
        assert [columns(r) for r in got] == [brute(r.text, items, window) for r in docs.collect()]


def test_blocks_add_up(spark):
    docs, items = cases(spark)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    one = mark_contaminated(docs, benchmark, 4).collect()
    many = mark_contaminated(docs, benchmark, 4, block_words=40).collect()
    assert [columns(r) for r in one] == [columns(r) for r in many]


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert mark_contaminated(empty(spark), benchmark).count() == 0
    assert mark_contaminated(awkward(spark), benchmark.limit(0)).filter("contaminated").count() == 0


def test_long_texts_in_pieces(monkeypatch):
    from quernstone.llm import decontaminate

    block = Windows([(1, [b"a", b"b"])], 2)
    text = b"a b c " * 500
    whole = word_ids(text, block.ids)
    monkeypatch.setattr(decontaminate, "PIECE", 64)
    monkeypatch.setattr(decontaminate.pieces, "__defaults__", (64,))
    assert (word_ids(text, block.ids) == whole).all()


def test_repeated_items_and_clashing_names(spark):
    docs, items = cases(spark)
    once, twice = (spark.createDataFrame(items * n, "item_id long, text string") for n in (1, 3))
    a = mark_contaminated(clashing(docs, "__hits", "__items", "__words"), once, 4)
    b = mark_contaminated(docs, twice, 4)
    assert [columns(r) for r in a.collect()] == [columns(r) for r in b.collect()]
    assert {(r["__hits"], r["__items"], r["__words"]) for r in a.collect()} == {("mine",) * 3}


def test_empty_tables_and_bytes_that_are_not_text(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert mark_contaminated(empty(spark), none).count() == 0
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'FF2061' AS STRING) AS text")
    assert [columns(r)[:3] for r in mark_contaminated(docs, none).collect()] == [(2, 0, 0)]
    items = spark.createDataFrame([(5, "a")], "item_id long, text string")
    assert [columns(r)[:3] for r in mark_contaminated(docs, items).collect()] == [(2, 1, 1)]
