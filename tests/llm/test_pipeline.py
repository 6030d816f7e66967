import corpus_pipeline
from quernstone.llm.decontaminate import mark_contaminated
from quernstone.llm.sentencepiece_viterbi import MODEL, Pieces, read_pieces

from .frames import awkward, clashing, empty, words


def tables(spark, folder, docs, labels=(), items=()):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_empty_tables(spark, tmp_path):
    tables(spark, tmp_path, empty(spark))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == [*empty(spark).columns, "piece_ids"]


def test_awkward_rows_and_clashing_names(spark, tmp_path):
    docs = clashing(awkward(spark, [(30, "repeated row", None, None, None)]), "__row", "__drops", "__hits", "fp", "node", "key", "score", "toxic_predicted")
    tables(spark, tmp_path, docs, [(8, 1, 0), (9, None, None), (None, 1, 1)], [(1, None), (2, "")])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "piece_ids"]
    got = sorted(((r.doc_id is None, r.doc_id or 0) for r in out.collect()))
    # 2 and 3 are copies of 1, 5 and 7 are empty like 4, 30 says what 9 says, of which one row stays.
    assert [k for null, k in got if not null] == [1, 4, 8, 9, 10, 10, 11, 12] and sum(null for null, _ in got) == 2
    assert {r["__row"] for r in out.collect()} == {"mine"}


def test_stages_take_effect(spark, tmp_path):
    passage = " ".join(f"bench{k}" for k in range(12))
    rows = [(k, " ".join(words(50, k)) + (" you idiot trash idiot" if k % 6 == 0 else "") + "\nshared footer line", "en", "s", 1) for k in range(120)]
    rows += [(200, rows[1][1], "en", "s", 1), (201, rows[7][1].replace("\n", " extra\n"), "en", "s", 1), (202, "start " + passage + " end", "en", "s", 1), (203, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 6 == 0)) for k in range(110)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in out}
    assert ids == {k for k in range(120) if k % 6} | {203}
    assert all("shared footer" not in (r.text or "") for r in out)
    assert all(r.n_chars == len(r.text) for r in out if r.text is not None)
    found = Pieces(read_pieces(MODEL))
    assert all(found.decode(r.piece_ids) == (r.text or "") for r in out)


def test_stages_are_declared():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    assert callable(mark_contaminated)
