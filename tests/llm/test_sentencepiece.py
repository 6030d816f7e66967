import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quernstone.llm import sentencepiece_viterbi
from quernstone.llm.sentencepiece_viterbi import MODEL, BYTE, NORMAL, UNKNOWN, Pieces, decode_ids, digest_round_trip, encode_texts, read_pieces, zipf

from .frames import awkward, clashing, empty

needs_model = pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary file")
SMALL = [("<unk>", 0.0, UNKNOWN), *((f"<0x{b:02X}>", 0.0, BYTE) for b in range(256)), *((p, s, NORMAL) for p, s in [("▁", -3.0), ("a", -2.5), ("b", -2.5), ("ab", -3.0), ("▁a", -2.0), ("▁ab", -6.0), ("ba", -2.2), ("bab", -4.0), ("▁▁", -1.0), ("aa", -5.0)])]


def brute_best(pieces, part):
    """The best sum of scores over all segmentations."""
    usable = {p: s for p, s, kind in pieces if kind == NORMAL}
    unknown = min(usable.values()) - 10
    best = [0.0] + [float("-inf")] * len(part)
    for end in range(1, len(part) + 1):
        for start in range(end):
            p = part[start:end]
            if p in usable:
                best[end] = max(best[end], best[start] + usable[p])
        if part[end - 1] not in usable:
            best[end] = max(best[end], best[end - 1] + unknown)
    return best[-1]


def cost(pieces, ids):
    """The sum of the scores of ids, a run of bytes being one unknown character."""
    usable = min(s for _, s, kind in pieces if kind == NORMAL) - 10
    total, run = 0.0, b""
    for i in ids:
        p, s, kind = pieces[i]
        if kind == BYTE:
            run += bytes([int(p[3:5], 16)])
            try:
                run.decode()
            except UnicodeDecodeError:
                continue
            total, run = total + usable, b""
        else:
            total += s
    return total


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab cé\n▁", max_size=24))
def test_best_segmentation_and_round_trip(text):
    found = Pieces(SMALL)
    ids = found.encode(text)
    assert found.decode(ids) == text
    if text and "▁" not in text:
        assert abs(cost(SMALL, ids) - brute_best(SMALL, "▁" + text.replace(" ", "▁"))) < 1e-9


@needs_model
@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_round_trip_of_the_public_model(text):
    found = Pieces(read_pieces(MODEL))
    assert found.decode(found.encode(text)) == text


@needs_model
def test_columns(spark):
    docs = clashing(awkward(spark), "piece_ids")
    rows = decode_ids(encode_texts(docs)).collect()
    assert [r.decoded for r in rows] == [r.text or "" for r in docs.collect()]
    assert all(r.exact for r in digest_round_trip(docs.select("doc_id", "text")).collect())
    assert encode_texts(empty(spark)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab cé\n▁", max_size=40), max_size=6), st.integers(1, 30))
def test_many_texts_and_chunks_give_what_one_text_gives(raws, chunk):
    found, small = Pieces(SMALL), Pieces(SMALL)
    whole = [found.solve((" " + x).encode()) if x else b"" for x in raws]
    before = sentencepiece_viterbi.CHUNK
    sentencepiece_viterbi.CHUNK = chunk
    try:
        ids, offsets = small.encode_many([x.encode() for x in raws])
    finally:
        sentencepiece_viterbi.CHUNK = before
    got = [ids[a:b].astype("<i4").tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
    # Lines are parts, so a line feed is never inside one; the whole text is solved with it here.
    assert [len(x) for x in got] == [len(x) for x in whole] and got == whole


def test_remembered_parts_age_in_two_halves():
    found = Pieces(SMALL)
    before = sentencepiece_viterbi.REMEMBERED
    sentencepiece_viterbi.REMEMBERED = 3
    try:
        texts = ["ab", "ba", "aab", "bab", "abab", "ab", "b", "aa", "ab"] * 3
        assert [found.decode(found.encode(t)) for t in texts] == texts and len(found.remembered.new) <= 3
    finally:
        sentencepiece_viterbi.REMEMBERED = before


@needs_model
def test_long_unbroken_text_and_bytes_that_are_not_text(spark):
    found = Pieces(zipf(read_pieces(MODEL)))
    raws = ["x" * 200_000, "é" * 9_000 + "\U0001f600" * 5_000]
    assert [found.decode(found.encode(t)) for t in raws] == raws
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'FF6120E296810AED' AS STRING) AS text")
    assert digest_round_trip(docs).first().exact
    assert decode_ids(encode_texts(docs)).selectExpr("hex(CAST(decoded AS BINARY)) AS h").first().h == "FF6120E296810AED"


@needs_model
def test_zipf_shares_need_fewer_pieces_than_merge_ranks():
    import sentencepiece

    text = "The quick brown fox jumps over the lazy dog, and nobody minds it at all. " * 3
    pieces = read_pieces(MODEL)
    library = len(sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(text))
    assert library * 0.95 <= len(Pieces(zipf(pieces)).encode(text)) <= library * 1.1 < len(Pieces(pieces).encode(text))
