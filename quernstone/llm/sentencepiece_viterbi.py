"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives Viterbi.

The automaton reads a text once. At each position its output links give every piece that ends there, the
longest first, and each relaxes the best score of the position from that of the piece's start. The
pieces are those of a public model file, whose path is a parameter; nothing is trained.

Viterbi adds up log probabilities. The scores of a BPE file are merge ranks, whose sums mean nothing, so by
default the piece of rank r gets the share that Zipf's law gives to the r-th most frequent of n things,
``1 / ((r + 1) H_n)``. ``scores="file"`` takes a file's own scores, as is right for a unigram model.

Three kinds of place must be boundaries, and cut a text into parts that are solved alone: the start of a
run of spaces, where no piece goes on from a letter to a space, and both sides of a line feed and of the
one-eighth-block mark, which no piece holds or may stand for. The different parts of a slice of texts are
solved once and remembered. A character without a piece costs the lowest score less ten and becomes its
UTF-8 bytes. So the encoding is the best one for the whole text, and decoding gives the text back.

Cases: a null text encodes as an empty one, to no pieces; equal scores take the longer last piece; bytes
that aren't UTF-8 become byte pieces and come back; a part without spaces of any length takes twelve bytes a
character; repeated rows are encoded each; input columns named like an added one are replaced; an empty
table gives an empty table; ids that are no piece's decode to nothing.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from itertools import accumulate, chain
from math import log
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quernstone.llm.arrow import mapped, texts
from quernstone.llm.text import spans, unpacked

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
MARK = SPACE.encode()
UNKNOWN_PENALTY = 10.0
NEVER = float("-inf")
#: Parts that are remembered twice over, and their length at most.
REMEMBERED, SHORT = 250_000, 64
#: Bytes of texts that are worked on at once, but for a longer part without a boundary.
CHUNK = 1 << 22
#: Values of a piece's type in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = varint()
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            yield number, varint()
        elif wire == 2:
            size = varint()
            yield number, data[at : at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[wire]
            yield number, data[at : at + size]
            at += size


def read_pieces(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) by id."""
    found = []
    for number, value in fields(Path(path).read_bytes()):
        if number == 1:
            row = dict(fields(value))
            found.append((row.get(1, b"").decode(), struct.unpack("<f", row[2])[0] if 2 in row else 0.0, row.get(3, NORMAL)))
    return found


def zipf(pieces: list[tuple[str, float, int]]) -> list[tuple[str, float, int]]:
    """The pieces with log probabilities in place of merge ranks (0, -1, -2 and so on)."""
    total = list(accumulate(1 / (r + 1) for r in range(max(1, len(pieces)))))[-1]
    return [(p, -log(max(-s, 0.0) + 1) - log(total), kind) for p, s, kind in pieces]


class Remembered:
    """Solutions of parts met before, in two generations: when the new one is full, it becomes the old one."""

    def __init__(self, solve):
        self.solve = solve
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def __call__(self, part: bytes) -> bytes:
        found = self.new.get(part)
        if found is None:
            found = self.old.get(part)
            found = self.solve(part) if found is None else found
            if len(part) <= SHORT:
                self.new[part] = found
                if len(self.new) >= REMEMBERED:
                    self.old, self.new = self.new, {}
        return found


class Pieces:
    """A vocabulary, its automaton, and the two directions."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.automaton = ahocorasick.Automaton()
        usable = {i: (p, s) for i, (p, s, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED) and p}
        for i, (p, s) in usable.items():
            self.automaton.add_word(p, (len(p), s, i))
        self.automaton.make_automaton()
        self.sizes = [len(p) for p, _, _ in pieces]
        self.singles = {p for p, _ in usable.values() if len(p) == 1}
        self.unknown = min((s for _, s in usable.values()), default=0.0) - UNKNOWN_PENALTY
        self.unknown_id = next((i for i, x in enumerate(pieces) if x[2] == UNKNOWN), 0)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        spelled = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() if kind in (NORMAL, USER_DEFINED) else b"" for p, _, kind in pieces]
        # One more, empty, for ids that are no piece's.
        self.spelled = pa.array([*spelled, b""], pa.large_binary())
        held = {c for p, _ in usable.values() for c in p}
        #: Whether texts may be cut into parts as the module says; else a text is one part.
        self.cuts = all(SPACE not in p.lstrip(SPACE) for p, _ in usable.values()) and "\n" not in held
        self.remembered = Remembered(self.solve)

    def fallback(self, char: str) -> list[int]:
        if not self.byte_ids:
            return [self.unknown_id]
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogateescape")]

    def solve(self, part: bytes) -> bytes:
        """The piece ids of a part of a text, as 32-bit numbers."""
        text = part.decode("utf-8", "surrogateescape")
        if MARK not in part:
            return array("i", self.best(text.replace(" ", SPACE))).tobytes()
        ids: list[int] = []
        for k, piece in enumerate(text.split(SPACE)):
            if k:
                ids.extend(self.fallback(SPACE))
            ids.extend(self.best(piece.replace(" ", SPACE)))
        return array("i", ids).tobytes()

    def best(self, part: str) -> list[int]:
        """The piece ids of the best segmentation of a part; spaces are already marks.

        ``score[k]`` is the best score of the part up to and with character k; the start's is behind the last
        one, where Python finds index -1. A long part is kept in arrays, twelve bytes a character.
        """
        n = len(part)
        if n < 4096:
            score, back = [NEVER] * n + [0.0], [-1] * n
        else:
            score, back = array("d", [NEVER]) * n + array("d", [0.0]), array("i", [-1]) * n
        if self.singles.issuperset(part):
            for last, (size, gain, piece) in self.automaton.iter(part):
                total = score[last - size] + gain
                if total > score[last]:
                    score[last] = total
                    back[last] = piece
        else:
            done = 0
            for last, (size, gain, piece) in chain(self.automaton.iter(part), [(n, (0, 0.0, -1))]):
                while done < last:  # positions before this one are final but for a missing single
                    self._relax_unknown(part, done, score, back)
                    done += 1
                if piece < 0:
                    break
                total = score[last - size] + gain
                if total > score[last]:
                    score[last] = total
                    back[last] = piece
        out: list[int] = []
        at, sizes = n - 1, self.sizes
        while at >= 0:
            piece = back[at]
            if piece >= 0:
                out.append(piece)
                at -= sizes[piece]
            else:
                out.extend(reversed(self.fallback(part[at])))
                at -= 1
        out.reverse()
        return out

    def _relax_unknown(self, part: str, place: int, score, back) -> None:
        if part[place] not in self.singles and score[place - 1] + self.unknown > score[place]:
            score[place] = score[place - 1] + self.unknown
            back[place] = -1

    def _boundaries(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where parts begin."""
        cut = np.zeros(len(raw) + 1, bool)
        cut[starts] = True
        if self.cuts:
            space, line = raw == 0x20, raw == 0x0A
            cut[1:-1] |= space[1:] & ~space[:-1]
            cut[:-1] |= line
            cut[1:] |= line
            mark = np.flatnonzero((raw[:-2] == MARK[0]) & (raw[1:-1] == MARK[1]) & (raw[2:] == MARK[2])) if len(raw) > 2 else np.zeros(0, int)
            cut[mark] = cut[mark + 3] = True
        return np.flatnonzero(cut[:-1])

    def _cut_long(self, text: bytes):
        """A text in chunks, each of which begins with a run of spaces."""
        start = 0
        while start < len(text):
            end = start + CHUNK
            while self.cuts and end < len(text) and (text[end] != 0x20 or text[end - 1] == 0x20):
                found = text.find(b" ", end + 1)
                end = len(text) if found < 0 else found
            end = end if self.cuts else len(text)
            yield text[start:end]
            start = end

    def _encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of chunks that already have the space ahead of a text."""
        raw = np.frombuffer(b"".join(chunks), np.uint8)
        starts = np.cumsum([0, *map(len, chunks)])
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(chunks), np.int64)
        at = self._boundaries(raw, starts[:-1][np.diff(starts) > 0])
        coded = spans(raw, np.append(at, len(raw))).dictionary_encode()
        parts = coded.dictionary.to_pylist() if not self.cuts else _split(coded.dictionary)
        solved = list(map(self.remembered, parts))
        each = spans(np.frombuffer(b"".join(solved), np.uint8), np.cumsum([0, *map(len, solved)])).take(coded.indices)
        ends = np.frombuffer(each.buffers()[1], np.int64)[: len(each) + 1] // 4
        ids = np.frombuffer(each.buffers()[2], "<i4", ends[-1]) if ends[-1] else np.zeros(0, np.int32)
        return ids, np.diff(ends[np.searchsorted(at, starts)])

    def encode_many(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the piece ids of all texts, and where each text's begin."""
        found: list[np.ndarray] = []
        counts = np.zeros(len(raws), np.int64)
        held: list[tuple[int, bytes]] = []

        def close() -> None:
            ids, n = self._encode_chunks([c for _, c in held])
            found.append(ids)
            np.add.at(counts, [k for k, _ in held], n)
            held.clear()

        total = 0
        for number, raw in enumerate(raws):
            for chunk in self._cut_long(b" " + raw) if raw else ():
                if held and total + len(chunk) > CHUNK:
                    close()
                    total = 0
                held.append((number, chunk))
                total += len(chunk)
        if held:
            close()
        return np.concatenate(found) if found else np.zeros(0, np.int32), np.concatenate([[0], np.cumsum(counts)])

    def decode_many(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, begins, ends) of the texts that ids stand for."""
        nothing = len(self.spelled) - 1
        fair = np.where((ids >= 0) & (ids < nothing), ids, nothing)
        each = self.spelled.take(pa.array(fair, pa.int32()))
        at = np.frombuffer(each.buffers()[1], np.int64)[: len(each) + 1]
        data = np.frombuffer(each.buffers()[2], np.uint8) if each.buffers()[2] is not None else np.zeros(0, np.uint8)
        begins, ends = at[offsets[:-1]], at[offsets[1:]]
        some = begins < ends
        begins = begins.copy()
        begins[some] += data[begins[some]] == 0x20  # the space that was put ahead of the text
        return data, begins, ends

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text.encode("utf-8", "surrogatepass")])[0].tolist()

    def decode(self, ids) -> str:
        data, (begin,), (end,) = self.decode_many(np.array(ids, np.int32), np.array([0, len(ids)]))
        return data[begin:end].tobytes().decode("utf-8", "replace")


def _split(parts: pa.LargeBinaryArray) -> list[bytes]:
    """The different parts as bytes; the only one with a line feed is the line feed."""
    found = unpacked(parts)
    if len(found) != len(parts):  # the line feed was split into two empty ones
        at = found.index(b"")
        found[at : at + 2] = [b"\n"]
    return found


_loaded: dict[tuple[str, str], Pieces] = {}


def load(name: str, scores: str, pieces: list[tuple[str, float, int]]) -> Pieces:
    """One automaton for each Python worker."""
    if (name, scores) not in _loaded:
        _loaded[name, scores] = Pieces(zipf(pieces) if scores == "zipf" else pieces)
    return _loaded[name, scores]


def encode_texts(docs: DataFrame, model: str = MODEL, column: str = "text", out: str = "piece_ids", scores: str = "zipf") -> DataFrame:
    """Add the piece ids of a text column. The model is read on the driver and travels with the tasks."""
    pieces = read_pieces(model)

    def run(part: pa.RecordBatch) -> dict[str, list]:
        ids, offsets = load(model, scores, pieces).encode_many(texts(part, column))
        return {out: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))}

    return mapped(docs, run, [T.StructField(out, T.ArrayType(T.IntegerType()))])


def decode_ids(docs: DataFrame, model: str = MODEL, column: str = "piece_ids", out: str = "decoded", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add the text of a column of piece ids; null ids give an empty text."""
    pieces = read_pieces(model)

    def run(part: pa.RecordBatch) -> dict[str, list]:
        rows = part.column(part.schema.get_field_index(column))
        ids = rows.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum([len(x) if x.is_valid else 0 for x in rows])])
        data, begins, ends = load(model, "zipf", pieces).decode_many(ids, offsets)
        held = [data[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        return {out: pa.array(held, pa.binary()).view(pa.string())}

    return mapped(docs, run, [T.StructField(out, T.StringType())], drop)


def digest_round_trip(docs: DataFrame, model: str = MODEL, scores: str = "zipf") -> DataFrame:
    """Encode and decode every text: n_pieces, ids_sha256 (of little-endian 32-bit ids), decoded_sha256 and exact."""
    pieces = read_pieces(model)
    added = [T.StructField("n_pieces", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()), T.StructField("exact", T.BooleanType())]

    def run(part: pa.RecordBatch) -> dict[str, list]:
        found, raws = load(model, scores, pieces), texts(part, "text")
        ids, offsets = found.encode_many(raws)
        data, begins, ends = found.decode_many(ids, offsets)
        at, begins, ends = offsets.tolist(), begins.tolist(), ends.tolist()
        decoded = [data[a:b] for a, b in zip(begins, ends, strict=True)]
        return {
            "n_pieces": np.diff(offsets).tolist(),
            "ids_sha256": [hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(at, at[1:], strict=False)],
            "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in decoded],
            "exact": [x.tobytes() == raw for x, raw in zip(decoded, raws, strict=True)],
        }

    return mapped(docs, run, added, ("text",))
