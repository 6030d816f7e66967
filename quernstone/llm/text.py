"""Words of texts: a bounded part of one text at a time, or all words of a slice of texts at once."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE = 1 << 20
_GAP = re.compile(rb"[ \t-\r]")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def word_pieces(text: bytes, size: int = PIECE):
    """Lists of words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a word is never cut."""
    for part in cut(text, size):
        yield part.lower().split()


def cut(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, cut in front of white space."""
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > size and (gap := _GAP.search(text, start + size)):
            end = gap.start()
        yield text[start:end]
        start = end


def grouped(texts: list[bytes], size: int = 1 << 22) -> Iterator[list[tuple[int, bytes]]]:
    """The texts, numbered, in groups of about ``size`` bytes; longer ones are cut in front of white space."""
    held: list[tuple[int, bytes]] = []
    total = 0
    for number, text in enumerate(texts):
        for part in cut(text, size):
            if held and total + len(part) > size:
                yield held
                held, total = [], 0
            held.append((number, part))
            total += len(part)
    if held:
        yield held


class Alphabet:
    """The bytes that words are made of; a line feed is never one of them."""

    def __init__(self, inside):
        held = set(inside)
        self.table = bytes(b in held for b in range(256))


#: Everything but ASCII white space.
VISIBLE = Alphabet(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)
#: ASCII letters and everything beyond ASCII.
LETTERS = Alphabet([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 256)])


def spans(data: np.ndarray, offsets: np.ndarray) -> pa.LargeBinaryArray:
    """The slices between the offsets, without a copy."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def unpacked(found: pa.LargeBinaryArray) -> list[bytes]:
    """The values, none of which has a line feed, as Python bytes."""
    if not len(found):
        return []
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found), pa.scalar(b"\n", pa.large_binary()))
    return joined[0].as_py().split(b"\n")


def coded_words(texts: list[bytes], alphabet: Alphabet = VISIBLE) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(codes, counts, words): every word of the texts as a number into ``words``, and each text's number of words.

    A-Z are lower-cased. No Python object is made for a word but once for each different one.
    """
    joined = b"\n".join([*texts, b""]).lower()
    mask = np.frombuffer(joined.translate(alphabet.table), bool)
    edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if len(mask) and mask[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64), []
    coded = spans(np.frombuffer(joined, np.uint8)[mask], np.concatenate([[0], np.cumsum(ends - starts)])).dictionary_encode()
    limits = np.cumsum([len(t) + 1 for t in texts])
    return coded.indices.to_numpy(), np.diff(np.searchsorted(starts, limits), prepend=0), unpacked(coded.dictionary)


def word_hashes(texts: list[bytes], alphabet: Alphabet = VISIBLE) -> list[np.ndarray]:
    """The 64-bit hash of each word, for each text."""
    held: list[list[np.ndarray]] = [[] for _ in texts]
    for group in grouped(texts):
        codes, counts, words = coded_words([part for _, part in group], alphabet)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[codes] if words else np.zeros(0, np.uint64)
        for (number, _), found in zip(group, np.split(hashes, np.cumsum(counts)[:-1]), strict=True):
            held[number].append(found)
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in held]


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in their order."""
    x = (a ^ (b * _MIX[0] + _MIX[1])) * _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words; of all words, where there are fewer."""
    size = min(size, len(words))
    if not size:
        return words
    n = len(words) - size + 1
    key = words[:n]
    for k in range(1, size):
        key = mixed(key, words[k : k + n])
    return mixed(key, np.full(n, size, np.uint64))
