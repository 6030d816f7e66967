"""Elias-Fano sequences and the levels of an n-gram trie, which are built from them.

A monotone sequence of n numbers below u keeps the low ``log2(u / n)`` bits of each number packed and
the high parts in unary, about ``2 + log2(u / n)`` bits a number. ``next_geq`` goes straight to the few
numbers that share the target's high part. All queries are vectorised; the levels are memory-mapped.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

ONE = np.uint64(1)
#: Numbers that are packed or looked up at once, whole words of them; arrays of a step are only as long.
SLICE = 1 << 16


#: Where the k-th one of a byte is.
_IN_BYTE = np.zeros((256, 8), np.int64)
for _byte in range(256):
    for _k, _at in enumerate(k for k in range(8) if _byte >> k & 1):
        _IN_BYTE[_byte, _k] = _at
_TWOS, _FOURS, _EIGHTS, _ALL = (np.uint64(x) for x in (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F, 0x0101010101010101))


def _in_word(bits: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Where the k-th one of each word is."""
    ones = bits - (bits >> ONE & _TWOS)
    ones = (ones & _FOURS) + (ones >> np.uint64(2) & _FOURS)
    upto = (((ones + (ones >> np.uint64(4))) & _EIGHTS) * _ALL).view(np.uint8).reshape(-1, 8)  # ones up to each byte
    byte = (upto <= k.astype(np.uint8)[:, None]).sum(1)
    row = np.arange(len(k)) * 8 + byte
    before = np.where(byte > 0, upto.ravel()[np.maximum(row - 1, 0)], 0)
    return byte * 8 + _IN_BYTE[bits.view(np.uint8)[row], k - before]


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
    """The position of the k-th one (or zero) in a bit vector; ``before`` counts them ahead of each word."""
    if not len(k):
        return np.zeros(0, np.int64)
    word = np.searchsorted(before, k, "right") - 1
    bits = np.ascontiguousarray(words)[word]
    return word * 64 + _in_word(~bits if flip else bits, (k - before[word]).astype(np.int64))


class EliasFano:
    """A monotone sequence. ``store`` places an array in the memory-mapped file and returns the view."""

    def __init__(self, values: np.ndarray, store=lambda x: x):
        n = self.n = len(values)
        top = int(values[-1]) + 1 if n else 1
        self.low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        self.top = top >> self.low_bits
        length = n + self.top + 2
        bits = np.zeros((length + 63) // 64 * 64, bool)
        packed = np.zeros(n * self.low_bits // 64 + 2, np.uint64)
        for first in range(0, n, SLICE):
            part = values[first : first + SLICE].astype(np.uint64)
            index = np.arange(first, first + len(part))
            bits[(part >> np.uint64(self.low_bits)).astype(np.int64) + index] = True
            if self.low_bits:
                low = part & np.uint64((1 << self.low_bits) - 1)
                at = index * self.low_bits
                word, shift = at >> 6, (at & 63).astype(np.uint64)
                # Places rise, so the numbers that share a word are a run; at most one of them goes on in the next word.
                heads = np.flatnonzero(np.diff(word, prepend=-1))
                packed[word[heads]] = np.bitwise_or.reduceat(low << shift, heads)
                spill = shift + np.uint64(self.low_bits) > 64
                packed[word[spill] + 1] |= low[spill] >> (np.uint64(64) - shift[spill])
        words = np.packbits(bits, bitorder="little").view("<u8")
        del bits
        counts = np.bitwise_count(words).astype(np.int64)
        ones = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        self.words, self.ones, self.zeros = store(words), store(ones), store(np.arange(len(words), dtype=np.int64) * 64 - ones)
        self.low = store(packed)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.int64) * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        rest = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | rest) & np.uint64((1 << self.low_bits) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        high = (_select(self.words, self.ones, i, False) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(i)

    def _sharing(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the numbers with these high parts begin and end."""
        zero = _select(self.words, self.zeros, high, True)
        end = zero - high
        # The ones right ahead of the zero are the numbers. Mostly they are few and counted; else the zero before tells.
        size = np.zeros(len(high), np.int64)
        words, left = np.ascontiguousarray(self.words), np.flatnonzero(zero > 0)
        for _ in range(4):
            at = zero[left] - size[left] - 1
            left = left[at >= 0]
            at = at[at >= 0]
            left = left[(words[at >> 6] >> (at & 63).astype(np.uint64) & ONE).astype(bool)]
            size[left] += 1
        many = left[high[left] > 0]
        size[many] = zero[many] - _select(self.words, self.zeros, high[many] - 1, True) - 1
        first = left[high[left] == 0]
        size[first] = zero[first]
        return end - size, end

    def _first_low(self, low: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first place from ``begin`` on whose low part is at least ``low``; ``end`` where there is none."""
        begin, end = begin.copy(), end.copy()
        open_ = np.flatnonzero(begin < end)
        while len(open_):  # halve what is left until it is one place
            middle = (begin[open_] + end[open_]) >> 1
            less = self._low(middle) < low[open_]
            begin[open_] = np.where(less, middle + 1, begin[open_])
            end[open_] = np.where(less, end[open_], middle)
            open_ = open_[begin[open_] < end[open_]]
        return begin

    def next_geq(self, target: np.ndarray) -> np.ndarray:
        """The first place whose value is at least the target; n where there is none."""
        target = np.asarray(target, np.uint64)
        high = (target >> np.uint64(self.low_bits)).astype(np.int64)
        beyond = high > self.top
        begin, end = self._sharing(np.minimum(high, self.top))
        return np.where(beyond, self.n, self._first_low(target & np.uint64((1 << self.low_bits) - 1), begin, end))

    def find(self, target: np.ndarray) -> np.ndarray:
        """The first place of the target, -1 where there is none."""
        found = np.full(len(target), -1, np.int64)
        for first in range(0, len(target), SLICE):
            part = np.asarray(target[first : first + SLICE], np.uint64)
            high = (part >> np.uint64(self.low_bits)).astype(np.int64)
            low = part & np.uint64((1 << self.low_bits) - 1)
            begin, end = self._sharing(np.minimum(high, self.top))
            place = self._first_low(low, begin, end)
            fits = np.flatnonzero((place < end) & (high <= self.top))
            same = fits[self._low(place[fits]) == low[fits]]
            found[first + same] = place[same]
        return found


#: A step of quantisation in log10; the codes reach down to 10 ** -19.5.
STEP, CODES = 3e-4, 65_000


def quantised(p: np.ndarray) -> np.ndarray:
    """The 16-bit codes of probabilities; 0 is left for an n-gram that is not in a trie."""
    with np.errstate(divide="ignore"):
        return np.clip(np.rint(-np.log10(p) / STEP), 0, CODES).astype(np.uint16) + np.uint16(1)


def log10_of(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.float64) - 1) * -STEP


#: The probability of each code.
_SHARES = 10.0 ** ((np.arange(CODES + 2) - 1.0) * -STEP)


def share_of(codes: np.ndarray) -> np.ndarray:
    return _SHARES[codes]


class WordLevel:
    """The first order of the trie: the words' hashes as one monotone sequence, with exact counts."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        """Different hashes in rising order."""
        self.hashes, self.counts = EliasFano(hashes), counts

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Counts; 0 for a word that isn't there."""
        found = np.zeros(len(hashes), np.int64)
        if len(self.counts):
            place = self.hashes.find(hashes)
            some = place >= 0
            found[some] = self.counts[place[some]]
        return found


class NgramTrie:
    """One order of n-grams: contexts with monotone pointers, and their successors with quantised probabilities.

    Successors are numbered among all successors of the trie; within a context the numbers rise, and
    each context's numbers are raised by the last value of the one before, so that the level is one
    monotone sequence. A lookup adds the context's base to the number and searches its successor.

    Levels are written to a file and mapped, so what they were built from can be let go.
    """

    def __init__(self, heads: np.ndarray, words: np.ndarray, word: np.ndarray, codes: np.ndarray):
        """``word`` (as places in the sorted ``words``) and ``codes`` of the successors, context by context and in rising
        order within each; ``heads`` is where each context's successors begin, the number of successors last."""
        self._file = tempfile.TemporaryFile()
        sizes = np.diff(heads)
        held = np.zeros(len(words), bool)
        held[word] = True
        self.words = self._store(words[held])
        number = (np.cumsum(held) - 1)[word].astype(np.uint64)
        # Each context's numbers start above the last value of the context before it.
        lasts = number[heads[1:] - 1] + ONE
        base = np.concatenate([[0], np.cumsum(lasts)[:-1]]).astype(np.uint64) if len(lasts) else lasts
        self.base = EliasFano(base, self._store)
        self.pointers = EliasFano(heads.astype(np.uint64), self._store)
        self.level = EliasFano(number + np.repeat(base, sizes), self._store)
        self.codes = self._store(codes)

    def _store(self, x: np.ndarray) -> np.ndarray:
        x = np.ascontiguousarray(x)
        if not x.size:
            return x
        start = os.lseek(self._file.fileno(), 0, os.SEEK_END)
        start += -start % 8
        os.pwrite(self._file.fileno(), x, start)
        return np.memmap(self._file, x.dtype, "r", start, x.shape)

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The successors' numbers of words, -1 for a word that follows no context."""
        if not len(self.words):
            return np.full(len(words), -1, np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def places(self, context: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The places of (context number, successor number) pairs in the level, -1 where it has none; contexts rise."""
        found = np.full(len(context), -1, np.int64)
        can = np.flatnonzero((context >= 0) & (number >= 0))
        if not len(can):
            return found
        own = context[can]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        times = np.diff(np.append(first, len(own)))
        target = number[can].astype(np.uint64) + np.repeat(self.base[own[first]], times)
        end = np.repeat(self.pointers[own[first] + 1].astype(np.int64), times)
        place = self.level.find(target)
        found[can] = np.where(place < end, place, -1)
        return found

    def codes_at(self, place: np.ndarray) -> np.ndarray:
        """The codes at places of the level; 0 for a place of -1."""
        return np.where(place >= 0, self.codes[np.maximum(place, 0)] if len(self.codes) else np.uint16(0), np.uint16(0)).astype(np.uint16)
