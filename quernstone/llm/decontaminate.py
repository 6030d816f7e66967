"""Benchmark decontamination by a prefix-filtered set join, verified word by word.

Every item is cut into windows of ``window`` consecutive words (a shorter item is one window). A window's
set elements are its shingles of up to five words. Shingles are ordered by how often the corpus has
them, and since a window only counts when it is contained whole, its necessary prefix is one shingle:
the rarest. The corpus is scanned for prefix shingles; a meeting gives a candidate window at a known
offset, which must lie inside the document (position and length bounds) and is then compared word by
word. Only the benchmark is held in memory, in blocks of at most ``block_words`` words whatever its
size, and documents are never shuffled.

Cases: a null or empty text has no words; a very long text is read in parts; an item without words has no windows;
items of one id count once, as do repeated items; items with a null id mark words but are not listed; shingles that
are equally rare go by their place; repeated rows are judged each; bytes that aren't UTF-8 are word bytes; other
columns are kept, and those named like an added one replaced; an empty benchmark leaves every document clean, an empty
table of documents gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm.arrow import frugal, mapped, small_batches, texts, to_bytes, unused, values, without

#: Words are runs of 0-9, a-z (A-Z lower-cased) and everything beyond ASCII.
_TABLE = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
SHINGLE = 5
PIECE = 1 << 20
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
ADDED = [
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()),
]


def pieces(text: bytes, size: int = PIECE):
    """Lists of the text's words, a bounded part of the text at a time."""
    text = text.translate(_TABLE)
    start = 0
    while start < len(text):
        end = len(text) if len(text) - start <= size else text.find(b" ", start + size)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def words(text: bytes) -> list[bytes]:
    return [w for piece in pieces(text) for w in piece]


def word_ids(text: bytes, ids: dict[bytes, int]) -> np.ndarray:
    """A document as benchmark word numbers; 0 stands for any word that no item has."""
    get = ids.get
    found = [np.fromiter((get(w, 0) for w in piece), np.int32, len(piece)) for piece in pieces(text)]
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def shingle_keys(ids: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit key for each run of ``size`` word numbers."""
    n = len(ids) - size + 1
    key = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        key = (key ^ ids[k : k + n].astype(np.uint64)) * _MIX[k]
        key ^= key >> np.uint64(29)
    return key


class Windows:
    """A block of benchmark windows, ready to be searched; small, since the block is bounded."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.ids: dict[bytes, int] = {}
        self.window = window
        rows: dict[tuple, set] = {}
        for item, found in items:
            nums = [self.ids.setdefault(w, len(self.ids) + 1) for w in found]
            for i in range(max(1, len(nums) - window + 1) if nums else 0):
                rows.setdefault(tuple(nums[i : i + window]), set()).add(item)
        self.rows = list(rows)
        self.items = [sorted(x for x in v if x is not None) for v in rows.values()]
        self.shingles: dict[int, np.ndarray] = {}
        by_size: dict[int, set] = {}
        for row in self.rows:
            size = min(SHINGLE, len(row))
            by_size.setdefault(size, set()).update(shingle_keys(np.array(row, np.int32), size).tolist())
        for size, keys in by_size.items():
            self.shingles[size] = np.array(sorted(keys), np.uint64)

    def meetings(self, ids: np.ndarray):
        """(size, positions, shingle numbers) of the block's shingles in a run of word numbers."""
        known = np.concatenate([[0], np.cumsum(ids != 0)])
        for size, keys in self.shingles.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            found = self._keys_at(ids, at, size)
            where = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            hit = keys[where] == found
            yield size, at[hit], where[hit]

    @staticmethod
    def _keys_at(ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        key = np.zeros(len(at), np.uint64)
        for k in range(size):
            key = (key ^ ids[at + k].astype(np.uint64)) * _MIX[k]
            key ^= key >> np.uint64(29)
        return key

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Choose each window's prefix: its rarest shingle in the corpus, the leftmost of equals."""
        prefix: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for number, row in enumerate(self.rows):
            size = min(SHINGLE, len(row))
            where = np.searchsorted(self.shingles[size], shingle_keys(np.array(row, np.int32), size)).tolist()
            offset = min(range(len(where)), key=lambda k: (counts.get((size, where[k]), 0), k))
            prefix.setdefault(size, {}).setdefault(where[offset], []).append((number, offset))
        self.prefix = {}
        for size, table in prefix.items():
            heads = np.zeros(len(self.shingles[size]) + 1, np.int64)
            for k, v in table.items():
                heads[k + 1] = len(v)
            flat = np.array([x for k in sorted(table) for x in table[k]], np.int64)
            self.prefix[size] = (np.cumsum(heads), flat)
        self.lengths = np.array([len(r) for r in self.rows], np.int64)
        self.table = np.zeros((len(self.rows), self.window), np.int32)
        for number, row in enumerate(self.rows):
            self.table[number, : len(row)] = row

    def occurrences(self, ids: np.ndarray, chunk: int = 1 << 18):
        """(start, window number) of every window that occurs in a run of word numbers."""
        for size, at, shingle in self.meetings(ids):
            heads, flat = self.prefix[size]
            counts = heads[shingle + 1] - heads[shingle]
            ends = np.cumsum(counts)
            first = 0
            while first < len(at):
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + chunk, "right")))
                n = counts[first:last]
                pick = np.repeat(heads[shingle[first:last]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                number, offset = flat[pick, 0], flat[pick, 1]
                start = np.repeat(at[first:last], n) - offset
                fits = (start >= 0) & (start + self.lengths[number] <= len(ids))
                number, start = number[fits], start[fits]
                same = np.ones(len(start), bool)
                for k in range(self.window):
                    within = self.lengths[number] > k
                    same &= ~within | (ids[np.minimum(start + k, len(ids) - 1)] == self.table[number, k])
                yield start[same], number[same]
                first = last


def _count_shingles(docs: DataFrame, block: Windows) -> dict[tuple[int, int], int]:
    """How often the corpus has each of the block's shingles; as many rows as the block has shingles."""

    def run(parts):
        totals = {size: np.zeros(len(keys), np.int64) for size, keys in block.shingles.items()}
        for part in frugal(parts):
            for text in texts(part, "text"):
                for size, _, found in block.meetings(word_ids(text, block.ids)):
                    np.add.at(totals[size], found, 1)
        rows = [(size, k, int(total[k])) for size, total in totals.items() for k in np.flatnonzero(total).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], names=["size", "k", "n"])

    counted = small_batches(docs).select("text").mapInArrow(run, "size int, k long, n long").groupBy("size", "k").agg(F.sum("n").alias("n"))
    return {(r["size"], r["k"]): r["n"] for r in counted.collect()}


def _blocks(benchmark: DataFrame, window: int, block_words: int):
    """The benchmark in blocks of about ``block_words`` words, one at a time on the driver."""
    items = benchmark.select("item_id", "text").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = total // (2 * block_words) + 1  # a word and the space behind it are two characters at least
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        found = [(r["item_id"], words(to_bytes(r["text"]))) for r in items.filter(number == k).collect()]
        if any(x for _, x in found):
            yield Windows(found, window)


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = 500_000) -> DataFrame:
    """Add n_words, n_hit, n_items, items_sha256 and contaminated to the documents.

    Blocks beyond the first are chained, each adding its marks to the hits and items found so far.
    """
    docs = without(docs, *[f.name for f in ADDED])
    hits_name, items_name = unused(docs, "__hits"), unused(docs, "__items")
    state = [T.StructField(hits_name, T.BinaryType()), T.StructField(items_name, T.ArrayType(T.StringType()))]
    blocks = _blocks(benchmark, window, block_words)
    block, marked, first = next(blocks, None), docs, True
    while True:
        if block:
            block.order(_count_shingles(docs, block))
        following = next(blocks, None)

        def judge(part: pa.RecordBatch, block: Windows | None = block, first: bool = first, last: bool = following is None) -> dict[str, list]:
            raws = texts(part, "text")
            hits = [None] * len(raws) if first else values(part, hits_name)
            listed = [[] for _ in raws] if first else values(part, items_name)
            n_words = []
            for row, text in enumerate(raws):
                ids = word_ids(text, block.ids if block else {})
                n_words.append(len(ids))
                edges, found = None, set()
                for start, number in block.occurrences(ids) if block else ():
                    if len(start):
                        edges = np.zeros(len(ids) + 1, np.int64) if edges is None else edges
                        np.add.at(edges, start, 1)
                        np.add.at(edges, start + block.lengths[number], -1)
                        found.update(np.unique(number).tolist())
                if edges is not None:
                    hit = np.cumsum(edges[:-1]) > 0
                    if hits[row]:
                        hit |= np.unpackbits(np.frombuffer(hits[row], np.uint8), count=len(ids)).astype(bool)
                    hits[row] = np.packbits(hit).tobytes()
                    listed[row] = sorted({*listed[row], *(str(x) for k in found for x in block.items[k])})
            if not last:
                return {hits_name: hits, items_name: listed}
            n_hit = [int(np.unpackbits(np.frombuffer(h, np.uint8)).sum()) if h else 0 for h in hits]
            return {"n_words": n_words, "n_hit": n_hit, "n_items": [len(x) for x in listed], "items_sha256": [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in listed], "contaminated": [n > 0 for n in n_hit]}

        if following is None:
            return mapped(marked, judge, ADDED, (hits_name, items_name))
        marked = mapped(marked, judge, state)
        block, first = following, False
