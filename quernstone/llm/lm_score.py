"""Language-model scoring with a sharded Elias-Fano n-gram trie.

The model has orders 1 to ``ORDER``, each smoothed by the one below with a Dirichlet prior:
``p_k(w | c) = (n(c w) + s_k p_{k-1}(w | c')) / (n(c) + s_k)``, where c' is the context c less its first word;
``p_1(w) = (n(w) + 1) / (N + V + 1)``. Each order sums to one over the V known tokens and one unknown. All it
takes are counts, and a context's count is that of an n-gram one order below, so orders are counted one
after the other, and nothing about contexts has to be gathered anywhere.

Counts come from the whole training part. Documents are packed into blocks of a bounded number of tokens.
For each order a block asks the shards about its different n-grams, and sends its own counts along; a shard
adds up what all blocks have sent, builds its part of the trie with quantised smoothed probabilities,
and answers from its memory-mapped levels. It also gives each n-gram its place in the trie, by which the
next order names its contexts: an n-gram lives in the shard of its context, as a child does with its parent. A
context that has more than half of a shard's tokens is dealt out by the next word, which every block can
tell from the context's count. Contexts and words that the training part doesn't have aren't asked about.

The number of shards follows the number of tokens. Up to ``FAN`` shards a block sends a message to each; beyond,
messages go by way of relays, each of which takes those of some blocks for some shards and sends them
on, so that a block sends the square root of the number of shards and no message gets small.

Words are compared by 64-bit hashes, everything else by place, so nothing else can collide.

Cases: a null or empty text is one end token; a repeated row is scored, and learned from, each time; a
null doc_id belongs to the training part; bytes that aren't UTF-8 are words like others; a very long text makes
its block longer; extra columns are ignored; an empty table gives an empty table; without any training
document every token has the probability of the unknown one, which is then 1.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quernstone.llm.arrow import frugal, rows_of, small_batches, smaller_batches, texts, trim, values
from quernstone.llm.elias_fano import NgramTrie, WordLevel, log10_of, quantised, share_of
from quernstone.llm.text import coded_words, grouped, mixed
from quernstone.plans.scratch import Bucketed, release, stored

END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))
ORDER = 3
#: The strength s_k of each order's prior, chosen on held-out text; beyond the third order the last one holds.
STRENGTHS = {2: 1000.0, 3: 30.0}
BLOCK_TOKENS = 500_000
SHARD_TOKENS = 1_000_000
FAN = 256
#: A block is a row of several MB; with this bound on Arrow batches each is sent by itself.
ROW_BYTES = 1 << 20
MESSAGE = "dest long, sender long, parcel binary, extra long"
_MESSAGE = pa.schema([("dest", pa.int64()), ("sender", pa.int64()), ("parcel", pa.binary()), ("extra", pa.int64())])


def held_out(doc_id: Column, modulus: int = 7, remainder: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(modulus)) == remainder, F.lit(False))


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unpack(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def _planes(x: np.ndarray) -> bytes:
    """Numbers as their lowest bytes, next bytes and so on, since the higher ones are mostly equal."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _from_planes(raw: memoryview, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


class Form:
    """The columns of a parcel: its index, a column value for each group, and for each item of a group.

    A kind is a numpy type; ``d8`` are 64-bit numbers that mostly rise, kept as differences.
    """

    INDEX = ("i8", "i8", "i4", "i4")

    def __init__(self, groups: tuple, items: tuple):
        self.groups, self.items = groups, items
        self.kinds = (*self.INDEX, *groups, *items)

    def dump(self, parcel: Parcel) -> bytes:
        columns = (*parcel.index, *parcel.groups, *parcel.items)
        cells = [_planes(np.diff(x.astype("i8", copy=False), prepend=0) if kind == "d8" else np.ascontiguousarray(x, kind)) for kind, x in zip(self.kinds, columns, strict=True)]
        return struct.pack(f"<{len(cells)}I", *map(len, cells)) + zstandard.ZstdCompressor(level=1).compress(b"".join(cells))

    def load(self, blob: bytes) -> Parcel:
        sizes = struct.unpack_from(f"<{len(self.kinds)}I", blob)
        body = memoryview(zstandard.ZstdDecompressor().decompress(memoryview(blob)[4 * len(sizes) :]))
        at, found = 0, []
        for kind, size in zip(self.kinds, sizes, strict=True):
            cell = body[at : at + size]
            at += size
            found.append(np.cumsum(_from_planes(cell, "i8")) if kind == "d8" else _from_planes(cell, kind))
        n, g = len(self.INDEX), len(self.groups)
        return Parcel(found[:n], found[n : n + g], found[n + g :])


class Parcel:
    """Pieces of messages between blocks and shards: each has an owner, a shard, some groups and some items."""

    def __init__(self, index: list[np.ndarray], groups: list[np.ndarray], items: list[np.ndarray]):
        self.index, self.groups, self.items = index, groups, items

    @property
    def owner(self) -> np.ndarray:
        return self.index[0]

    @property
    def shard(self) -> np.ndarray:
        return self.index[1]

    @classmethod
    def joined(cls, parcels: list[Parcel]) -> Parcel:
        rows = [(*p.index, *p.groups, *p.items) for p in parcels]
        found = [np.concatenate(x) for x in zip(*rows, strict=True)]
        n, g = len(parcels[0].index), len(parcels[0].groups)
        return cls(found[:n], found[n : n + g], found[n + g :])

    def split(self, by: np.ndarray):
        """(key, parcel) for each different key of the pieces."""
        order = np.argsort(by, kind="stable")
        groups, items = (_gathered(sizes, order) for sizes in self.index[2:4])
        sorted_groups, sorted_items = [x[groups[0]] for x in self.groups], [x[items[0]] for x in self.items]
        edges = np.flatnonzero(np.diff(by[order])) + 1
        for first, last in zip([0, *edges], [*edges, len(order)], strict=True):
            if first == last:
                continue
            g, i = (slice(ends[first], ends[last]) for ends in (groups[1], items[1]))
            yield int(by[order[first]]), Parcel([x[order[first:last]] for x in self.index], [x[g] for x in sorted_groups], [x[i] for x in sorted_items])


def _gathered(sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, ends): where the members of the pieces are, piece by piece in the new order, and where each ends."""
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    own = sizes[order].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(own)])
    return np.repeat(starts[order] - ends[:-1], own) + np.arange(ends[-1]), ends


#: A word's hash and the block's count; the word's count and its rank in the shard.
ASK_WORDS, ANSWER_WORDS = Form(("u8", "u4"), ()), Form(("u8", "i8"), ())
#: A context's place, home shard, number of items and count, and each next word, the block's count and the code one
#: order below; the n-gram's count, place and code.
ASK, ANSWER = Form(("d8", "u4", "u4", "u8"), ("i8", "u4", "u2")), Form((), ("u2", "u8", "d8"))
#: Of the last order only codes are asked.
LAST_ANSWER = Form((), ("u2",))
#: An id is a shard and, in its lower bits, a place there. No word has the place of the beginning of texts.
PLACE_BITS = 40
PLACES = (1 << PLACE_BITS) - 1
BEGIN_PLACE = 1 << 38


class Route:
    """From blocks to shards and back, directly or by way of relays."""

    def __init__(self, shards: int, blocks: int, fan: int = FAN):
        self.shards = shards
        self.direct = shards <= fan
        # Shards behind a relay, and blocks before it: their square root, so that a relay holds about what a block does.
        self.width = int(np.ceil(np.sqrt(shards)))
        self.bunches = blocks // self.width + 1

    def first(self, shard: np.ndarray, block: int) -> np.ndarray:
        if self.direct:
            return shard
        return shard // self.width * self.bunches + int(mixed(*np.array([[block], [self.shards]], np.uint64))[0] % np.uint64(self.bunches))

    def messages(self, parcel: Parcel, block: int, form: Form) -> pa.RecordBatch:
        return _messages([(dest, block, form.dump(p), 0) for dest, p in parcel.split(self.first(parcel.shard, block))])

    def exchange(self, asked: DataFrame, ask: Form, answer: Form, serve) -> DataFrame:
        """Messages with the answers, addressed to blocks. ``serve`` answers a shard's parcels and counts something."""

        def relayed(table: pa.Table) -> pa.Table:
            every = Parcel.joined([ask.load(x.as_py()) for x in table.column("parcel")])
            relay = table.column("dest")[0].as_py()
            return pa.Table.from_batches([_messages([(shard, relay, ask.dump(p), 0) for shard, p in every.split(every.shard)])])

        def served(table: pa.Table) -> pa.Table:
            parcels = [ask.load(x.as_py()) for x in table.column("parcel")]
            answers, extra = serve(parcels)
            senders, shard = table.column("sender").to_pylist(), table.column("dest")[0].as_py()
            out = _messages([(to, shard, answer.dump(p), extra if k == 0 else 0) for k, (to, p) in enumerate(zip(senders, answers, strict=True))])
            trim()
            return pa.Table.from_batches([out])

        def returned(table: pa.Table) -> pa.Table:
            every = Parcel.joined([answer.load(x.as_py()) for x in table.column("parcel")])
            extra = sum(table.column("extra").to_pylist())
            relay = table.column("dest")[0].as_py()
            return pa.Table.from_batches([_messages([(owner, relay, answer.dump(p), extra if k == 0 else 0) for k, (owner, p) in enumerate(every.split(every.owner))])])

        if self.direct:
            return asked.groupBy("dest").applyInArrow(served, MESSAGE)
        at_shards = asked.groupBy("dest").applyInArrow(relayed, MESSAGE)
        return at_shards.groupBy("dest").applyInArrow(served, MESSAGE).groupBy("dest").applyInArrow(returned, MESSAGE)


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _MESSAGE, strict=True)], schema=_MESSAGE)


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def make_blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row for each block: its documents, its different words' hashes, and its tokens as places there.

    Place 0 is the end. A block's number is its partition's and its own in it.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("held", T.BinaryType()),
        T.StructField("lengths", T.BinaryType()), T.StructField("hashes", T.BinaryType()), T.StructField("tokens", T.BinaryType()),
        T.StructField("n_train", T.LongType()), T.StructField("n_begins", T.LongType()),
    ])
    wanted = to_arrow_schema(schema)

    class Open:
        """A block that still grows."""

        def __init__(self):
            self.ids, self.held, self.lengths, self.tokens = [], [], [], []
            self.words: dict[bytes, int] = defaultdict(count(1).__next__)
            self.size = 0

        def add(self, doc_id, held: bool, tokens: list[np.ndarray]) -> None:
            self.tokens.extend([*tokens, np.zeros(1, np.int32)])
            self.ids.append(doc_id)
            self.held.append(held)
            self.lengths.append(sum(map(len, tokens)) + 1)
            self.size += self.lengths[-1]

        def row(self, number: int) -> pa.RecordBatch:
            hashes = np.concatenate([[END], np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))]).astype(np.uint64)
            lengths, held = np.array(self.lengths, np.int32), np.array(self.held, bool)
            cells = [number, self.ids, np.packbits(held).tobytes(), _pack(lengths), hashes.tobytes(), _pack(np.concatenate(self.tokens).astype(np.int32)), int(lengths[~held].sum()), int((~held).sum())]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(cells, wanted, strict=True)], schema=wanted)

    def run(parts):
        number = count(TaskContext.get().partitionId() << 32)
        block = Open()
        for part in frugal(parts):
            ids, held, raws = values(part, "doc_id"), values(part, "held"), texts(part, "text")
            pending: list[np.ndarray] = []
            at = 0  # the text that the pending tokens belong to
            for group in [*grouped(raws, 1 << 20), [(len(raws), b"")]]:
                while at < group[0][0]:  # texts without words are in no group
                    block.add(ids[at], held[at], pending)
                    pending, at = [], at + 1
                if block.size >= block_tokens and not pending:
                    yield block.row(next(number))
                    block = Open()
                codes, counts, found = coded_words([x for _, x in group])
                places = np.fromiter(map(block.words.__getitem__, found), np.int32, len(found))[codes] if found else codes
                for (text, _), tokens in zip(group, np.split(places, np.cumsum(counts)[:-1]), strict=True):
                    while at < text:
                        block.add(ids[at], held[at], pending)
                        pending, at = [], at + 1
                    pending.append(tokens)
        if block.ids:
            yield block.row(next(number))

    return docs.select("doc_id", "held", "text").mapInArrow(run, schema)


class Scale:
    """The few numbers that hold for the whole corpus."""

    def __init__(self, tokens: int, known: int, begins: int, shard_tokens: int, order: int, strengths: dict[int, float]):
        self.tokens, self.known, self.begins, self.shard_tokens, self.order = tokens, known, begins, shard_tokens, order
        self.shards = tokens // shard_tokens + 1
        self.strengths = strengths

    def strength(self, order: int) -> float:
        return self.strengths.get(order, self.strengths[max(self.strengths)])


class Level:
    """The different n-grams of one order in a block: context, next word, and the block's own counts.

    Settling adds, for each, its count in the corpus, its id (place and shard in one number) and its code.
    """

    count: np.ndarray
    ids: np.ndarray
    code: np.ndarray

    def __init__(self, item: np.ndarray, context: np.ndarray, word: np.ndarray, seen: np.ndarray):
        #: Each token's n-gram, -1 where the text has begun too late for one.
        self.item, self.context, self.word, self.seen = item, context, word, seen


class Block:
    """A block's arrays, and its levels as far as answers have come."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.words = np.frombuffer(row["hashes"], np.uint64)
        self.lengths = _unpack(row["lengths"], np.int32)
        self.held = np.unpackbits(np.frombuffer(row["held"], np.uint8), count=len(self.lengths)).astype(bool)
        self.tokens = _unpack(row["tokens"], np.int32)
        self.train = np.repeat(~self.held, self.lengths)
        self.heads = np.cumsum(self.lengths) - self.lengths
        self.begins = int((~self.held).sum())

    def words_level(self) -> Level:
        """The words, and behind them the beginning of a text, which is a context and never a token."""
        seen = np.bincount(self.tokens[self.train], minlength=len(self.words))
        return Level(self.tokens, np.zeros(0, int), np.arange(len(self.words)), np.append(seen, self.begins))

    def settled_words(self, answers: list[bytes], scale: Scale) -> Level:
        """The words' counts, ids and codes. The block's words are put in the order of their ids, new ones first."""
        n = len(self.words)
        shard = _shard_of(self.words, scale.shards)
        order = np.argsort(shard, kind="stable")
        shard = shard[order]
        count, ids = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        for parcel in map(ANSWER_WORDS.load, answers):
            firsts = np.searchsorted(shard, parcel.shard)
            at = 0
            for s, first, size in zip(parcel.shard.tolist(), firsts.tolist(), parcel.index[2].tolist(), strict=True):
                places = order[first : first + size]
                count[places], rank = parcel.groups[0][at : at + size], parcel.groups[1][at : at + size]
                ids[places] = np.where(rank >= 0, s << PLACE_BITS | rank, -1)
                at += size
        order = np.argsort(ids, kind="stable")
        place = np.empty(n, np.int32)
        place[order] = np.arange(n, dtype=np.int32)
        self.words, self.tokens = self.words[order], place[self.tokens]
        level = self.words_level()
        level.count, level.ids = np.append(count[order], scale.begins), np.append(ids[order], BEGIN_PLACE)
        level.code = quantised((level.count[:n] + 1) / (scale.tokens + scale.known + 1))
        return level

    def above(self, below: Level, words: Level, order: int) -> Level:
        """The level of the next order. Its n-grams are in the order of their contexts' ids, then of the words' ids."""
        context = np.empty(len(self.tokens), np.int64)
        context[1:] = below.item[:-1]
        context[self.heads] = len(self.words) if order == 2 else -1
        has = np.flatnonzero(context >= 0)
        width = len(self.words)
        keys, item = np.unique(context[has] * width + self.tokens[has], return_inverse=True)
        first = np.empty(len(keys), np.int64)
        first[item[::-1]] = has[::-1]
        of_token = np.full(len(self.tokens), -1, np.int32)
        of_token[has] = item
        level = Level(of_token, keys // width, keys % width, np.bincount(item[self.train[has]], minlength=len(keys)))
        level.total, level.lower = below.count[level.context], below.code[below.item[first]]
        level.context_ids, level.word_ids = below.ids[level.context], words.ids[level.word]
        return level

    def dealt(self, level: Level, scale: Scale) -> tuple[np.ndarray, np.ndarray]:
        """(items, shards): the items that are asked about, by shard, context and word."""
        items = np.flatnonzero((level.total > 0) & (level.word_ids >= 0))
        shard = level.context_ids[items] >> PLACE_BITS
        parts = level.total[items] // max(1, scale.shard_tokens // 2) + 1
        many = np.flatnonzero(parts > 1)
        shard[many] = (shard[many] + (level.word_ids[items[many]] & PLACES) % parts[many]) % scale.shards
        order = np.argsort(shard, kind="stable")
        return items[order], shard[order]

    def question(self, level: Level, scale: Scale) -> Parcel | None:
        """What a block asks about a level: a piece for each shard, a group for each context."""
        items, shard = self.dealt(level, scale)
        if not len(items):
            return None
        context = level.context_ids[items]
        groups = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (shard[1:] != shard[:-1])]))
        pieces = np.flatnonzero(np.diff(shard[groups], prepend=-1))
        sizes = np.diff(np.append(groups, len(items)))
        ends = np.append(groups[pieces], len(items))
        index = [np.full(len(pieces), self.number), shard[groups[pieces]], np.diff(np.append(pieces, len(groups))), np.diff(ends)]
        return Parcel(index, [context[groups] & PLACES, context[groups] >> PLACE_BITS, sizes, level.total[items[groups]]], [level.word_ids[items], level.seen[items], level.lower[items]])

    def settle(self, level: Level, order: int, answers: list[bytes], scale: Scale, last: bool) -> None:
        """Codes of a level and, but for the last, counts and ids; what wasn't asked about isn't in the training part."""
        items, shard = self.dealt(level, scale)
        strength = scale.strength(order)
        level.count, level.ids = np.zeros(len(level.word), np.int64), np.full(len(level.word), -1, np.int64)
        level.code = quantised(strength * share_of(level.lower) / (level.total + strength))
        for parcel in map((LAST_ANSWER if last else ANSWER).load, answers):
            firsts = np.searchsorted(shard, parcel.shard)
            at = 0
            for s, first, size in zip(parcel.shard.tolist(), firsts.tolist(), parcel.index[3].tolist(), strict=True):
                places = items[first : first + size]
                code, *more = (x[at : at + size] for x in parcel.items)
                level.code[places] = code
                if more:
                    level.count[places] = more[0]
                    level.ids[places] = np.where(more[0] > 0, s << PLACE_BITS | more[1], -1)
                at += size

    def levels(self, answers: list[list[bytes]], scale: Scale, order: int) -> list[Level]:
        """Levels 1 to ``order``; the last isn't settled if its answers are missing."""
        found: list[Level] = [self.settled_words(answers[0], scale)]
        for k in range(2, order + 1):
            found.append(self.above(found[-1], found[0], k))
            if len(answers) >= k:
                self.settle(found[-1], k, answers[k - 1], scale, k == scale.order)
        return found


def _ask_words(blocks: DataFrame, scale: Scale, route: Route) -> DataFrame:
    def run(parts):
        for part in frugal(parts, 1):
            for row in rows_of(part):
                block = Block(row)
                seen = np.bincount(block.tokens[block.train], minlength=len(block.words))
                shard = _shard_of(block.words, scale.shards)
                order = np.argsort(shard, kind="stable")
                pieces, sizes = np.unique(shard, return_counts=True)
                parcel = Parcel([np.full(len(pieces), block.number), pieces, sizes, np.zeros(len(pieces), int)], [block.words[order], seen[order]], [])
                yield route.messages(parcel, block.number, ASK_WORDS)

    return blocks.select("block", "hashes", "held", "lengths", "tokens").mapInArrow(run, MESSAGE)


def _serve_words(parcels: list[Parcel]) -> tuple[list[Parcel], int]:
    """Each asked word's count and rank, and how many words of the shard the training part has."""
    hashes = [p.groups[0] for p in parcels]
    words, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = np.bincount(inverse, weights=np.concatenate([p.groups[1] for p in parcels])).astype(np.int64)
    known = np.flatnonzero(totals > 0)
    level = WordLevel(words[known], totals[known])
    # Frequent words get small ranks, which take less room in the messages to come.
    rank = np.full(len(words), -1, np.int64)
    rank[known[np.argsort(-totals[known], kind="stable")]] = np.arange(len(known))
    counts, ranks = level.lookup(words)[inverse], rank[inverse]
    cuts = np.cumsum([len(h) for h in hashes])[:-1]
    return [Parcel(p.index, [c, r], []) for p, c, r in zip(parcels, np.split(counts, cuts), np.split(ranks, cuts), strict=True)], len(known)


def _serve(strength: float, last: bool):
    """Answers of a shard of one order: it adds up the blocks' counts, builds its part of the trie, and looks up."""

    def serve(parcels: list[Parcel]) -> tuple[list[Parcel], int]:
        group, item = (lambda k: np.concatenate([p.groups[k] for p in parcels])), (lambda k: np.concatenate([p.items[k] for p in parcels]))
        contexts, own = np.unique(group(1).astype(np.int64) << PLACE_BITS | group(0), return_inverse=True)
        total = np.zeros(len(contexts), np.float64)
        total[own] = group(3)
        # Contexts and words by their numbers in the shard are one key.
        key = np.repeat(own << 32, group(2))
        del own
        for p in parcels:  # each column goes when its array is made; only the index is needed for the answers
            p.groups = []
        words, number = np.unique(item(0), return_inverse=True)
        sizes = [len(p.items[0]) for p in parcels]
        for p in parcels:
            p.items[0] = None
        key |= number
        del number
        ngrams, inverse = np.unique(key, return_inverse=True)
        del key
        inverse = inverse.astype(np.int32)
        counts = np.bincount(inverse, weights=item(1), minlength=len(ngrams))
        lower = np.zeros(len(ngrams), np.uint16)
        lower[inverse] = item(2)
        for p in parcels:
            p.items = []
        context, word = (ngrams >> 32).astype(np.int32), (ngrams & 0xFFFFFFFF).astype(np.int32)
        del ngrams
        share = strength * share_of(lower)
        del lower
        known = np.flatnonzero(counts > 0)
        heads = np.flatnonzero(np.diff(context[known], prepend=-1))
        own = np.full(len(contexts), -1, np.int64)
        own[context[known[heads]]] = np.arange(len(heads))
        trie = NgramTrie(np.append(heads, len(known)), words, word[known], quantised((counts[known] + share[known]) / (total[context[known]] + strength)))
        # What only held-out texts have can't be in the trie.
        place = np.full(len(context), -1, np.int64)
        place[known] = trie.places(own[context[known]], trie.numbers(words)[word[known]])
        codes = trie.codes_at(place)
        new = np.flatnonzero(place < 0)  # an n-gram that the trie doesn't hold backs off
        codes[new] = quantised(share[new] / (total[context[new]] + strength))
        del share, word, context, trie
        columns = [codes[inverse]]
        if not last:
            place[new] = np.maximum.accumulate(place)[new]  # isn't read, and close to the others takes no room
            columns += [counts.astype(np.uint64)[inverse], place[inverse]]
        cuts = np.cumsum(sizes)[:-1]
        return [Parcel(p.index, [], list(x)) for p, *x in zip(parcels, *(np.split(x, cuts) for x in columns), strict=True)], 0

    return serve


def _ask(state: DataFrame, order: int, scale: Scale, route: Route) -> DataFrame:
    def run(parts):
        for part in frugal(parts, 1):
            for row in rows_of(part):
                block = Block(row)
                level = block.levels([row[f"answers{k}"] or [] for k in range(1, order)], scale, order)[-1]
                parcel = block.question(level, scale)
                if parcel:
                    yield route.messages(parcel, block.number, ASK)
                del block, level, parcel
                trim()

    return state.mapInArrow(run, MESSAGE)


def _by_block(messages: DataFrame, order: int) -> DataFrame:
    """(block, answers, extra): the answers of each block."""
    return messages.groupBy(F.col("dest").alias("block")).agg(F.collect_list("parcel").alias(f"answers{order}"), F.sum("extra").alias(f"extra{order}"))


def score_texts(docs: DataFrame, held: Column, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS, order: int = ORDER, fan: int = FAN, strengths: dict[int, float] | None = None) -> DataFrame:
    """Score every text by a model of that order that is learned from the rows where ``held`` is false.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.
    """
    with smaller_batches(small_batches(docs).sparkSession, ROW_BYTES):
        return _scored(docs, held, block_tokens, shard_tokens, order, fan, strengths or STRENGTHS)


def _scored(docs: DataFrame, held: Column, block_tokens: int, shard_tokens: int, order: int, fan: int, strengths: dict[int, float]) -> DataFrame:
    spark = docs.sparkSession
    tables = Bucketed(spark, "block", large=True)
    blocks = tables.store(make_blocks(docs.select("doc_id", held.alias("held"), "text"), block_tokens).repartition(tables.buckets, "block"))
    size = blocks.agg(F.sum("n_train").alias("n"), F.sum("n_begins").alias("b"), F.count(F.lit(1)).alias("k")).first()
    scale = Scale(int(size["n"] or 0), 0, int(size["b"] or 0), shard_tokens, order, strengths)
    route = Route(scale.shards, size["k"], fan)
    words = tables.store(_by_block(route.exchange(_ask_words(blocks, scale, route), ASK_WORDS, ANSWER_WORDS, _serve_words), 1))
    scale.known = int(words.agg(F.sum("extra1")).first()[0] or 0)
    state = blocks.join(words.drop("extra1"), "block", "left")
    for k in range(2, order + 1):
        release(spark)
        needed = state.drop("doc_ids", "n_train", "n_begins")
        answers = _by_block(route.exchange(_ask(needed, k, scale, route), ASK, LAST_ANSWER if k == order else ANSWER, _serve(scale.strength(k), k == order)), k).drop(f"extra{k}")
        state = state.join(tables.store(answers) if k < order else answers, "block", "left")
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])
    wanted = to_arrow_schema(schema)
    floor = np.log10(scale.tokens + scale.known + 1)

    def run(parts):
        for part in frugal(parts, 1):
            for row in rows_of(part):
                block = Block(row)
                levels = block.levels([row[f"answers{k}"] or [] for k in range(1, order + 1)], scale, order)
                seen = levels[0].count[:-1]
                base = (np.log10(seen + 1) - floor)[block.tokens]
                logs = log10_of(levels[0].code)[block.tokens]
                for level in levels[1:]:
                    has = np.flatnonzero(level.item >= 0)
                    logs[has] = log10_of(level.code)[level.item[has]]
                known = (seen > 0)[block.tokens].astype(np.int64)
                heads = block.heads
                cells = [row["doc_ids"], block.held, block.lengths.astype(np.int64), np.add.reduceat(known, heads), np.full(len(heads), scale.tokens), np.add.reduceat(base, heads), np.add.reduceat(logs, heads)]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cells, wanted, strict=True)], schema=wanted)
                del block, levels, base, logs
                trim()

    scored = stored(state.drop("n_train", "n_begins").mapInArrow(run, schema), "scores")
    tables.drop()
    release(spark)
    return scored
