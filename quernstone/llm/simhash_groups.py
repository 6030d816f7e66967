"""Groups of near copies at a Jaccard similarity of five-word shingles, found with SimHash.

Fingerprints of whole texts only show very close copies: at a similarity of 0.8 two 64-bit fingerprints
differ in about ten bits, where no index is selective. So a text also has fingerprints of parts. Its
distinct shingles are dealt into parts by their hash, two to four to a part, as many parts as its length
asks for; PARTS of them, the same ones in every text of that length, are fingerprinted. Near copies
have several parts in common: at a similarity of 0.8 and three shingles to a part, a pair shares none about
once in five hundred times, and texts of ten words about once in fifty. A text whose length lies near a step is
dealt out for both.

Texts that share a part's or the whole fingerprint are in one bucket. A text that shares none joins the buckets
of the whole fingerprints within three bits of its own, which pigeonring filtering finds.

Each pair that shares a bucket is confirmed, joined in another way or ruled out, on whole shingle sets. First
every member is compared with the bucket's LEADERS: the text that shares most with others, and texts picked by
hash, but for those whose lengths rule the similarity out. Then, in buckets that still hold several components, each member outside the largest one is compared
with LEADERS members of it. That joins most of a group at a cost in proportion to the bucket. What no bucket has
brought together, also texts that share none, is found by a prefix- and length-filtered set join over the shingles
of all texts, rarest first, which no pair of the wanted similarity escapes; it pairs texts of different components
only. Most of these pairs are far from similar, so they get no shingle
sets: sketches of two to four bits a shingle rule them out first, by a bound that no similar pair breaks. What is rare is told by counters of all shingles by hash; any order of shingles is exact, this one keeps
frequent passages out of the prefixes. Groups are the components of what is confirmed. Many texts that are nearly,
but not quite, similar enough to each other have to be compared pair by pair.

Cases: texts that are equal are one node, as are all texts without words; fewer than five words are one
shingle; a very long text is read in parts; of equal ids with different texts each text is judged by itself; a null
doc_id takes no part, and gets no group; ties go to the smallest doc_id, then to the smallest hash; extra columns
are kept, whatever their names but ``__h1`` and ``__h2``; bytes that aren't UTF-8 are hashed as they are; an empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm.arrow import frugal, mapped, small_batches, texts, values
from quernstone.llm.simhash import ring_pairs
from quernstone.llm.text import shingles, word_hashes
from quernstone.plans.components import connected_components
from quernstone.plans.joins import heavy_light_join
from quernstone.plans.scratch import release, stored, temporary

WORDS = 5
SIMILARITY = 0.8
PARTS = 12
LEADERS = 2
#: Pairs that one copy of a shingle set is compared in, when pairs are confirmed.
PAIRS = 1000
#: Parts in which the shingles of all texts are dealt out and compared, one after the other.
SLICES = 4
#: Counters that shingles are ordered by, a power of two.
COUNTERS = 1 << 18
H = ["__h1", "__h2"]


def identity() -> list[Column]:
    """A 128-bit hash of the text, zero for all texts without words."""
    some = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return [F.when(some, F.xxhash64(F.lit(k), F.col("text"))).otherwise(F.lit(0)).alias(h) for k, h in enumerate(H)]


def majority(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A fingerprint for each run of hashes."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    sizes = np.diff(np.append(starts, len(hashes)))
    return np.packbits(ones * 2 > sizes[:, None], axis=1, bitorder="little").view("<i8").ravel()


def part_keys(found: np.ndarray) -> list[int]:
    """A key for each fingerprinted part of distinct shingles; it tells the number of parts, the part and its fingerprint."""
    keys: list[int] = []
    n = len(found)
    steps = {max(0, int(np.log2(n / 2))), max(0, int(np.log2(n * 1.25 / 2)))} if n > 1 else {0}
    for step in sorted(steps):
        part = (found >> np.uint64(40)) & np.uint64((1 << step) - 1)
        own = part < PARTS
        order = np.argsort(part[own], kind="stable")
        chosen, part = found[own][order], part[own][order]
        if not len(chosen):
            continue
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        for number, fp in zip(part[starts].tolist(), majority(chosen, starts).tolist(), strict=True):
            keys.append(xxhash.xxh3_64_intdigest(b"%d,%d,%d" % (step, number, fp)) - (1 << 63))
    return keys


def sketch(found: np.ndarray) -> bytes:
    """The number of distinct shingles, and whether an odd number of them falls on each of two to four bits a shingle."""
    bits = max(64, 1 << (2 * len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.array([len(found)], "<u8").tobytes() + np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def can_be_similar(a: bytes, b: bytes, least: float) -> bool:
    """False only if two texts are less similar than ``least``: where sketches differ, a shingle is in one of them only."""
    short, long = sorted((np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")), key=len)
    folded = np.bitwise_xor.reduce(long[1:].reshape(-1, len(short) - 1), axis=0)
    apart = int(np.bitwise_count(folded ^ short[1:]).sum())
    return apart <= (int(short[0]) + int(long[0])) * (1 - least) / (1 + least) + 1e-6


def signature(found: np.ndarray) -> tuple[int, list[int], int, bytes]:
    """The whole fingerprint and the part keys of a text's shingles, how many different ones there are, and their sketch."""
    if not len(found):
        return 0, [], 0, sketch(found)
    distinct = np.unique(found)
    ones = np.unpackbits(found.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(found), bitorder="little").view("<i8")[0]), part_keys(distinct), len(distinct), sketch(distinct)


def shingle_sets(raws: list[bytes]) -> list[np.ndarray]:
    """The distinct shingles of each text in order."""
    return [np.unique(shingles(w, WORDS)) for w in word_hashes(raws)]


def similarity(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two shingle sets."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common / (len(x) + len(y) - common) if len(x) or len(y) else 1.0


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2, fp, parts, size, sketch) of every document with an id."""

    def make(part: pa.RecordBatch) -> dict[str, list]:
        rows = [signature(shingles(w, WORDS)) for w in word_hashes(texts(part, "text"))]
        return {"fp": [r[0] for r in rows], "parts": [r[1] for r in rows], "size": [r[2] for r in rows], "sketch": [r[3] for r in rows]}

    added = [T.StructField("fp", T.LongType()), T.StructField("parts", T.ArrayType(T.LongType())), T.StructField("size", T.LongType()), T.StructField("sketch", T.BinaryType())]
    return stored(mapped(docs.filter("doc_id IS NOT NULL").select("doc_id", *identity(), "text"), make, added, ("text",)), "signatures")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) for the wanted texts (node, doc_id, h1, h2); only these are moved, since hashes don't compress."""

    def make(part: pa.RecordBatch) -> dict[str, list]:
        return {"shingles": [x.astype("<u8").tobytes() for x in shingle_sets(texts(part, "text"))]}

    with temporary(docs.sparkSession) as keep:
        rows = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", *identity()).join(wanted, ["doc_id", *H]).select("node", "text").dropDuplicates(["node"])
        return keep(stored(mapped(rows, make, [T.StructField("shingles", T.BinaryType())], ("text",)), "sets"))


def _bucketed(nodes: DataFrame) -> DataFrame:
    """(key, node, size, held): the buckets of two texts or more; held is a bucket's number of texts."""
    whole = lambda fp: F.xxhash64(F.lit("whole"), F.col(fp))
    rows = stored(nodes.select("node", "size", F.explode(F.array_append("parts", whole("fp"))).alias("key")).distinct(), "keys")
    sizes = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sizes")
    met = stored(heavy_light_join(rows, sizes, ["key"], "n", sizes.agg(F.sum("n")).first()[0] or 0, "left_semi").select("key", "node", "size"), "met")
    # Texts without company look for whole fingerprints within three bits.
    alone = nodes.select("fp", "node", "size").join(met.select("node"), "node", "left_anti").select("fp", "node", "size")
    prints = nodes.select("fp").distinct().join(alone.select("fp", F.lit(True).alias("asks")), "fp", "left").select("fp", F.col("fp").alias("label"), F.coalesce("asks", F.lit(False)).alias("asks"))
    close = stored(ring_pairs(prints).select("fp", "fp2"), "close")
    guests = close.join(alone, "fp").select(whole("fp2").alias("key"), "node", "size")
    hosts = nodes.select("fp", "node", "size").join(close.select(F.col("fp2").alias("fp")).distinct(), "fp").select(whole("fp").alias("key"), "node", "size")
    every = met.unionByName(guests).unionByName(hosts).distinct()
    sized = stored(every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("held", F.col("n")), "sizes")
    return stored(heavy_light_join(every, sized, ["key"], "n", sized.agg(F.sum("n")).first()[0] or 0), "shared")


def _picks(count: int, seed: int = 0) -> list[Column]:
    """Members (node, size) of a group, picked by hash."""
    return [F.min_by(F.struct("node", "size"), F.xxhash64("node", F.lit(seed + j))).alias(f"l{j}") for j in range(count)]


def _compared(rows: DataFrame, others: str, least: float) -> DataFrame:
    """(a, b): each row's node with the others (node, size) that aren't too much longer or shorter to be similar, once."""
    met = rows.select("node", "size", F.explode(others).alias("o")).filter("node <> o.node")
    fits = F.least("size", "o.size") >= F.greatest("size", "o.size") * least - 1e-6
    return _ordered(met.filter(fits).select("node", F.col("o.node").alias("other")))


def _first_pairs(shared: DataFrame, least: float) -> DataFrame:
    """(a, b): every member of a bucket with each of the bucket's leaders."""
    weights = shared.groupBy("node").agg(F.sum(F.log2("held")).alias("weight"))
    weighed = stored(shared.join(weights, "node"), "weighed")
    best = F.max_by(F.struct("node", "size"), F.struct("weight", "node")).alias("best")
    buckets = stored(weighed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), best, *_picks(LEADERS - 1, 1)).select("key", "n", F.array_distinct(F.array("best", *[f"l{j}" for j in range(LEADERS - 1)])).alias("leaders")), "buckets")
    met = heavy_light_join(weighed.select("key", "node", "size"), buckets, ["key"], "n", buckets.agg(F.sum("n")).first()[0] or 0)
    return _compared(met, "leaders", least)


def _ordered(pairs: DataFrame) -> DataFrame:
    """Each pair (node, other) once."""
    return pairs.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct()


def _with_side(pairs: DataFrame, side: str, rows: DataFrame, name: str) -> DataFrame:
    """The pairs with that column of ``rows`` for one side's node; the row of a text in many pairs is dealt out in copies."""
    counts = pairs.groupBy(F.col(side).alias("node")).agg(F.count(F.lit(1)).alias("n"))
    parts = counts.select("node", F.floor(F.col("n") / PAIRS).cast("int").alias("last"))
    dealt = rows.join(parts, "node").select(F.col("node").alias(side), F.col(name).alias(f"{name}_{side}"), F.explode(F.sequence(F.lit(0), "last")).alias("__salt"))
    few = parts.filter("last > 0").withColumnRenamed("node", side)
    salted = pairs.join(few, side, "left").withColumn("__salt", F.pmod(F.xxhash64("a", "b"), F.coalesce("last", F.lit(0)) + 1).cast("int")).drop("last")
    return salted.join(dealt, [side, "__salt"]).drop("__salt")


def _close(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) that their sketches don't rule out."""
    sides = _with_side(_with_side(pairs, "b", nodes, "sketch"), "a", nodes, "sketch")

    def check(part: pa.RecordBatch) -> dict[str, list]:
        return {"close": [can_be_similar(x, y, least) for x, y in zip(values(part, "sketch_a"), values(part, "sketch_b"), strict=True)]}

    return stored(mapped(sides, check, [T.StructField("close", T.BooleanType())], ("sketch_a", "sketch_b")).filter("close").select("a", "b"), "close")


def _confirmed(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs whose similarity is ``least`` or more."""
    pairs = stored(pairs, "pairs")
    sides = _with_side(_with_side(pairs, "b", sets, "shingles"), "a", sets, "shingles")

    def check(part: pa.RecordBatch) -> dict[str, list]:
        return {"similar": [similarity(x, y) for x, y in zip(values(part, "shingles_a"), values(part, "shingles_b"), strict=True)]}

    return stored(mapped(sides, check, [T.StructField("similar", T.DoubleType())], ("shingles_a", "shingles_b")).filter(F.col("similar") >= least).select("a", "b"), "links")


def _outside(placed: DataFrame) -> DataFrame:
    """Members outside their bucket's largest component: key, node, size, label, largest and picks of that component."""
    parts = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m"), F.array(*_picks(LEADERS, 100)).alias("picks"))
    sizes = parts.groupBy("key").agg(F.sum("m").alias("n"), F.count(F.lit(1)).alias("labels"), F.max_by(F.struct("label", "picks"), F.struct("m", "label")).alias("most"))
    mixed = stored(sizes.filter("labels > 1").select("key", "n", F.col("most.label").alias("largest"), F.array_distinct("most.picks").alias("picks")), "mixed")
    total = mixed.agg(F.sum("n")).first()[0] or 0
    return stored(heavy_light_join(placed, mixed, ["key"], "n", total).filter("label <> largest"), "outside")


def _rarity(docs: DataFrame) -> np.ndarray:
    """How often the distinct shingles of all texts fall on each of COUNTERS hashes."""
    chunk = COUNTERS >> 4

    def count(parts):
        counts = np.zeros(COUNTERS, np.int64)
        for part in frugal(parts):
            if found := shingle_sets(texts(part, "text")):
                counts += np.bincount((np.concatenate(found) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        counts = counts.astype("<i8")
        yield pa.RecordBatch.from_arrays([pa.array(range(16), pa.int32()), pa.array([counts[k * chunk : (k + 1) * chunk].tobytes() for k in range(16)], pa.binary())], names=["chunk", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), "<i8") for x in table.column("counts"))
        return pa.table({"chunk": table.column("chunk")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    kind = "chunk int, counts binary"
    rows = small_batches(docs.select("text")).mapInArrow(count, kind).groupBy("chunk").applyInArrow(add, kind).collect()
    found = np.zeros(COUNTERS, np.int64)
    for row in rows:
        found[row["chunk"] * chunk : (row["chunk"] + 1) * chunk] = np.frombuffer(row["counts"], "<i8")
    return np.minimum(found, np.iinfo(np.uint32).max).astype(np.uint32)


def prefix(found: np.ndarray, rarity: np.ndarray, least: float) -> np.ndarray:
    """Of distinct shingles in order the rarest, of which two texts of that similarity have one in common."""
    size = len(found)
    order = np.argsort(rarity[(found & np.uint64(len(rarity) - 1)).astype(np.int64)], kind="stable")
    return found[order[: size - int(np.ceil(size * least - 1e-6)) + 1]]


def _prefixes(docs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """(node, size, prefix) for every text that has words."""
    docs = docs.filter("doc_id IS NOT NULL").select("doc_id", *identity(), "text")
    rarity = _rarity(docs)

    def make(part: pa.RecordBatch) -> dict[str, list]:
        return {"prefix": [prefix(x, rarity, least).view(np.int64) if len(x) else [] for x in shingle_sets(texts(part, "text"))]}

    rows = stored(mapped(docs, make, [T.StructField("prefix", T.ArrayType(T.LongType()))], ("text",)), "prefixes")
    own = nodes.filter("size > 0").select("node", "size", F.col("least").alias("doc_id"), *H)
    return rows.join(own, ["doc_id", *H]).select("node", "size", "prefix").dropDuplicates(["node"])


def _open_pairs(docs: DataFrame, nodes: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """(a, b): the pairs of texts of different components that can be similar, by a prefix-filtered join.

    A shingle that only one component has pairs nothing, and a shingle's largest component isn't paired with itself.
    All rows of a shingle are in one slice, and slices are taken one after the other, so that few are on disk at once.
    """
    spark = docs.sparkSession
    with temporary(spark) as keep:
        prefixes = _prefixes(docs, nodes, least)
        labelled = keep(stored(prefixes.join(labels, "node", "left").select("node", "size", "prefix", F.coalesce("label", "node").alias("label")), "labelled"))
    met, total = None, 0
    for number in range(SLICES):
        with temporary(spark) as keep:
            words = labelled.select("node", "label", "size", F.posexplode("prefix").alias("place", "shingle")).filter(F.pmod(F.xxhash64("shingle"), F.lit(SLICES)) == number)
            mixed = stored(words.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("n")).filter("x <> y").select("shingle", "n"), "mixed")
            release(spark)
            rows = mixed.agg(F.sum("n")).first()[0] or 0
            part = keep(stored(heavy_light_join(words, mixed, ["shingle"], "n", rows, "left_semi"), "met"))
        met, total = met.unionByName(part) if met else part, total + rows
    parts = met.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("m"))
    largest = stored(parts.groupBy("shingle").agg(F.sum("m").alias("n"), F.max_by("label", F.struct("m", "label")).alias("largest")), "largest")
    marked = stored(heavy_light_join(met, largest, ["shingle"], "n", total).withColumn("small", F.col("label") != F.col("largest")).drop("largest"), "marked")
    x = marked.filter("small").select("shingle", "node", "label", F.col("size").alias("m"), F.col("place").alias("i"))
    y = marked.select("shingle", F.col("node").alias("other"), F.col("label").alias("label2"), F.col("small").alias("small2"), F.col("size").alias("n"), F.col("place").alias("j"))
    room = F.least(F.col("m") - F.col("i"), F.col("n") - F.col("j")) >= (F.col("m") + F.col("n")) * (least / (1 + least)) - 1e-6
    once = ~F.col("small2") | (F.col("node") > F.col("other"))
    return _ordered(x.join(y, "shingle").filter((F.col("label") != F.col("label2")) & once & room).select("node", "other"))


def _groups(docs: DataFrame, least: float) -> DataFrame:
    """(doc_id, h1, h2, group_id, stays) for every document with an id."""
    spark = docs.sparkSession
    with temporary(spark) as keep:
        signed = _signed(docs)
        # Equal texts are one node.
        texts = stored(signed.groupBy(*H).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("fp").alias("fp"), F.first("parts").alias("parts"), F.first("size").alias("size"), F.first("sketch").alias("sketch")).withColumn("node", F.monotonically_increasing_id()), "texts")
        signed = keep(stored(signed.select("doc_id", *H), "ids"))
        nodes = keep(stored(texts.drop("fp", "parts"), "nodes"))
        with temporary(spark) as keep_buckets:
            shared = keep_buckets(_bucketed(texts))
        keep(shared)
    total = signed.count()
    wanted = nodes.select("node", F.col("least").alias("doc_id"), *H).join(shared.select("node").distinct(), "node", "left_semi")
    with temporary(spark) as keep_sets:
        sets = keep_sets(_sets(docs, wanted))
        with temporary(spark) as keep:
            links = keep(_confirmed(_first_pairs(shared, least), sets, least))
        with temporary(spark) as keep:
            groups = keep(stored(connected_components(links), "components"))
            placed = keep(stored(shared.select("key", "node", "size").join(groups, "node", "left").select("key", "node", "size", F.coalesce("component", "node").alias("label")), "placed"))
        with temporary(spark) as keep:
            second = keep(_confirmed(_compared(_outside(placed), "picks", least), sets, least))
        # Components that a pair joins are one from here on.
        with temporary(spark) as keep:
            label = lambda side: placed.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}")).distinct()
            joined = second.join(label("a"), "a").join(label("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
            moved = connected_components(joined).toDF("label", "lower")
            labels = keep(stored(placed.select("node", "label").distinct().join(moved, "label", "left").select("node", F.coalesce("lower", "label").alias("label")), "labels"))
        # What no bucket has brought together is found on the shingles of all texts.
        with temporary(spark) as keep:
            open_pairs = keep(stored(_open_pairs(docs, nodes, labels, least), "open"))
        with temporary(spark) as keep:
            close = keep(_close(open_pairs, nodes, least))
        with temporary(spark) as keep:
            more = close.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(wanted, "node", "left_anti")
            more = stored(more.join(nodes, "node").select("node", F.col("least").alias("doc_id"), *H), "more")
            third = keep(_confirmed(close, sets.unionByName(_sets(docs, more)), least))
        for found in (links, groups, second, third):
            keep_sets(found)
    if not (second.isEmpty() and third.isEmpty()):
        with temporary(spark) as keep:
            groups = keep(stored(connected_components(links.unionByName(second).unionByName(third)), "components"))
    member = stored(nodes.join(groups, "node", "left").select(*H, "least", "n", F.coalesce("component", "node").alias("component")), "members")
    first = F.min(F.struct("least", *H)).alias("first")
    heads = stored(member.groupBy("component").agg(F.count(F.lit(1)).alias("nodes"), first), "heads")
    named = stored(heavy_light_join(member, heads, ["component"], "nodes", member.count()).select(*H, "n", F.col("first.least").alias("group_id"), (F.struct(*H) == F.struct(*[F.col(f"first.{h}") for h in H])).alias("head")), "named")
    rows = heavy_light_join(signed.select("doc_id", *H), named, H, "n", total)
    return rows.select("doc_id", *H, "group_id", (F.col("head") & (F.col("doc_id") == F.col("group_id"))).alias("stays"))


def near_copy_groups(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, group_id) for every document with an id; a group's id is its smallest doc_id."""
    return _groups(docs, least).select("doc_id", "group_id")


def drop_near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents less all but one of each group: the one with the smallest id stays.

    Rows without an id stay. Of rows that agree in id and text one stays, the one whose other columns have the smallest hash.
    """
    with temporary(docs.sparkSession) as keep:
        groups = keep(stored(_groups(docs, least), "groups"))
    gone = groups.filter("NOT stays").select("doc_id", *H).distinct()
    kept = docs.select("*", *identity()).join(gone, ["doc_id", *H], "left_anti")
    repeated = stored(groups.filter("stays").groupBy("doc_id", *H).count().filter("count > 1").select("doc_id", *H), "repeated")
    if repeated.isEmpty():
        return kept.select(docs.columns)
    once = kept.join(repeated, ["doc_id", *H], "left_anti")
    rest = [c for c in docs.columns if c != "doc_id"]
    twice = kept.join(repeated, ["doc_id", *H], "left_semi").groupBy("doc_id", *H).agg(F.min_by(F.struct(*rest), F.xxhash64(*rest)).alias("__row")).select("doc_id", "__row.*")
    return once.select(docs.columns).unionByName(twice.select(docs.columns))
