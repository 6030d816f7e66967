"""SimHash near-duplicates, with links found by pigeonring filtering.

A fingerprint has four segments of 16 bits on a ring. If two fingerprints differ in at most three bits,
some segment starts a chain in which the first ``l`` segments differ in at most ``3 l / 4`` bits for
every ``l``: none in the first segment, at most one in the first two, two in the first three. So the two
agree in a segment and, but for one bit, in the next: 32 bits that are joined on, one side listing the
17 spellings of its second segment. What is left of the chain is checked before the full distance.

Equal fingerprints are one node, so copies are never paired. Nodes are first joined within buckets that
agree in 48 bits, which hold 65,536 nodes at most; the chain join then looks for links between different
components only. A 32-bit bucket that holds one component is left out, and in the others the largest
component is paired with what isn't in it, never with itself, so a dense group of near copies costs what its
neighbours do. Fingerprints travel as 64-bit numbers in tables; none are sent to the driver.

Cases: a null or empty text has the fingerprint zero and links like any other; a very long text is read in
parts; a repeated row joins its copy; a null doc_id is kept, and is only a component's id if the component has
no other; other columns, whatever their names, are left out; bytes that aren't UTF-8 are hashed as they are; an
empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm.arrow import mapped, texts, values, without
from quernstone.llm.text import word_pieces
from quernstone.plans.components import connected_components
from quernstone.plans.joins import heavy_light_join
from quernstone.plans.scratch import stored

SEED = 42
LIMIT = 3
SEGMENTS = 4


def shingle_hashes(text: bytes, size: int):
    """XXH64 of each run of ``size`` words, a bounded part of the text at a time."""
    digest = xxhash.xxh64_intdigest
    carry: list[bytes] = []
    any_yet = False
    for piece in word_pieces(text):
        words = carry + piece
        if len(words) >= size:
            any_yet = True
            line = b" ".join(words)
            at = np.cumsum([0, *(len(w) + 1 for w in words)])
            firsts, lasts = at[: len(words) - size + 1].tolist(), (at[size:] - 1).tolist()
            yield np.array([digest(line[a:b], SEED) for a, b in zip(firsts, lasts, strict=True)], np.uint64)
            carry = words[len(words) - size + 1 :] if size > 1 else []
        else:
            carry = words
    if not any_yet and carry:
        yield np.array([digest(b" ".join(carry), SEED)], np.uint64)


def fingerprint(text: bytes, size: int) -> int:
    """The 64 majority bits of a text's shingle hashes, as a signed number."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, size):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, size: int, name: str = "fp", drop: tuple[str, ...] = ()) -> DataFrame:
    def make(part: pa.RecordBatch) -> dict[str, list]:
        return {name: [fingerprint(t, size) for t in texts(part, "text")]}

    return mapped(docs, make, [T.StructField(name, T.LongType())], drop)


def _turned(fp: str, bits: int) -> Column:
    return F.col(fp) if not bits else F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, 64 - bits))


_NEAR = np.array([sum(1 << b for b in c) for k in range(1, LIMIT + 1) for c in combinations(range(16), k)], np.uint16)


def bucket_roots(members: np.ndarray, shift: int) -> np.ndarray:
    """For fingerprints that differ in one segment only, the smallest that each is linked with in steps."""
    own = ((members.view(np.uint64) >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
    order = np.argsort(members)
    place = np.full(1 << 16, -1, np.int64)
    place[own] = np.arange(len(members))
    roots = np.full(len(members), -1, np.int64)
    for first in order:
        if roots[first] >= 0:
            continue
        roots[first] = first
        front = own[first : first + 1]
        while len(front):
            met = place[np.unique((front[:, None] ^ _NEAR[None, :]).ravel())]
            met = met[met >= 0]
            met = met[roots[met] < 0]
            roots[met] = first
            front = own[met]
    return members[roots]


def _within_buckets(nodes: DataFrame) -> DataFrame:
    """Links of fingerprints that agree in three segments, as a star for each group in a bucket."""
    masks = [~(0xFFFF << (16 * k)) & (1 << 64) - 1 for k in range(SEGMENTS)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(signed)])
    rows = nodes.select("fp", F.explode(keys).alias("x")).select("fp", "x.k", "x.key")
    buckets = rows.groupBy("k", "key").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)

    def run(parts):
        for part in parts:
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for k, fps in zip(values(part, "k"), values(part, "fps"), strict=True):
                members = np.array(fps, np.int64)
                roots = bucket_roots(members, 16 * k)
                other = roots != members
                a.append(members[other])
                b.append(roots[other])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return buckets.mapInArrow(run, "a long, b long")


def ring_pairs(nodes: DataFrame) -> DataFrame:
    """(fp, label, fp2, label2): fingerprints of different labels within LIMIT bits, in either order or both.

    ``nodes`` has fp, label and asks; a pair has at least one side that asks.
    """
    # A fingerprint becomes 68 rows, so a small table has to be dealt out first.
    nodes = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ring = F.array(*[F.struct(F.lit(k).alias("k"), F.shiftrightunsigned(_turned("fp", 16 * k), 32).alias("key")) for k in range(SEGMENTS)])
    rows = nodes.select("fp", "label", "asks", F.explode(ring).alias("x")).select(F.col("x.k").alias("k"), F.col("x.key").alias("key"), "fp", "label", "asks")
    flips = F.array(*[F.lit(x) for x in [0, *(1 << b for b in range(16))]])
    spelled = rows.withColumn("flip", F.explode(flips)).withColumn("key", F.col("key").bitwiseXOR(F.col("flip").cast("long"))).drop("flip")
    # A bucket counts if its two sides hold different labels; most hold one fingerprint.
    every = rows.filter("asks").select("k", "key", "label", F.lit(True).alias("own")).unionAll(spelled.select("k", "key", "label", F.lit(False).alias("own")))
    buckets = every.groupBy("k", "key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.bool_or("own").alias("own"))
    mixed = stored(buckets.filter("x <> y AND own").select("k", "key"), "mixed")
    left = stored(rows.filter("asks").drop("asks").join(mixed, ["k", "key"], "left_semi"), "own")
    right = stored(spelled.drop("asks").join(mixed, ["k", "key"], "left_semi"), "spelled")
    counts = left.unionAll(right).groupBy("k", "key", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = stored(counts.groupBy("k", "key").agg(F.max_by("label", F.struct("n", "label")).alias("largest")), "largest")
    left, right = (x.join(largest, ["k", "key"]) for x in (left, right.withColumnsRenamed({"fp": "fp2", "label": "label2"})))
    diff = "(fp ^ fp2)"
    # The chain's third step: the segments at k, k + 1 and k + 2 of the ring differ in at most two bits.
    masks = [sum(0xFFFF << (16 * ((3 - k - j) % 4)) for j in range(3)) for k in range(SEGMENTS)]
    chain = " OR ".join(f"(k = {k} AND bit_count({diff} & {m - (1 << 64) if m >> 63 else m}L) <= 2)" for k, m in enumerate(masks))
    fits = f"label <> label2 AND ({chain}) AND bit_count({diff}) <= {LIMIT}"
    others = left.filter("label <> largest").drop("largest").join(right.drop("largest"), ["k", "key"]).filter(fits)
    within = left.filter("label = largest").drop("largest").join(right.filter("label2 <> largest").drop("largest"), ["k", "key"]).filter(fits)
    return others.unionByName(within).select("fp", "label", "fp2", "label2").distinct()


def _across(nodes: DataFrame) -> DataFrame:
    """Links between different components of ``nodes`` (fp, label), as distinct pairs of labels."""
    pairs = ring_pairs(nodes.withColumn("asks", F.lit(True)))
    return pairs.select(F.least("label", "label2").alias("a"), F.greatest("label", "label2").alias("b")).distinct()


def fingerprint_components(nodes: DataFrame) -> DataFrame:
    """(fp, label) for distinct fingerprints; label is the smallest fingerprint of the component."""
    first = connected_components(_within_buckets(nodes.select("fp"))).withColumnsRenamed({"node": "fp", "component": "near"})
    labelled = stored(nodes.select("fp").join(first, "fp", "left").select("fp", F.coalesce("near", "fp").alias("label")), "labels")
    second = connected_components(_across(labelled)).withColumnsRenamed({"node": "label", "component": "far"})
    return labelled.join(second, "label", "left").select("fp", F.coalesce("far", "label").alias("label"))


def simhash_components(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document."""
    rows = stored(with_fingerprint(docs.select("doc_id", "text"), size, drop=("text",)), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")), "nodes")
    total = rows.count()
    labels = stored(fingerprint_components(nodes), "components")
    placed = nodes.join(labels, "fp")
    least = placed.groupBy("label").agg(F.min("least").alias("component_id"))
    found = stored(placed.join(least, "label").select("fp", "n", "component_id"), "found")
    out = heavy_light_join(rows, found, ["fp"], "n", total)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
