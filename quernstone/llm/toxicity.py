"""Toxicity by a classifier chain.

Categories are predicted in a fixed order. Each is a linear model over word features and the probabilities of
the categories before it; the last is the label itself. While fitting, the earlier categories'
probabilities are out-of-fold predictions, so that a later model learns how far they can be trusted on text
they have not seen; for scoring, each model is fitted on the whole sample.

Categories are columns of the labels that the caller names. Without any, they are kinds of toxic text that the
sample shows: the toxic documents are put into KINDS groups by the features they hold (spherical k-means), and a
category's target is the label together with the group.

Word features are the words and their beginnings of four to seven characters, hashed; those that toxic
documents have more often than others are kept, at most ``keep`` of them. A feature's value is the logarithm of
its count, so a few words show in a long text.

Labels of at most ``most`` documents are used, from folds other than ``held``; every document is scored
over its whole text.

Cases: a null or empty text has no features, and gets the probability that the intercepts give, which is small, since
texts without features are part of the sample as not toxic; a very long text
is read in parts; without labels, or with one class only, the probability is the class's share and 0 without any;
null labels are ignored and a document labelled more than once counts by its largest label; of a labelled id's
texts the one with the smallest hash is learned from; features that tell equally much go by their hash, rows by
their id's hash; repeated rows are scored each; bytes that aren't UTF-8 are read as a mark; input columns named like
an added one are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm.arrow import frugal, mapped, small_batches, texts, trim, values, without
from quernstone.llm.linear import Entries, crc_fold, logistic, sampled_texts, sigmoid, smallest_hashes
from quernstone.llm.text import LETTERS, coded_words, grouped
from quernstone.plans.scratch import stored

MOST = 16_000
KEEP = 512
BITS = 18
FOLDS = 4
KINDS = 2
#: The weight of texts without features in the sample, which aren't toxic; it keeps the intercepts where they belong.
SILENCE = 0.05
#: Toxic documents that the groups' centres are fitted on, at most.
CENTRED = 2_000
REMEMBERED = 100_000
TOXIC = "toxic"
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashed places of a run of letters: of its words and their beginnings."""
    mask = (1 << BITS) - 1
    found = set()
    for w in _WORD.findall(word.decode("utf-8", "replace").lower()):
        found.update(xxhash.xxh3_64_intdigest(x.encode()) & mask for x in (f"={w}", *(w[:n] for n in range(4, 8) if len(w) >= n)))
    return tuple(found)


class Remembered(dict):
    """The features of words met before, those that are kept by their number; emptied when full."""

    def __init__(self, place: dict[int, int] | None = None):
        super().__init__()
        self.place = place

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = word_features(word)
        if self.place is not None:
            found = tuple(self.place[f] for f in found if f in self.place)
        self[word] = found
        return found


def feature_counts(raws: list[bytes], memory: Remembered) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, count) of the features that each text has, by row and feature."""
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for group in grouped(raws):
        codes, sizes, words = coded_words([part for _, part in group], LETTERS)
        found = [memory[w] for w in words]
        each = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(each.sum()))
        row = np.repeat([number for number, _ in group], sizes)
        some = np.flatnonzero(each[codes] > 0)
        n = each[codes[some]]
        ends = np.cumsum(n)
        at = np.repeat((np.cumsum(each) - each)[codes[some]] - (ends - n), n) + np.arange(n.sum())
        key, count = np.unique(np.repeat(row[some], n) << BITS | flat[at], return_counts=True)
        keys.append(key)
        counts.append(count)
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)  # a long text may be in several groups
    count = np.bincount(inverse, np.concatenate(counts), len(key))
    return key >> BITS, key & ((1 << BITS) - 1), count


def entries(raws: list[bytes], memory: Remembered, width: int) -> Entries:
    row, feature, count = feature_counts(raws, memory)
    return Entries(row, feature, np.log1p(count), (len(raws), width))


class Chain:
    """Models in their order; each reads the features and the probabilities before it."""

    def __init__(self, place: dict[int, int], names: list[str], models: list[np.ndarray]):
        self.place, self.names, self.models = place, names, models

    def probabilities(self, x: Entries) -> np.ndarray:
        out = np.zeros((x.shape[0], 0))
        width = x.shape[1]
        for w in self.models:
            out = np.column_stack([out, sigmoid(x.times(w[:width]) + out @ w[width:-1] + w[-1])])
        return out


def _fit_one(x: Entries, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    used = y[weight > 0]
    if not len(used) or used.min() == used.max():  # a constant: the share of the only class
        w = np.zeros(x.shape[1] + 1)
        w[-1] = 30.0 if len(used) and used[0] else -30.0
        return w
    return logistic(x, y, 1e-4, 200, 0.1, weight)


def fit_chain(x: Entries, targets: dict[str, np.ndarray], fold: np.ndarray, place: dict[int, int], weight: np.ndarray | None = None) -> Chain:
    """Fit the categories in order, handing on out-of-fold probabilities."""
    models = []
    weight = np.ones(x.shape[0]) if weight is None else weight
    for y in targets.values():
        out = np.zeros(len(y))
        for k in np.unique(fold):
            w = _fit_one(x, y, np.where(fold != k, weight, 0.0))
            out = np.where(fold == k, sigmoid(x.times(w[:-1]) + w[-1]), out)
        models.append(_fit_one(x, y, weight))
        x = x.with_column(out)
    return Chain(place, list(targets), models)


def kinds_of(x: Entries, toxic: np.ndarray, kinds: int = KINDS, rounds: int = 10) -> np.ndarray:
    """The group of each row, -1 for rows that aren't toxic or hold no feature."""
    own = np.flatnonzero(toxic)[:CENTRED]
    number = np.full(x.shape[0], -1, np.int64)
    number[own] = np.arange(len(own))
    inside = number[x.rows] >= 0
    dense = np.zeros((len(own), x.shape[1]))
    dense[number[x.rows[inside]], x.columns[inside]] = 1.0
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    # The first centre is the row nearest to the mean, each further one the row that is least like those before.
    picked: list[int] = []
    for _ in range(min(kinds, len(own))):
        like = dense @ dense[picked].T if picked else -(dense @ dense.mean(0))[:, None]
        picked.append(int(np.argmin(like.max(1))))
    centres = dense[picked]
    for _ in range(rounds if len(picked) else 0):
        group = (dense @ centres.T).argmax(1)
        centres = np.stack([dense[group == k].mean(0) if (group == k).any() else centres[k] for k in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    present = Entries(x.rows, x.columns, np.ones(len(x.rows)), x.shape)
    like = np.stack([present.times(c) for c in centres], 1) if len(centres) else np.zeros((x.shape[0], 1))
    return np.where(toxic & (like.max(1) > 0), like.argmax(1), -1)


def choose_features(with_label: np.ndarray, without_label: np.ndarray, n1: int, n0: int, keep: int, least: int = 3) -> dict[int, int]:
    """The places that labelled documents have more often than others, by a normal score."""
    n = n1 + n0
    if not n1 or not n0:
        return {}
    p = (with_label + without_label) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    score = np.where(with_label + without_label >= least, (with_label / n1 - without_label / n0) / spread, 0)
    best = np.lexsort((np.arange(len(score)), -score))[:keep]
    return {int(f): k for k, f in enumerate(best[score[best] > 0])}


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, most: int = MOST, keep: int = KEEP, categories: Sequence[str] = ()) -> Chain:
    """Fit the chain from labels.toxic, and columns of categories, on documents whose fold is not ``held``."""
    marks = [F.max(c).alias(f"mark{k}") for k, c in enumerate([*categories, TOXIC])]
    last = f"mark{len(categories)}"
    known = small_batches(labels).filter("doc_id IS NOT NULL").filter(F.col(TOXIC).isNotNull()).groupBy("doc_id").agg(*marks)
    known = known.filter(crc_fold(F.col("doc_id"), modulus) != held).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    # Taken without regard to the label, so the sample keeps the classes' shares.
    chosen = stored(smallest_hashes(stored(known, "known"), "doc_id", most), "chosen")
    rows = stored(sampled_texts(docs, chosen).withColumn("hash", F.xxhash64("doc_id")).drop("doc_id").repartition(8), "sample")

    def count(parts):
        seen = np.zeros((2, 1 << BITS), np.int32)
        n = [0, 0]
        memory = Remembered()
        for part in frugal(parts):
            mark = np.array([int(m == 1) for m in values(part, last)], np.int64)
            row, feature, _ = feature_counts(texts(part, "text"), memory)
            np.add.at(seen, (mark[row], feature), 1)
            n[0], n[1] = n[0] + int((mark == 0).sum()), n[1] + int(mark.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n[1]], pa.int64()), pa.array([n[0]], pa.int64()), pa.array([seen[1].tobytes()], pa.binary()), pa.array([seen[0].tobytes()], pa.binary())], names=["n1", "n0", "s1", "s0"])

    # Eight tasks at most, each of which sends two counters of fixed width.
    totals, n1, n0 = np.zeros((2, 1 << BITS), np.int64), 0, 0
    for r in rows.coalesce(8).mapInArrow(count, "n1 long, n0 long, s1 binary, s0 binary").toLocalIterator():
        totals[1] += np.frombuffer(r["s1"], np.int32)
        totals[0] += np.frombuffer(r["s0"], np.int32)
        n1, n0 = n1 + r["n1"], n0 + r["n0"]
    place = choose_features(totals[1], totals[0], n1, n0, keep)
    del totals

    def found(part: pa.RecordBatch) -> dict[str, list]:
        raws = texts(part, "text")
        row, feature, number = feature_counts(raws, Remembered(place))
        cuts = np.searchsorted(row, np.arange(1, len(raws)))
        return {"features": [x.astype("<i4").tobytes() for x in np.split(feature, cuts)], "counts": [x.astype("<i4").tobytes() for x in np.split(number, cuts)]}

    added = [T.StructField("features", T.BinaryType()), T.StructField("counts", T.BinaryType())]
    got = mapped(rows, found, added, ("text",)).toArrow().sort_by("hash")
    feature, number = (np.frombuffer(b"".join(got.column(c).to_pylist()), "<i4") for c in ("features", "counts"))
    sizes = [len(x) // 4 for x in got.column("features").to_pylist()]
    x = Entries(np.repeat(np.arange(got.num_rows), sizes), feature, np.log1p(number), (got.num_rows, len(place)))
    fold = got.column("hash").to_numpy() % FOLDS
    marked = lambda k: np.array([m == 1 for m in got.column(f"mark{k}").to_pylist()], bool)
    toxic = marked(len(categories))
    if categories:
        targets = {name: marked(k) for k, name in enumerate(categories)}
    else:
        kind = kinds_of(x, toxic)
        targets = {f"kind{k + 1}": kind == k for k in range(KINDS)}
    targets |= {TOXIC: toxic}
    weight = np.ones(len(toxic))
    if toxic.any() and not toxic.all():  # silence speaks for no category: a text without features in each fold
        x = Entries(x.rows, x.columns, x.values, (x.shape[0] + FOLDS, x.shape[1]))
        targets = {name: np.append(y, np.zeros(FOLDS, bool)) for name, y in targets.items()}
        fold, weight = np.append(fold, np.arange(FOLDS)), np.append(weight, np.full(FOLDS, SILENCE * len(toxic) / FOLDS))
    fitted = fit_chain(x, {name: y.astype(float) for name, y in targets.items()}, fold, place, weight)
    del got, x, feature, number
    trim()
    return fitted


def score_toxicity(docs: DataFrame, chain: Chain) -> DataFrame:
    """Add p_<category> for each category, and toxic_predicted, to every document."""
    names = [f"p_{n}" for n in chain.names]
    docs = without(docs, *names, "toxic_predicted")

    def make(part: pa.RecordBatch, held: list = []) -> dict[str, list]:  # noqa: B006  one memory for each worker
        if not held:
            held.append(Remembered(chain.place))
        p = chain.probabilities(entries(texts(part, "text"), held[0], len(chain.place)))
        return {n: p[:, k].astype(np.float64) for k, n in enumerate(names)} | {"toxic_predicted": (p[:, -1] >= 0.5).astype(np.int32)}

    return mapped(docs, make, [*(T.StructField(n, T.DoubleType()) for n in names), T.StructField("toxic_predicted", T.IntegerType())])
