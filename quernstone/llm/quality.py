"""Quality classification by positive-unlabelled learning.

Trusted positives are the documents labelled 1; all documents without a label are unlabelled web text.
Labels of 0 are never used. The share of positives among the unlabelled, the class prior, is estimated
first: a classifier tells positives from unlabelled text, and on rows it was not fitted on the prior is
the smallest ratio, over its thresholds, of the unlabelled to the positives that pass, with a margin for
the sample's size. Then a linear model minimises the non-negative unbiased risk
``prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)])`` with the logistic loss; where the
bracket turns negative the step goes the other way.

Features are shares and rates of a whole text: its characters by kind, repetition of words and lines, word
and line lengths. The id, language and source are never inputs.

Both samples are bounded (``most`` documents each, one text of each id); every document is scored.

Cases: a null or empty text has all features zero and is scored like any other; a very long text is read in
parts; without positives or without unlabelled rows every score is 0.5; labels that are null are ignored, and a
document labelled more than once counts by its largest label; of an id's texts the one with the smallest hash is
learned from; repeated rows are scored each; bytes that aren't UTF-8 count as what they are; input columns named
like an added one are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm.arrow import mapped, texts, trim, without
from quernstone.llm.linear import Dense, adam, crc_fold, logistic, sampled_texts, sigmoid, smallest_hashes
from quernstone.llm.text import word_pieces
from quernstone.plans.scratch import stored

MOST = 16_000
ASCII = 128


def features(text: bytes) -> np.ndarray:
    """A text as shares and rates, all between about 0 and 1."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = max(1, len(text))
    shares = np.sqrt(np.append(counts[:ASCII], counts[ASCII:].sum()) / n)
    letters = counts[97:123].sum() + counts[65:91].sum() + counts[ASCII:].sum()
    upper = counts[65:91].sum()
    spaces = counts[9:14].sum() + counts[32]
    digits = counts[48:58].sum()
    marks = n - letters - spaces - digits if len(text) else 0
    seen: Counter[bytes] = Counter()
    total = repeats = size = 0
    last = None
    for piece in word_pieces(text):
        seen.update(piece)
        repeats += sum(map(eq, piece, piece[1:])) + (bool(piece) and piece[0] == last)
        last = piece[-1] if piece else last
        total += len(piece)
        size += sum(map(len, piece))
    lines = [x for x in text.split(b"\n") if x.strip()]
    m = max(1, total)
    closed = sum(x.rstrip().endswith((b".", b"!", b"?", b":", b";", b'"')) for x in lines)
    extra = [
        upper / max(1, letters), marks / n, digits / n, repeats / m, np.sqrt(repeats / m), min(size / m / 20, 2.0),
        len(seen) / m, np.log1p(len(seen)) / np.log1p(m) if total else 0.0, max(seen.values(), default=0) / m,
        len(set(lines)) / max(1, len(lines)), closed / max(1, len(lines)), np.log1p(total) / 10, np.log1p(len(lines)) / 10,
        min(total / max(1, len(lines)) / 100, 2.0),
    ]
    return np.concatenate([shares, extra]).astype(np.float32)


WIDTH = len(features(b"x"))


class Model:
    """Standardised features, a weight for each, and the estimated prior."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return sigmoid(z @ self.weights[:-1] + self.weights[-1])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """The share of positives among the unlabelled, from scores of rows the scorer was not fitted on."""
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.unique(np.quantile(positive, np.linspace(0, 0.98, 197)))
    p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    # The margin of error that holds for all thresholds at once, so that a rare tail's luck isn't taken.
    slack = np.sqrt(np.log(4 / delta) / 2) * (len(unlabelled) ** -0.5 + len(positive) ** -0.5)
    best = int(np.argmin((u + slack) / np.maximum(p, 1e-9)))
    return float(np.clip(u[best] / max(p[best], 1e-9), 0.02, 0.98))


def risk_gradient(p: np.ndarray, u: np.ndarray, prior: float, ridge: float):
    """The direction of a step for weights w (the intercept last): the gradient of the non-negative risk."""

    def gradient(w: np.ndarray) -> np.ndarray:
        sp, su = sigmoid(p @ w[:-1] + w[-1]), sigmoid(u @ w[:-1] + w[-1])
        negative = -np.log(np.maximum(1 - su, 1e-12)).mean() - prior * -np.log(np.maximum(1 - sp, 1e-12)).mean()
        rp, ru = prior * (sp - 1) / len(p), su / len(u)
        back = -prior * sp / len(p)
        if negative >= 0:
            rp = rp + back
        else:  # the estimate of the negatives' risk fell below zero: undo the overfitting
            rp, ru = -back, -ru
        return np.append(p.T @ rp + u.T @ ru + ridge * w[:-1], rp.sum() + ru.sum())

    return gradient


def fit(positive: np.ndarray, unlabelled: np.ndarray, rounds: int = 400, ridge: float = 1e-4) -> Model | None:
    """The prior and the classifier from two bounded samples; None if one is empty."""
    if not len(positive) or not len(unlabelled):
        return None
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(0), both.std(0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    # Every other row fits the telling apart, the rest reads off the prior; then the other way round.
    priors = []
    for side in (0, 1):
        fit_p, fit_u, see_p, see_u = p[side::2], u[side::2], p[1 - side :: 2], u[1 - side :: 2]
        if not len(fit_p) or not len(fit_u):
            continue
        y = np.concatenate([np.ones(len(fit_p)), np.zeros(len(fit_u))])
        weight = np.concatenate([np.full(len(fit_p), 0.5 / len(fit_p)), np.full(len(fit_u), 0.5 / len(fit_u))])
        w = logistic(Dense(np.concatenate([fit_p, fit_u])), y, 1e-3, 150, 0.05, weight)
        priors.append(estimate_prior(see_p @ w[:-1], see_u @ w[:-1]))
    prior = float(np.mean(priors)) if priors else 0.5

    gradient = risk_gradient(p, u, prior, ridge)
    return Model(mean, scale, adam(gradient, np.zeros(p.shape[1] + 1), rounds, 0.05), prior)


def _features_of(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(marks, features) of a bounded sample, gathered on the driver."""

    def make(part: pa.RecordBatch) -> dict[str, list]:
        return {"x": [features(t).tobytes() for t in texts(part, "text")]}

    got = mapped(rows, make, [T.StructField("x", T.BinaryType())], ("text",)).toArrow()
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, WIDTH)
    return got.column("mark").to_numpy(), x


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, most: int = MOST) -> Model | None:
    """Fit from labels.quality on documents whose fold is not ``held``."""
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct().filter(crc_fold(F.col("doc_id"), modulus) != held)
    marks = labels.select("doc_id", F.col("quality").alias("q")).filter("q IS NOT NULL").groupBy("doc_id").agg(F.max("q").alias("q"))
    mark = F.when(F.col("q").isNull(), 0).when(F.col("q") == 1, 1)
    marked = stored(ids.join(marks, "doc_id", "left").select("doc_id", mark.alias("mark")).filter("mark IS NOT NULL"), "marks")
    picked = [smallest_hashes(marked.filter(F.col("mark") == v), "doc_id", most) for v in (0, 1)]
    chosen = stored(picked[0].unionByName(picked[1]), "chosen")
    rows = sampled_texts(docs, chosen).select("mark", "text")
    y, x = _features_of(rows)
    fitted = fit(x[y == 1], x[y == 0])
    trim()
    return fitted


def score_quality(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add score and predicted to every document."""
    docs = without(docs, "score", "predicted")

    def make(part: pa.RecordBatch) -> dict[str, list]:
        rows = texts(part, "text")
        score = model.score(np.stack([features(t) for t in rows])) if model and rows else np.full(len(rows), 0.5)
        return {"score": score.astype(np.float64), "predicted": (score >= 0.5).astype(np.int32)}

    return mapped(docs, make, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
