"""Toxicity: a logistic classifier kept from changing its score when identity terms are swapped.

Features are the words of a text and their beginnings of 4 to 6 letters (so that inflected forms
count too), each present or not. Those whose presence says most about the label in a bounded sample
(by the log-likelihood ratio) are kept. Every sampled text that mentions an identity term also gives
counterfactual copies in which all its identity terms are replaced by another term or by a neutral
one; training adds a penalty on the squared change of the score. A mention of a group alone then
cannot raise a score, however unevenly the sample mentions groups.

Defined results: a null text is scored like an empty one (the score of no features); labels that are
null or belong to no document teach nothing; copies of a text count once in training; repeated
documents are scored row by row; without labels of both kinds the score is the share of label 1.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tenurelake.llm.common import labelled_sample
from tenurelake.session import checkpointed

MAX_TRAIN = 20_000
HOLDOUT = (3, 1)
MAX_FEATURES = 20_000
MIN_RATIO = 20.0  # log-likelihood ratio that a feature must reach
MIN_DOCS = 4
STEMS = (4, 5, 6)
THRESHOLD = 0.7
PENALTY, RIDGE, STEPS, RATE = 1.0, 1e-5, 400, 0.2

# Terms that are swapped for one another, per language of mention; the last one is neutral.
IDENTITY = [
    ["women", "men", "girls", "boys", "people"],
    ["woman", "man", "girl", "boy", "person"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "ordinary"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists", "people"],
    ["black", "white", "asian", "latino", "african", "european", "arab", "ordinary"],
    ["gay", "lesbian", "bisexual", "transgender", "queer", "straight", "ordinary"],
    ["immigrants", "refugees", "foreigners", "natives", "people"],
    ["disabled", "blind", "deaf", "old", "young", "ordinary"],
    ["frauen", "männer", "muslime", "christen", "juden", "ausländer", "leute"],
    ["femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers", "gens"],
    ["mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros", "personas"],
]
_WORD = re.compile(r"[^\W\d_]+")


def words_in(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(words: set[str]) -> set[str]:
    """The words and, marked with a star, their beginnings."""
    out = set(words)
    for n in STEMS:
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


def counterfactuals(words: set[str], groups: list[list[str]]) -> list[set[str]]:
    """``words`` with the mentioned terms of each group replaced by the next term, and by the neutral one."""
    out = []
    for group in groups:
        named = words.intersection(group)
        if not named:
            continue
        rest = words - named
        following = {group[(group.index(w) + 1) % len(group)] for w in named}
        out += [rest | following, rest | {group[-1]}]
    return [w for w in out if w != words]


@dataclass
class ToxicityModel:
    bias: float
    weights: dict[str, float]
    threshold: float = THRESHOLD
    _by_stem: dict[int, set[str]] = field(default_factory=dict)

    def __post_init__(self):
        self._words = {f for f in self.weights if not f.endswith("*")}
        self._by_stem = {n: {f[:-1] for f in self.weights if f.endswith("*") and len(f) == n + 1} for n in STEMS}

    def score(self, text: str | None) -> float:
        words = words_in(text)
        total = self.bias + sum(self.weights[w] for w in self._words.intersection(words))
        for n, stems in self._by_stem.items():
            found = stems.intersection([w[:n] for w in words if len(w) > n])
            total += sum(self.weights[s + "*"] for s in found)
        return float(1 / (1 + np.exp(-min(max(total, -40.0), 40.0))))


def _ratio(a, b, na, nb):
    """Log-likelihood ratio of a feature found in a of na texts of one label and b of nb of the other."""
    part = lambda seen, hoped: F.when(seen > 0, seen * F.log(seen / hoped)).otherwise(0.0)
    both, n = a + b, F.lit(float(na + nb))
    return 2 * (
        part(a, both * na / n) + part(b, both * nb / n)
        + part(na - a, (n - both) * na / n) + part(nb - b, (n - both) * nb / n)
    )


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", identity: list[list[str]] | None = None,
    max_rows: int = MAX_TRAIN, penalty: float = PENALTY,
) -> ToxicityModel:
    """Fits the model on at most ``max_rows`` labelled ids outside the held-out third. The driver gets
    the chosen features and, of each sampled text, which of them it has."""
    groups = IDENTITY if identity is None else identity
    sample = F.broadcast(labelled_sample(labels, "toxic", HOLDOUT, max_rows))
    texts = docs.select("doc_id", F.col(f"`{text}`").alias("text")).join(sample, "doc_id")
    once = texts.groupBy(F.xxhash64("text").alias("h")).agg(F.max(F.struct("y", "text")).alias("r"))
    texts = checkpointed(once.select("h", "r.y", "r.text"))
    # An id can have many rows; the hashes alone, without texts, decide which stay within the bound.
    texts = texts.join(F.broadcast(texts.select("h").orderBy("h").limit(max_rows)), "h", "left_semi")
    by_label = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    negative, positive = by_label.get(0, 0), by_label.get(1, 0)
    share = (positive + 0.5) / (positive + negative + 1)
    prior = float(np.log(share / (1 - share)))
    if not negative or not positive:
        return ToxicityModel(prior, {})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[y].update(features_of(words_in(t)))
        for y, held in enumerate(seen):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([y] * len(held), pa.int32()), pa.array(list(held.values()), pa.int64())],
                ["feature", "y", "n"],
            )

    of = lambda y: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).cast("double")
    counted = texts.select("text", "y").mapInArrow(count, "feature string, y int, n long")
    useful = (
        counted.groupBy("feature").agg(of(1).alias("a"), of(0).alias("b")).filter(F.col("a") + F.col("b") >= MIN_DOCS)
        .withColumn("ratio", _ratio(F.col("a"), F.col("b"), positive, negative)).filter(F.col("ratio") >= MIN_RATIO)
        .orderBy(F.desc("ratio"), "feature").limit(MAX_FEATURES)
    )
    vocabulary = [r["feature"] for r in useful.select("feature").collect()]
    at = {f: i for i, f in enumerate(vocabulary)}

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hit = lambda words: sorted(at[f] for f in features_of(words) if f in at)
        for b in batches:
            own = [words_in(t) for t in b["text"]]
            yield pd.DataFrame({
                "h": b["h"], "y": b["y"], "x": [hit(w) for w in own],
                "swaps": [[hit(v) for v in counterfactuals(w, groups)] for w in own],
            })

    rows = texts.mapInPandas(encode, "h long, y int, x array<int>, swaps array<array<int>>").toPandas().sort_values("h")
    own = [list(x) for x in rows["x"]]
    pairs = [(i, list(s)) for i, swaps in enumerate(rows["swaps"]) for s in swaps if list(s) != own[i]]
    bias, weights = fit(own, rows["y"].to_numpy(dtype=float), pairs, len(vocabulary), penalty)
    return ToxicityModel(bias, {f: float(w) for f, w in zip(vocabulary, weights) if w})


class _Sparse:
    """Rows of 0/1 features with products by bincount."""

    def __init__(self, rows: list[list[int]], width: int):
        sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        self.row = np.repeat(np.arange(len(rows)), sizes)
        self.col = np.fromiter((c for r in rows for c in r), dtype=np.int64, count=int(sizes.sum()))
        self.shape = (len(rows), width)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.shape[0])

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, g[self.row], self.shape[1])


def fit(
    rows: list[list[int]], y: np.ndarray, pairs: list[tuple[int, list[int]]], width: int, penalty: float,
) -> tuple[float, np.ndarray]:
    """Minimises log loss, each label with half of the weight, + penalty * mean squared score change
    of ``pairs`` (row, swapped features) + ridge by Adam with fixed steps, so equal input gives an
    equal model."""
    share = np.where(y == 1, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
    x = _Sparse(rows, width)
    base, swapped = np.array([i for i, _ in pairs], dtype=np.int64), _Sparse([s for _, s in pairs], width)
    w = np.zeros(width + 1)
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        margin = x.times(w[:-1]) + w[-1]
        wrong = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y) * share
        grad = np.append(x.back(wrong) + RIDGE * w[:-1], wrong.sum())
        if len(base):
            change = 2 * penalty / len(base) * (margin[base] - w[-1] - swapped.times(w[:-1]))
            grad[:-1] += x.back(np.bincount(base, change, len(y))) - swapped.back(change)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= RATE * (1 - step / (STEPS + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return float(w[-1]), w[:-1]


def toxicity_score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> Column:
    """A column of ``docs``: how likely label 1 is, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    return score(F.col(f"`{text}`"))
