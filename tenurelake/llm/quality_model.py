"""Quality classifier: an additive model with pairwise interactions over counts of the whole text.

Learned on a bounded sample of labelled documents (``MAX_TRAIN``), applied to all.

Defined results: a null text is scored like an empty one, which has the features of no words at all;
labels that are null or belong to no document teach nothing; repeated documents are scored row by
row; without labels of both kinds every document gets one constant score. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tenurelake.llm import gam
from tenurelake.llm.common import labelled_sample
from tenurelake.llm.textstats import SYMBOLS, repeated_words, word_ids

MAX_TRAIN = 20_000
HOLDOUT = (3, 1)
FEATURES = [
    "words", "word_length", "long_words", "symbols", "punctuation", "capitals", "digits", "distinct_words",
    "top_word", "repeated_words", "repeated_lines", "line_length", "shouted_ends",
]
_MARKS = ".,;:!?-'\"()"


def features(text: str | None) -> list[float]:
    """``FEATURES`` of a whole text; shares lie between 0 and 1."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n, ids_kinds = len(words), word_ids(words)
    ids, kinds = ids_kinds
    chars = max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    return [
        float(np.log1p(n)), float(lengths.mean()) if n else 0.0, float((lengths > 12).mean()) if n else 0.0,
        sum(map(text.count, SYMBOLS)) / chars, sum(map(text.count, _MARKS)) / chars,
        sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) / chars, sum(map(text.count, "0123456789")) / chars,
        kinds / max(1, n), float(np.bincount(ids).max()) / n if n else 0.0,
        repeated_words(ids, kinds) / max(1, n), 1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(len(text) / max(1, len(lines)))), sum(w.endswith((b"!!", b"!", b"?")) for w in words) / max(1, n),
    ]


def matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", max_rows: int = MAX_TRAIN) -> gam.Gam:
    """Fits the model on at most ``max_rows`` labelled ids outside the held-out third. Only their
    features, a few numbers each, come to the driver."""
    sample = F.broadcast(labelled_sample(labels, "quality", HOLDOUT, max_rows))
    texts = docs.select(F.col("doc_id"), F.col(f"`{text}`").alias("text")).join(sample, "doc_id").select("doc_id", "text", "y")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "x": list(matrix(b["text"]))})

    # A label's rows can be copies of one id; the cap keeps the matrix bounded all the same.
    measured = texts.mapInPandas(measure, "doc_id long, y int, x array<double>")
    held = measured.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(max_rows).toPandas()
    x = np.array(held["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return gam.fit(x, held["y"].to_numpy(dtype=float))


def quality_score(docs: DataFrame, model: gam.Gam, text: str = "text") -> Column:
    """A column of ``docs``: how likely label 1 is, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(matrix(texts)))

    return score(F.col(f"`{text}`"))
