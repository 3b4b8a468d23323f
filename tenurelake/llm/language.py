"""Language identification: multinomial naive Bayes over hashed character n-grams.

A model is a matrix of log probabilities (hash buckets x languages), learned from n-gram counts that
Spark sums up and broadcast for scoring; its size is fixed by the number of buckets and bounded by
``MAX_LANGUAGES``. Texts are scored together: the n-grams of many texts form one sparse matrix (texts x
buckets, with counts) that is multiplied by the model's. A long text is spread over several such
matrices, so memory depends neither on its length nor on how many texts there are.

Defined results: a null text, an empty one and one without a letter are ``und`` with score 0. Ties go
to the first language by name. Without any training text every text is ``und``. Rows with a null or
empty language teach nothing. Repeated rows of a language teach once, but count in its prior.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tenurelake.llm.common import code_points

BUCKET_BITS = 15
ORDERS = 3
WINDOW = 1 << 18  # characters worked on at a time
CELLS = 1 << 21  # of a product worked out at a time, grams x languages
STEP = 2.0**-20  # log probabilities are multiples of it, so sums of up to 10^8 of them are exact
MAX_LANGUAGES = 512
UND = "und"
_SPACE = 32


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Lower-case code point of every letter, a space for every other character."""
    out = np.full(0x110000, _SPACE, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def grams(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Buckets of the text's 1- to 3-grams and the number of letters, window by window.

    Anything but letters counts as a space; grams that begin with a space and hold no letter after
    it, and single spaces, are left out.
    """
    for codes, owner in _windows([text]):
        orders, letter = _grams_of(codes, owner)
        yield np.concatenate([buckets for buckets, _ in orders]), int(letter.sum())


def _windows(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(folded characters, the text each belongs to) of all texts end to end, in windows of about
    ``WINDOW``. A text begins with one space and ends with two, which keep grams from reaching into the
    next one; a window shares its last two characters with the one after it if a text goes on there."""
    parts, owners, size = [], [], 0
    for k, text in enumerate(texts):
        codes = _folded()[code_points(f" {text or ''}  ")]
        at = 0
        while at < len(codes) - 2:
            piece = codes[at : at + max(WINDOW - size, 1) + 2]
            parts.append(piece)
            owners.append(np.full(len(piece), k))
            size += len(piece) - 2
            at += len(piece) - 2
            if size >= WINDOW:
                yield np.concatenate(parts), np.concatenate(owners)
                parts, owners, size = [], [], 0
    if parts:
        yield np.concatenate(parts), np.concatenate(owners)


def _grams_of(codes: np.ndarray, owner: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For 1-, 2- and 3-grams their buckets and the text of each, in order of texts; and which of the
    characters that can begin a gram are letters."""
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    # the last two characters of a text's piece begin no gram: they are padding, or begin the next window
    inside = np.ones(len(codes), dtype=bool)
    ends = np.flatnonzero(np.diff(owner))
    inside[ends] = inside[ends - 1] = False
    inside = inside[:-2]
    letter = (a != _SPACE) & inside
    longer = letter | ((b != _SPACE) & inside)
    base = np.uint32(0x01000193)
    two = a[longer] * base + b[longer]
    one_of, more_of = owner[:-2][letter], owner[:-2][longer]
    found = [
        (_bucket(a[letter], 1), one_of), (_bucket(two, 2), more_of), (_bucket(two * base + c[longer], 3), more_of),
    ]
    return found, letter


def _bucket(key: np.ndarray, order: int) -> np.ndarray:
    mixed = (key + np.uint32(order)) * np.uint32(0x9E3779B1)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77)
    return (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # buckets x languages, multiples of STEP
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """lang_pred and score of every text."""
        n, known = len(texts), len(self.languages)
        total, letters = np.zeros((n, known)), np.zeros(n, dtype=np.int64)
        if known:
            for codes, owner in _windows(texts):
                orders, letter = _grams_of(codes, owner)
                letters += np.bincount(owner[:-2], weights=letter, minlength=n).astype(np.int64)
                for buckets, of in orders:
                    self._multiply(buckets, of, total)
        told = letters > 0
        out = pd.DataFrame({"lang_pred": np.full(n, UND, dtype=object), "score": np.zeros(n)})
        if told.any():
            rows = total[told] + self.prior
            best = rows.argmax(axis=1)
            out.loc[told, "lang_pred"] = np.array(self.languages, dtype=object)[best]
            out.loc[told, "score"] = 1 / np.exp(rows - rows.max(axis=1, keepdims=True)).sum(axis=1)
        return out

    def _multiply(self, buckets: np.ndarray, of: np.ndarray, total: np.ndarray) -> None:
        """Adds the product of a sparse matrix, a one for each gram in the row ``of`` its text, and the
        log probabilities. Sums are exact, so they do not depend on the texts beside."""
        step = max(CELLS // len(self.languages), 1)
        for at in range(0, len(buckets), step):
            row = of[at : at + step]
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            total[row[starts]] += np.add.reduceat(self.log_prob[buckets[at : at + step]], starts, axis=0)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", max_docs: int = 4000, smoothing: float = 0.5) -> LanguageModel:
    """Learns from about ``max_docs`` different texts of each language (all, where there are fewer).

    The sample is bounded so that a fit does not grow with the corpus: of a language with n different
    texts, by an estimate within a few percent, those whose hash is in the lowest ``max_docs / n`` of
    all hashes are used, once each. Priors come from the counts of all rows.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang is not null and lang <> ''")
    rows = rows.withColumn("hash", F.xxhash64("text"))
    counts = [F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("hash", 0.02).alias("texts")]
    found = rows.groupBy("lang").agg(*counts).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not found:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, 0)), np.zeros(0))
    names = [r["lang"] for r in found]
    n = np.array([r["rows"] for r in found], dtype=float)
    share = F.lit(None).cast("long")  # the highest hash used
    for r in found:
        top = 2**63 - 1 if r["texts"] <= max_docs else max_docs * 2**64 // r["texts"] - 2**63
        share = F.when(F.col("lang") == r["lang"], F.lit(top)).otherwise(share)
    # copies of a text meet before and in one shuffle of what was picked
    sample = rows.filter(F.col("hash") <= share).select("text", "lang").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(name, []).append(t)
            for name, some in texts.items():
                held = sums.setdefault(name, np.zeros(1 << BUCKET_BITS, dtype=np.int64))
                for codes, owner in _windows(some):
                    for buckets, _ in _grams_of(codes, owner)[0]:
                        held += np.bincount(buckets, minlength=len(held))
        for name, held in sums.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(held[at])], ["lang", "bucket", "n"]
            )

    counted = sample.mapInArrow(count, "lang string, bucket long, n long")
    sums = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x buckets at most
    table = np.full((1 << BUCKET_BITS, len(names)), smoothing)
    np.add.at(table, (sums["bucket"].to_numpy(dtype=int), pd.Index(names).get_indexer(sums["lang"])), sums["n"].to_numpy())
    return LanguageModel(names, np.round(np.log(table / table.sum(axis=0)) / STEP) * STEP, np.log(n / n.sum()))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """A column struct<lang_pred, score> of ``docs``: the language and its posterior probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held = shared.value
        for texts in batches:
            yield held.predict(texts.tolist())

    return predict(F.col(f"`{text}`"))
