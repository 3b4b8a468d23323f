"""Quality rules: base counts, then robust multivariate outliers per language and source.

Of each document that passes the base rules a vector of transformed statistics is taken: the
logarithm of the mean word length, the square root of the symbol share, and the shares of repeated
lines and repeated words. For every (language, source) a minimum-covariance-determinant estimate is
found by concentration steps over all documents: distances to the current centre, then mean and
covariance of the closest half. A document whose Mahalanobis distance exceeds the chi-square cut-off
is rejected. ``FLOOR`` is added to the deviation of each statistic, because most documents have no
symbols and no repeats at all and their covariance would be singular.

There are ``STEPS`` steps from one start. Halves cut at edges of bins need not settle: on 256,410
documents some estimate still moved after 40 steps. A step is one aggregate
of exact integer sums per (group, distance bin), so neither the size of a group nor the order of tasks
matters and nothing but a few numbers per group is gathered. The half is cut at the edge of a bin; bins
are narrow steps of the logarithm of the distance.

Defined results: a null or empty text has no words and fails the base rules; null languages and
sources are groups like any other; groups of under ``min_group`` documents are pooled by language,
then all together, and a pool still smaller is judged by the base rules only. Repeated rows count as
often as they occur. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tenurelake.llm.common import free_name
from tenurelake.llm.textstats import base_counts
from tenurelake.operators.scale import small
from tenurelake.session import checkpointed

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
MIN_GROUP = 100  # documents that a group's own estimate is made from, at least
SUPPORT = 0.5  # share of a group that the estimate is made from
STEPS = 6
FLOOR = [0.06, 0.06, 0.08, 0.08]
UNIT = 4096  # statistics are whole numbers of this fraction
BINS = 32  # distance bins per factor of e
NORMAL_QUANTILE = 3.719  # of 0.9999
_D = len(FLOOR)
_STATE = T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("c", "p")])
_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]


def text_counts(text: Column | str = "text") -> Column:
    """A struct of ``COUNTS`` and ``n_lines``, the lines that hold a word."""

    @F.pandas_udf(", ".join(f"{c} long" for c in [*COUNTS, "n_lines"]))
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [(*base_counts(t), sum(1 for x in (t or "").split("\n") if x.strip(" \t\n\v\f\r"))) for t in texts]
            yield pd.DataFrame(rows, columns=[*COUNTS, "n_lines"], dtype="int64")

    return count(F.col(text) if isinstance(text, str) else text)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )


def _statistics() -> list[Column]:
    part = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    stats = [
        F.log(F.greatest(part("word_chars", "n_words"), F.lit(1.0))), F.sqrt(part("n_symbols", "word_chars")),
        part("n_dup_lines", "n_lines"), part("n_repeat_words", "n_words"),
    ]
    return [F.round(s * UNIT).cast("long").alias(f"x{i}") for i, s in enumerate(stats)]


def chi_square(degrees: int, z: float = NORMAL_QUANTILE) -> float:
    """Quantile of chi-square at the normal quantile ``z`` (Wilson and Hilferty's approximation)."""
    a = 2 / (9 * degrees)
    return degrees * (1 - a + z * a**0.5) ** 3


def _pooled(rows: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Adds the group (g1, g2) a row is judged in: its own, its language's small groups, or the rest."""
    keyed = rows.withColumns({
        "k1": F.coalesce(F.col("lang").cast("string"), F.lit("\0")), "k2": F.coalesce(F.col("source").cast("string"), F.lit("\0"))
    })
    counts = keyed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    tiny = F.col("n") < min_group
    lang = counts.filter(tiny).groupBy("k1").agg(F.sum("n").alias("m"))
    named = counts.join(lang, "k1", "left").select(
        "k1", "k2",
        F.when(tiny & (F.col("m") < min_group), "\1").otherwise(F.col("k1")).alias("g1"),
        F.when(tiny, "\1").otherwise(F.col("k2")).alias("g2"),
    )
    return keyed.join(small(named), ["k1", "k2"])


def _distance(x: list[Column]) -> Column:
    """Squared Mahalanobis distance for the centre ``c`` and the packed inverse ``p`` of a row."""
    diff = [x[i] / UNIT - F.get("c", F.lit(i)) for i in range(_D)]
    total = F.lit(0.0)
    for k, (i, j) in enumerate(_PAIRS):
        total = total + diff[i] * diff[j] * F.get("p", F.lit(k)) * (1 if i == j else 2)
    return total


@F.pandas_udf(_STATE)
def _estimate(n: pd.Series, sums: pd.Series, products: pd.Series) -> pd.DataFrame:
    """Centre and packed inverse covariance from counts, sums and sums of products."""
    factor = _consistency()
    out = []
    for m, s, q in zip(n, sums, products):
        mean = np.array(s, dtype=float) / m
        cov = np.zeros((_D, _D))
        for (i, j), v in zip(_PAIRS, q):
            cov[i, j] = cov[j, i] = v / m - mean[i] * mean[j]
        out.append((mean / UNIT, _inverse(factor * cov / UNIT**2)))
    return pd.DataFrame(out, columns=["c", "p"])


def _inverse(cov: np.ndarray) -> list[float]:
    inverse = np.linalg.inv(cov + np.diag(np.square(FLOOR)))
    return [float(inverse[i, j]) for i, j in _PAIRS]


def _consistency() -> float:
    """What a covariance of the closest part is multiplied with to be right for normal data: the part
    over the chi-square probability with two more degrees (degrees even, so both have closed forms)."""
    tail = lambda x, k: np.exp(-x / 2) * sum((x / 2) ** i / float(np.prod(range(1, i + 1))) for i in range(k // 2))
    low, high = 0.0, 200.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - tail(mid, _D) < SUPPORT else (low, mid)
    return SUPPORT / float(1 - tail(low, _D + 2))


@F.pandas_udf(_STATE)
def _start(middle: pd.Series, spread: pd.Series) -> pd.DataFrame:
    """Medians as the centre, median deviations as a diagonal covariance."""
    rows = [(np.array(m) / UNIT, _inverse(np.diag((1.4826 * np.array(s) / UNIT) ** 2))) for m, s in zip(middle, spread)]
    return pd.DataFrame(rows, columns=["c", "p"])


def fit(rows: DataFrame) -> DataFrame:
    """Per group (g1, g2): count ``n``, centre ``c`` and packed inverse covariance ``p``."""
    group, xs = ["g1", "g2"], [F.col(f"x{i}") for i in range(_D)]
    half = lambda cols: F.array(*[F.percentile(c, F.lit(0.5)) for c in cols])
    middles = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), half(xs).alias("m"))
    away = rows.join(small(middles), group)
    spreads = away.groupBy(*group, "n", "m").agg(half([F.abs(x - F.get("m", F.lit(i))) for i, x in enumerate(xs)]).alias("s"))
    state = checkpointed(spreads.select(*group, "n", _start("m", "s").alias("e")).select(*group, "n", "e.*"))
    for _ in range(STEPS):
        near = rows.join(small(state), group).withColumn(
            "bin", F.floor(F.log(_distance(xs) + F.lit(1e-6)) * BINS)
        )
        sums = near.groupBy(*group, "n", "bin").agg(
            F.count(F.lit(1)).alias("m"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(xs)],
            *[F.sum(xs[i] * xs[j]).alias(f"q{i}{j}") for i, j in _PAIRS],
        )
        before = F.coalesce(F.sum("m").over(_along(group)), F.lit(0))
        chosen = sums.withColumn("before", before).filter(F.col("before") < F.col("n") * SUPPORT)
        total = chosen.groupBy(*group, "n").agg(
            F.sum("m").alias("m"), F.array(*[F.sum(f"s{i}").cast("double") for i in range(_D)]).alias("s"),
            F.array(*[F.sum(f"q{i}{j}").cast("double") for i, j in _PAIRS]).alias("q"),
        )
        state = checkpointed(total.select(*group, "n", _estimate("m", "s", "q").alias("e")).select(*group, "n", "e.*"))
    return state


def _along(group: list[str]):
    return W.partitionBy(*group).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)


def judge(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep: list[str] | None = None,
    min_group: int = MIN_GROUP,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the counts, ``base_failed``, the squared ``distance``
    (null where only the base rules judge) and ``kept``. The counts are written once."""
    keep = ["doc_id"] if keep is None else keep
    held = free_name(docs, "_held")
    slim = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias(held), F.col(f"`{lang}`").alias("lang"),
        F.col(f"`{source}`").alias("source"), text_counts(F.col(f"`{text}`")).alias("counts"),
    ).select(held, "lang", "source", "counts.*")
    rows = checkpointed(slim.withColumn("base_failed", base_failed()))
    passed = _pooled(rows.filter(~F.col("base_failed")).select("*", *_statistics()), min_group)
    state = fit(passed)
    judged = passed.join(small(state), ["g1", "g2"]).withColumn(
        "distance", F.when(F.col("n") >= min_group, _distance([F.col(f"x{i}") for i in range(_D)]))
    ).withColumn("kept", F.coalesce(F.col("distance") <= chi_square(_D), F.lit(True)))
    failed = rows.filter("base_failed").withColumns({"distance": F.lit(None).cast("double"), "kept": F.lit(False)})
    columns = [f"{held}.*", *COUNTS, "base_failed", "distance", "kept"]
    return judged.select(*columns).unionByName(failed.select(*columns))
