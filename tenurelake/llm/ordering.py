"""Numbering rows in order without one task seeing a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tenurelake.llm.common import parallel
from tenurelake.operators.scale import null_safe_join, small
from tenurelake.session import checkpointed

_ROW_BITS = 33  # monotonically_increasing_id keeps the row inside its partition in so many bits


def positions(rows: DataFrame, part: list[str], order: list[str], out: str = "pos", total: str = "n") -> DataFrame:
    """Adds ``out``, the place 0.. of every row among those with equal ``part``, in ascending ``order``
    (nulls first), and ``total``, the number of them. Nulls of ``part`` are equal.

    Rows are cut into ranges of (part, order), so a part of any size is spread over many tasks; only
    one count per part and range is put in order. Rows that are equal in all that get places of their
    own, and do not gather in one range either. ``rows`` must be narrow: it is written twice.
    """
    told = checkpointed(rows.withColumn("_row", F.monotonically_increasing_id()))
    cut = told.repartitionByRange(parallel(rows), *part, *order, "_row").sortWithinPartitions(*part, *order, "_row")
    # bounds come from a sample, so what follows reads the ranges as they were written
    ranged = checkpointed(cut.drop("_row").withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_at", _ROW_BITS))
    ranges = ranged.groupBy(*part, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_held"))
    whole = W.partitionBy(*part)
    starts = ranges.select(
        *part, "_range", "_first", F.sum("_held").over(whole).alias(total),
        (F.sum("_held").over(whole.orderBy("_range")) - F.col("_held")).alias("_before"),
    )
    placed = null_safe_join(ranged, small(starts, 20_000), [*part, "_range"])
    return placed.withColumn(out, F.col("_at") - F.col("_first") + F.col("_before")).select(*rows.columns, out, total)


def crc_remainder(key: Column | str, mod: int) -> Column:
    """crc32 of the key's decimal text, modulo ``mod``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string")) % mod
