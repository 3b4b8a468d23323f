"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder_is(key: str | Column, mod: int, rest: int) -> Column:
    """Whether crc32 of the key's decimal text leaves ``rest``; false for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string")) % mod == rest, F.lit(False))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until it clashes with no column of ``df`` (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def parallel(df: DataFrame) -> int:
    """How many shuffle partitions the session asks for."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def code_points(text: str):
    import numpy as np

    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def labelled_sample(labels: DataFrame, label: str, holdout: tuple[int, int], max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled ids outside the held-out part, with one label each.

    Ids are taken in order of a hash, so the same labels always give the same sample. Repeated ids
    with differing labels get the larger one; null ids and labels are left out.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(
        F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~remainder_is("doc_id", *holdout)
    )
    one = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def one_by_one(series: Iterable):
    """The texts of a batch with nulls as empty strings."""
    return ("" if t is None else t for t in series)
