"""Folders that a stream adds to with every batch, merged from time to time.

Batches write ``<folder>/batch=N``. A merge puts what the batches up to K left into
``<folder>.merged/upto=K``, which counts from its success marker on, and removes those batches. Readers
take the newest complete merge and the batches after it, so a merge that breaks off changes nothing and
can be repeated. Only batches whose commit the stream has noted are merged: one that will be repeated
still finds its own folder to overwrite. Merge between runs of a stream, not beside one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenurelake.sources.folders import numbered, remove

_UPTO, _BATCH = r"upto=(\d+)", r"batch=(\d+)"


def _target(folder: str, number: int) -> str:
    return f"{folder}.merged/upto={number}"


def _last_merge(spark: SparkSession, folder: str) -> int | None:
    return max(numbered(spark, f"{folder}.merged", _UPTO, complete=True), default=None)


def committed(spark: SparkSession, out: str) -> int | None:
    """The last batch that the stream has noted as done."""
    return max(numbered(spark, f"{out}/_checkpoint/commits", r"(\d+)"), default=None)


def read(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    """What all batches left, with the number of the ``batch``; ``schema`` names all columns, if given."""
    reader = lambda held: spark.read.schema(held) if held else spark.read
    last = _last_merge(spark, folder)
    if last is None:
        return reader(schema).parquet(folder)
    whole = reader(schema).parquet(_target(folder, last))
    later = reader(schema or whole.schema).parquet(folder).filter(F.col("batch") > last)
    return whole.unionByName(later)


def merge(
    spark: SparkSession, out: str, kind: str, combine: Callable[[DataFrame], DataFrame],
    by: str | None = None, order: list[str] | None = None,
) -> None:
    """Merges the committed batches of ``out``/``kind`` into ``combine`` of their rows, in folders ``by``."""
    folder, done = f"{out}/{kind}", committed(spark, out)
    if done is None:
        return
    last = _last_merge(spark, folder)
    if last is None or done > last:
        rows = combine(read(spark, folder).filter(F.col("batch") <= done))
        if by:
            rows = rows.hint("rebalance", by)
        rows = rows.sortWithinPartitions(*([by] if by else []), *(order or []))
        # overwrites what a merge that broke off left under this number
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(_target(folder, done))
    _clear(spark, folder, done + 1)
    for number in numbered(spark, f"{folder}.merged", _UPTO):
        if number < done:
            remove(spark, _target(folder, number))


def forget(spark: SparkSession, out: str, kinds: list[str]) -> None:
    """Removes batches before the last committed one, for folders of which only the newest counts."""
    done = committed(spark, out)
    if done is not None:
        for kind in kinds:
            _clear(spark, f"{out}/{kind}", done)


def _clear(spark: SparkSession, folder: str, before: int) -> None:
    for number in numbered(spark, folder, _BATCH):
        if number < before:
            remove(spark, f"{folder}/batch={number}")
