"""Keyword search by an index of three-character pieces.

The index holds, per column that is searched, which employees have which pieces, in folders by a hash of
the piece. A search reads the folders of the keyword's pieces, keeps the employees that have all of them
in one column, and checks those few with the same pattern as ``browse.employee_search``; a piece found
in the wrong order or across a wildcard does not survive that. Keywords without three characters in a row
between wildcards have no piece; for them the index cannot tell anything and the table is read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tenurelake.operators import scale
from tenurelake.plans import browse

FOLDERS = 64
SIZE = 3


def _folder(piece: Column | str) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(FOLDERS)).cast("int")


def _pieces(text: Column) -> Column:
    last = F.length(text) - (SIZE - 1)
    starts = F.when(last > 0, F.sequence(F.lit(1), last))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(SIZE))))


def build_index(emp: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Writes the index of ``emp``; with mode ``append`` that of employees to be added to it.

    A change of an indexed text needs the employee's new pieces appended; old ones only cost a check.
    """
    columns = F.explode(F.array(*[
        F.struct(F.lit(k).alias("field"), F.lower(c).alias("text")) for k, c in enumerate(browse.SEARCHED)
    ]))
    texts = emp.select("employee_id", columns.alias("c")).filter(F.col("c.text").isNotNull())
    rows = texts.select("employee_id", "c.field", F.explode(_pieces(F.col("c.text"))).alias("piece"))
    placed = rows.withColumn("folder", _folder("piece")).hint("rebalance", "folder")
    placed.sortWithinPartitions("folder", "piece", "employee_id").write.mode(mode).partitionBy("folder").parquet(path)


def keyword_pieces(keyword: str) -> list[str]:
    """The pieces that every match of a keyword holds: those between its wildcards."""
    if "\\" in keyword:  # an escape makes the next character something else
        return []
    runs = [r.lower() for r in re.split("[%_]+", keyword)]
    return sorted({r[k : k + SIZE] for r in runs for k in range(len(r) - SIZE + 1)})


def candidates(spark: SparkSession, path: str, keyword: str) -> DataFrame | None:
    """Ids of employees that can match; None if the keyword has no piece."""
    pieces = keyword_pieces(keyword)
    if not pieces:
        return None
    index = spark.read.schema("employee_id int, field int, piece string, folder int").parquet(path)
    # the folders are worked out by the same expression that laid them out
    folders = [r[0] for r in spark.createDataFrame([(p,) for p in pieces], "piece string").select(_folder("piece")).distinct().collect()]
    held = index.filter(F.col("folder").isin(folders) & F.col("piece").isin(pieces))
    full = held.groupBy("employee_id", "field").agg(F.count_distinct("piece").alias("n")).filter(F.col("n") == len(pieces))
    return full.select("employee_id").distinct()


def search_indexed(emp: DataFrame, dept: DataFrame, keyword: str, path: str) -> DataFrame:
    """``browse.employee_search`` over the index at ``path``."""
    found = candidates(emp.sparkSession, path, keyword)
    if found is None:
        return browse.employee_search(emp, dept, keyword)
    return browse.employee_search(emp.join(scale.small(found), "employee_id", "left_semi"), dept, keyword)
