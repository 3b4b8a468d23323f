"""Helpers shared by the query catalogue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F, types as T

AS_OF = dt.date(2001, 9, 1)
YEAR = 2000


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types every engine shares: money as double, lists of texts as one text."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "; ").alias(f.name)
        out.append(c)
    return df.select(*out)


def half_up(num: str, den: str, k: int = 0) -> str:
    """Oracle form of the exact rounding: whole steps of 10^-k."""
    return f"cast((2 * ({num}) * {10**k} + ({den})) // (2 * ({den})) as bigint)"


def avg2(num: str, den: str, k: int = 2) -> str:
    return f"cast({half_up(num, den, k)} as double) / {10**k}"
