"""Ranking, numbering and neighbour look-ups whose largest task does not grow with one group.

A plain window sorts a whole group in one task. Here a group is cut into pieces first, the pieces
are worked on separately, and only one small row per piece is put in order.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tenurelake.session import checkpointed

# Keys with more rows than this are cut into segments; smaller ones fit one sorted task.
HOT_ROWS = 2_000_000

TASK_ROWS = 100_000  # short segments share a task until it holds about this many rows

BLOCK_BITS = 16  # a block holds at most 65,536 different keys
TOP_BITS = 20  # and at most 2^20 blocks are put in order by one task


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where NULL matches NULL; the sides share no other column names."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    same = None
    for c in on:
        one = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        same = one if same is None else same & one
    return left.join(renamed, same, how).drop(*[f"_r_{c}" for c in on])


def small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """``df`` marked for broadcast if a count stopped at ``max_rows`` shows it fits; else as it is,
    and the join shuffles."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, a side as large as a table of employees or reviews, marked for a sort-merge join.

    Spark takes a side's size from its compressed files and the share of its columns, and would send many
    times its broadcast limit through the driver.
    """
    return df.hint("merge")


def prefix_sum(counts: DataFrame, key: str, n: str, out: str = "before", bits: int = 64) -> DataFrame:
    """Adds ``out``: the sum of ``n`` over all smaller values of the unique whole-number column ``key``.

    Keys are grouped by their upper bits, level by level, until at most 2^20 groups are left to put
    in order; each window below that sees at most 65,536 rows.
    """
    if bits <= TOP_BITS:
        return counts.withColumn(out, F.sum(n).over(W.orderBy(key)) - F.col(n))
    block, held, offset, inside = (f"_{name}{bits}" for name in ("block", "held", "offset", "inside"))
    blocked = counts.withColumn(block, F.shiftright(F.col(key).cast("bigint"), BLOCK_BITS))
    blocks = blocked.groupBy(block).agg(F.sum(n).alias(held))
    offsets = prefix_sum(blocks, block, held, offset, bits - BLOCK_BITS).drop(held)
    local = F.sum(n).over(W.partitionBy(block).orderBy(key)) - F.col(n)
    return (
        blocked.withColumn(inside, local).join(offsets, block)
        .withColumn(out, F.col(inside) + F.col(offset)).select(*counts.columns, out)
    )


def _blocks(df: DataFrame, id_col: str, part: list[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` with its ``_block`` (the upper bits of the id), and the row count ``_n`` per block."""
    blocked = df.withColumn("_block", F.shiftright(F.col(id_col).cast("bigint"), BLOCK_BITS))
    return blocked, blocked.groupBy(*part, "_block").agg(F.count(F.lit(1)).alias("_n"))


def dense_numbers(
    df: DataFrame, id_col: str, out: str = "rn", ties: list[str] | None = None
) -> DataFrame:
    """Adds ``out``: 1..n in ``id_col`` order, without one task seeing all rows.

    ``id_col`` is a whole number, never NULL and (nearly) unique, so one block of 2^16 ids is a
    bounded group; ``ties`` orders equal ids. Blocks of a 64-bit id are put in order level by level.
    """
    bits = 64 if dict(df.dtypes)[id_col] == "bigint" else 32
    blocked, blocks = _blocks(df, id_col, [])
    offsets = prefix_sum(blocks, "_block", "_n", "_before", bits - BLOCK_BITS).drop("_n")
    local = F.row_number().over(W.partitionBy("_block").orderBy(id_col, *(ties or [])))
    return (
        blocked.withColumn("_local", local).join(offsets, "_block")
        .withColumn(out, F.col("_local") + F.col("_before")).select(*df.columns, out)
    )


def distributed_ntile(
    df: DataFrame, score: str, id_col: str, n: int = 4, out: str = "quartile",
    ties: list[str] | None = None,
) -> DataFrame:
    """``ntile(n)`` over (score descending, id) for a whole-number score and a 32-bit id.

    Rows of one score are numbered block by block, so any number of rows may share a score. Only
    the block counts, at most 65,536 per score, are put in order by one task; ``score`` must be a
    scale of few values. A wider id would put too many blocks of a score in one task and is refused.
    """
    if dict(df.dtypes)[id_col] not in ("tinyint", "smallint", "int"):
        raise TypeError(f"{id_col} is no whole number of at most 32 bits")
    blocked, blocks = _blocks(df, id_col, [score])
    along = W.orderBy(F.col(score).desc(), "_block")
    offsets = blocks.select(
        score, "_block", (F.sum("_n").over(along) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(W.partitionBy()).alias("_total"),
    )
    local = F.row_number().over(W.partitionBy(score, "_block").orderBy(id_col, *(ties or [])))
    place = F.col("_local") + F.col("_offset") - 1
    size, extra = F.call_function("div", F.col("_total"), F.lit(n)), F.col("_total") % n
    wide = extra * (size + 1)  # rows in the tiles that hold one row more
    tile = F.when(F.col("_p") < wide, F.call_function("div", F.col("_p"), size + 1)).otherwise(
        extra + F.call_function("div", F.col("_p") - wide, F.greatest(size, F.lit(1)))
    )
    return (
        blocked.withColumn("_local", local).join(offsets, [score, "_block"])
        .withColumn("_p", place).withColumn(out, (tile + 1).cast("int"))
        .select(*df.columns, out)
    )


def value_ranks(df: DataFrame, part: list[str], value: str) -> DataFrame:
    """One row per (part, value): its count ``n``, the rows ``before`` it, and of the whole part the
    row count ``total``, the sum ``value_sum`` and the non-NULL count ``value_n``.

    Equal values are merged before any ordering, so a value shared by a third of all rows is one row.
    ``value`` is a whole number of at most 36 bits, as DECIMAL(10,2) cents are: a part has at most
    2^18 blocks, each of at most 2^18 different values, whatever its size. A larger value fails the query.
    """
    fits = F.col(value).isNull() | F.col(value).between(-(2**36), 2**36 - 1)
    block = F.when(fits, F.shiftright(F.col(value), 18)).otherwise(F.raise_error(F.lit("value beyond 36 bits")))
    counts = df.groupBy(*part, value).agg(F.count(F.lit(1)).alias("n")).withColumn("_block", block)
    known = F.when(F.col(value).isNotNull(), F.col("n"))
    blocks = counts.groupBy(*part, "_block").agg(
        F.sum("n").alias("_m"), F.sum(F.col(value) * F.col("n")).alias("_s"), F.sum(known).alias("_k")
    )
    whole, along = W.partitionBy(*part), W.partitionBy(*part).orderBy("_block")
    offsets = blocks.select(
        *part, "_block", (F.sum("_m").over(along) - F.col("_m")).alias("_offset"),
        F.sum("_m").over(whole).alias("total"), F.sum("_s").over(whole).alias("value_sum"),
        F.sum("_k").over(whole).alias("value_n"),
    )
    inside = F.sum("n").over(W.partitionBy(*part, "_block").orderBy(value)) - F.col("n")
    return (
        null_safe_join(counts.withColumn("_inside", inside), offsets, [*part, "_block"])
        .withColumn("before", F.col("_inside") + F.col("_offset"))
        .drop("_inside", "_offset", "_block")
    )


def percentiles(
    df: DataFrame, part: list[str], value: str, points: dict[str, float]
) -> DataFrame:
    """Exact linearly interpolated percentiles per part, in units of ``value``."""
    known = df.filter(F.col(value).isNotNull())
    ranks = value_ranks(known, part, value)
    aggs = []
    for name, q in points.items():
        at = (F.col("total") - 1) * F.lit(q)
        for side, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("before") <= pos) & (pos < F.col("before") + F.col("n"))
            aggs.append(F.max(F.when(holds, F.col(value))).alias(f"{name}_{side}"))
    grouped = ranks.groupBy(*part, "total").agg(*aggs)
    for name, q in points.items():
        at = (F.col("total") - 1) * F.lit(q)
        lo, hi = F.col(f"{name}_lo").cast("double"), F.col(f"{name}_hi").cast("double")
        grouped = grouped.withColumn(name, lo + (hi - lo) * (at - F.floor(at)))
    return grouped.select(*part, F.col("total"), *points)


def top_n_per_group(
    df: DataFrame, part: list[str], order: list[str], limit: int, out: str
) -> DataFrame:
    """Rows whose dense rank over ``order`` (all descending) within ``part`` is at most ``limit``.

    Ranks are taken over distinct order values, where dense rank equals row number; Spark keeps
    ``limit`` of them per part and task before the shuffle. Tied rows are then joined back, so
    however many rows tie, no task holds them all. ``df`` is written once for the two.
    """
    df = checkpointed(df)
    keys = df.select(*part, *order).distinct()
    window = W.partitionBy(*part).orderBy(*[F.col(c).desc() for c in order])
    best = keys.withColumn(out, F.row_number().over(window)).filter(F.col(out) <= limit)
    return null_safe_join(df, small(best), [*part, *order])


def first_per_key(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """The first (or last) row of every key in ``order``; an aggregate, so copies of one key are
    reduced before the shuffle and never gathered."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[c for c in order if c not in keys], *rest)
    picked = df.groupBy(*keys).agg((F.max if last else F.min)(row).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> tuple[DataFrame, int]:
    """Keys with more than ``hot_rows`` rows, and how many rows they have together."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    if counted.limit(1).count() == 0:  # as nearly always: nothing to write, nothing to join
        return counted.select(*keys), 0
    # columns of its own, as it is joined back to the rows it comes from
    found = checkpointed(counted.select(*[F.col(c).alias(c) for c in keys], "_n"))
    return found.select(*keys), found.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]


def ordered_segments(df: DataFrame, keys: list[str], order: list[str], rows: int, held: int) -> DataFrame:
    """The ``held`` rows of ``df`` cut into runs of ``rows`` at most, numbered ``_seg`` in (keys, order) order.

    A task sorts about ``TASK_ROWS`` rows (``rows``, if more) and cuts them, so tasks grow in number with
    the rows and not with the segments, however short these are. Partitions stay sorted and hold whole
    segments; between two partitions numbers are left out. Range bounds come from a sample and could differ
    if a lost task were run again, so the numbered rows are checkpointed before anything depends on them.
    """
    rows = max(rows, 1)
    pieces = max(2, math.ceil(held / max(rows, TASK_ROWS)))
    cut = df.repartitionByRange(pieces, *keys, *order).sortWithinPartitions(*keys, *order)
    # the id has the partition in its upper bits and the row within it in its lower 33
    return checkpointed(cut.withColumn("_seg", F.call_function("div", F.monotonically_increasing_id(), F.lit(rows))))


def split_by_heat(
    df: DataFrame, keys: list[str], order: list[str], hot_rows: int,
    cold: Callable[[DataFrame], DataFrame], hot: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``cold`` on ordinary keys, ``hot`` on the segments of the oversized ones, together."""
    big, held = hot_keys(df, keys, hot_rows)
    if not held:
        return cold(df)
    big = small(big)
    calm = null_safe_join(df, big, keys, "left_anti")
    heavy = ordered_segments(null_safe_join(df, big, keys, "left_semi"), keys, order, hot_rows, held)
    return cold(calm).unionByName(hot(heavy))


def over_sequence(
    df: DataFrame, keys: list[str], order: list[str], hot_rows: int = HOT_ROWS, *,
    lag: dict[str, Column] | None = None, lead: dict[str, Column] | None = None,
    fill: dict[str, Column] | None = None,
) -> DataFrame:
    """Adds columns that look along each key's rows in ascending ``order``.

    ``lag`` / ``lead``: the value on the previous / next row; ``fill``: the last non-NULL value up to
    this row. Oversized keys are computed segment by segment with one carried row per segment.
    """
    lag, lead, fill = lag or {}, lead or {}, fill or {}

    def cold(part: DataFrame) -> DataFrame:
        w = W.partitionBy(*keys).orderBy(*order)
        upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
        return part.withColumns(
            {o: F.lag(e).over(w) for o, e in lag.items()}
            | {o: F.lead(e).over(w) for o, e in lead.items()}
            | {o: F.last(e, ignorenulls=True).over(upto) for o, e in fill.items()}
        )

    def hot(part: DataFrame) -> DataFrame:
        at = [*keys, "_seg"]
        w = W.partitionBy(*at).orderBy(*order)
        upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
        place = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
        edge = {f"_e_{o}": F.max(F.struct(*place, e.alias("_v"))) for o, e in lag.items()}
        edge |= {f"_e_{o}": F.min(F.struct(*place, e.alias("_v"))) for o, e in lead.items()}
        edge |= {
            f"_e_{o}": F.max(F.when(e.isNotNull(), F.struct(*place, e.alias("_v"))))
            for o, e in fill.items()
        }
        edges = part.groupBy(*at).agg(*[e.alias(o) for o, e in edge.items()])
        along = W.partitionBy(*keys).orderBy("_seg")
        past = along.rowsBetween(W.unboundedPreceding, -1)
        carried = edges.select(
            *at,
            *[F.lag(f"_e_{o}").over(along).alias(f"_c_{o}") for o in lag],
            *[F.lead(f"_e_{o}").over(along).alias(f"_c_{o}") for o in lead],
            *[F.last(f"_e_{o}", ignorenulls=True).over(past).alias(f"_c_{o}") for o in fill],
        )
        near = part.withColumns(
            {f"_l_{o}": F.lag(F.struct(e.alias("_v"))).over(w) for o, e in lag.items()}
            | {f"_l_{o}": F.lead(F.struct(e.alias("_v"))).over(w) for o, e in lead.items()}
            | {f"_l_{o}": F.last(e, ignorenulls=True).over(upto) for o, e in fill.items()}
        )
        joined = null_safe_join(near, carried, at)
        outs = {
            o: F.when(F.col(f"_l_{o}").isNotNull(), F.col(f"_l_{o}._v")).otherwise(F.col(f"_c_{o}._v"))
            for o in [*lag, *lead]
        } | {o: F.coalesce(F.col(f"_l_{o}"), F.col(f"_c_{o}._v")) for o in fill}
        return joined.withColumns(outs).select(*df.columns, *outs)

    return split_by_heat(df, keys, order, hot_rows, cold, hot)
