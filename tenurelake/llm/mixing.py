"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of a hash, form blocks. Time is a row of slots of one block
each. Block i of a source with weight w is released at floor(i / w) and due at ceil((i + 1) / w), and
in every slot the released block that is due first is taken. Weights are exact: whole numbers in the
proportion of the given ones. At every moment each source that has not run out has had its weight's
share of the slots, off by less than one block, however long the run is.

No row is dropped or repeated. Where a source has run out, its slots stay empty and the others keep
their proportions. Sources are numbered in ranges of the hash, so one that holds a third of all rows
is spread over many tasks; only counts per range are put in order. Which block comes next depends on
all before it, so the slots of blocks, one row for ``BLOCK`` documents, are worked out one after the
other: by the driver up to ``DRIVER_BLOCKS`` of them, else by one task that hands them on as it goes.

Defined results: a null source is a source of its own; sources without a weight, or with a null or
negative one, get one slot of a period each, and the others their exact proportions of the rest;
equal rows have neighbouring places; an empty table gives no rows. More than ``MAX_SOURCES`` sources
are refused.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tenurelake.llm.common import free_name, parallel
from tenurelake.operators.scale import small

BLOCK = 32  # documents
PERIOD = 4096  # slots, of which a source without a weight gets one
DRIVER_BLOCKS = 500_000
MAX_SOURCES = 2048
RANGE_ROWS = 1024
NO_SOURCE = "\0"


def proportion(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole numbers in the exact proportion of the weights. Sources of weight zero get one slot of the
    period each, but no more than half of it together."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    total = sum(exact.values())
    idle = [s for s in exact if not exact[s]]
    if total and idle:
        least = min(Fraction(1, period), Fraction(1, 2 * len(idle)))
        exact = {s: w / total * (1 - least * len(idle)) if w else least for s, w in exact.items()}
    elif not total:
        exact = dict.fromkeys(exact, Fraction(1))
    scale = math.lcm(*(w.denominator for w in exact.values()))
    units = {s: int(w * scale) for s, w in exact.items()}
    shared = math.gcd(*units.values()) or 1
    return {s: n // shared for s, n in units.items()}


def parts(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole parts of the period in proportion to the weights, largest remainders first; a source whose
    part would be zero gets one, and the others share the rest."""
    exact = proportion(weights, period)
    small: set[str] = set()
    while True:
        rest = period - len(small)
        total = sum(n for s, n in exact.items() if s not in small)
        share = {s: Fraction(1) if s in small else Fraction(n * rest, total) for s, n in exact.items()}
        out = {s: math.floor(share[s]) for s in sorted(exact)}
        for s in sorted(exact, key=lambda s: (out[s] - share[s], s))[: period - sum(out.values())]:
            out[s] += 1
        lacking = {s for s, n in out.items() if not n}
        if not lacking:
            return out
        small |= lacking


def blocks(units: dict[str, int], held: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """The earliest-deadline-first schedule of ``held`` blocks per source, whose weights are in the
    proportion of ``units``: (source, block, release, deadline, slot) in the order of slots."""
    period = sum(units.values())
    due = lambda s, i: -(-(i + 1) * period // units[s])
    waiting = [(0, s, 0) for s in sorted(units) if held[s]]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])  # slots of sources that have run out
        while waiting and waiting[0][0] <= slot:
            release, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (due(s, i), s, i, release))
        deadline, s, i, release = heapq.heappop(ready)
        yield s, i, release, deadline, slot
        if i + 1 < held[s]:
            heapq.heappush(waiting, ((i + 1) * period // units[s], s, i + 1))
        slot += 1


def schedule(units: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """One period of the schedule, after which it repeats: as many blocks of each source as its units."""
    return list(blocks(units, units))


def tempered(counts: dict[str, int], exponent: float = 0.5) -> dict[str, float]:
    """Weights that favour small sources: counts to a power below one."""
    return {s: float(n) ** exponent for s, n in counts.items()}


def source_counts(docs: DataFrame, source: str = "source") -> dict[str, int]:
    """Documents per source; a null source is named ``NO_SOURCE``."""
    name = F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(NO_SOURCE))
    found = docs.groupBy(name.alias("s")).count().limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return {r["s"]: r["count"] for r in found}


def place(
    docs: DataFrame, weights: dict[str, float] | None = None, source: str = "source", block: int = BLOCK, period: int = PERIOD,
) -> tuple[DataFrame, str]:
    """``docs`` with a struct column, whose name is returned: the document's ``block`` of its source,
    ``turn`` inside it, ``release``, ``deadline`` and ``slot``. Without weights they are tempered counts."""
    counts = source_counts(docs, source)
    wanted = tempered(counts) if weights is None else {s: max(0.0, weights.get(s) or 0.0) for s in counts}
    units = proportion(wanted, period) if counts else {}
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{source}`").alias("source"))
    out = free_name(docs, "_place")
    spark = docs.sparkSession
    if not counts:
        kind = "struct<block:bigint,turn:bigint,release:bigint,deadline:bigint,slot:bigint>"
        return docs.withColumn(out, F.lit(None).cast(kind)), out

    bits = max(0, math.ceil(math.log2(max(counts.values()) / RANGE_ROWS)))
    whole = F.xxhash64(*[F.col(f"row.`{c}`").cast("string") for c in docs.columns])
    ranged = row.select(
        "row", F.coalesce(F.col("source").cast("string"), F.lit(NO_SOURCE)).alias("name"), whole.alias("hash")
    ).withColumn("range", F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("long"))
    held = ranged.groupBy("name", "range").agg(F.count(F.lit(1)).alias("n"))
    along = W.partitionBy("name").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    before = held.select("name", "range", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("name", "range").orderBy("hash")) - 1
    ranked = ranged.withColumn("inside", inside).join(small(before), ["name", "range"]).select(
        "row", "name", (F.col("before") + F.col("inside")).alias("rank")
    )
    timed = ranked.withColumn("block", F.floor(F.col("rank") / block)).join(
        _slots(spark, units, {s: -(-n // block) for s, n in counts.items()}),
        (F.col("name") == F.col("of")) & (F.col("block") == F.col("i")),
    )
    placed = F.struct(F.col("block"), (F.col("rank") % block).alias("turn"), "release", "deadline", "slot")
    return timed.select("row.*", placed.alias(out)), out


def _slots(spark: SparkSession, units: dict[str, int], held: dict[str, int]) -> DataFrame:
    """``blocks`` as a table; one that is broadcast where the driver can work it out."""
    schema = pa.schema([("of", pa.string()), *[(c, pa.int64()) for c in ("i", "release", "deadline", "slot")]])

    def worked_out(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batched(blocks(units, held), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)

    if sum(held.values()) <= DRIVER_BLOCKS:
        return F.broadcast(spark.createDataFrame(pa.Table.from_batches(worked_out(iter(())), schema)))
    one = spark.range(0, 1, 1, 1).mapInArrow(worked_out, "of string, i long, release long, deadline long, slot long")
    return one.hint("merge")  # Spark takes it for a single row


def mix(docs: DataFrame, weights: dict[str, float] | None = None, source: str = "source", block: int = BLOCK, period: int = PERIOD) -> DataFrame:
    """``docs`` in the order of the schedule: partitions are consecutive stretches of it, each sorted,
    so written files keep the mixture."""
    placed, at = place(docs, weights, source, block, period)
    order = [f"{at}.slot", f"{at}.turn"]
    return placed.repartitionByRange(parallel(docs), *order).sortWithinPartitions(*order).drop(at)
