"""SimHash near-duplicates: fingerprints linked by meet-in-the-middle ball hashing.

Two fingerprints within a radius of 3 meet if each emits all its variants within half the radius.
The radius is odd, so the halves are 1 and 2, and the larger ball has 2,081 variants. To get by with
balls of radius 1, the 64 bits are cut into 4 blocks, and one block is blanked out at a time: two
fingerprints that differ in up to 3 bits differ in at most 2 outside some block, and there each
reaches a common variant by flipping one bit. A fingerprint emits 4 x 49 variants. They are shuffled
on the variant, and colliding fingerprints are compared; which block was blank need not be told, as
the few that meet by chance do not survive the comparison.

Fingerprints that collide with more than ``CROWD`` others on one variant are not compared pair by
pair. All of them emit the full balls: *home* variants within one bit, and *away* variants two bits
off. Whoever meets a home fingerprint on a variant is at most 3 bits from it, so one link to the first
of them suffices, and work stays in proportion to the fingerprints. Every pair in reach is either
compared or meets in that second round; nothing is capped.

Copies of a text have one fingerprint and are reduced to it first. Links go through
``components``; the rows of a result come from joins on the fingerprint.

Defined results: a null text, an empty one and one of white space have fingerprint 0 and are linked
like any other; one or two words are a single shingle. Rows with a null id get a component, which is
null where no member has an id. Repeated ids are kept row by row. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tenurelake.llm.common import free_name, parallel
from tenurelake.llm.components import components
from tenurelake.session import checkpointed

SHINGLE = 3
RADIUS = 3
BLOCKS = 4
CROWD = 512  # comparing is cheaper than the full balls for fewer
SEED = 42
_STEP = 1 << 15  # shingles whose bits are spread out at a time


def fingerprint_of(text: str | None) -> int:
    """64-bit SimHash of a whole text over the hashes of its word shingles, as a signed number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles, n = [b" ".join(words)], 1
    else:
        n = len(words) - SHINGLE + 1
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _STEP):
        part = hashes[at : at + _STEP].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")


def fingerprint(text: str = "text") -> Column:
    return _fingerprint(F.col(f"`{text}`"))


def hex_text(fp: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _blocks() -> np.ndarray:
    """For every variant of one fingerprint the bits to keep and to flip."""
    width = 64 // BLOCKS
    keep, flip = [], []
    for b in range(BLOCKS):
        blank = ((1 << width) - 1) << (b * width)
        for bit in [None, *(k for k in range(64) if not blank >> k & 1)]:
            keep.append(~blank & (2**64 - 1))
            flip.append(0 if bit is None else 1 << bit)
    return np.array([keep, flip], dtype=np.uint64)


def _emit(fps: pa.Array, keep: np.ndarray, flip: np.ndarray, kind: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    values = fps.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    for at in range(0, len(values), 512):
        part = values[at : at + 512]
        variants = ((part[:, None] & keep) ^ flip).view(np.int64).ravel()
        columns = {"variant": variants, "fp": np.repeat(part.view(np.int64), len(keep))}
        if kind is not None:
            columns["kind"] = np.tile(kind, len(part))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keep, flip = _blocks()
    for b in batches:
        yield from _emit(b.column(0), keep, flip)


def _balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    one = [0, *(1 << k for k in range(64))]
    two = [1 << i | 1 << j for i in range(64) for j in range(i)]
    kind = np.array([0] * len(one) + [1] * len(two), dtype=np.int8)
    flip = np.array(one + two, dtype=np.uint64)
    for b in batches:
        yield from _emit(b.column(0), np.full(len(flip), 2**64 - 1, dtype=np.uint64), flip, kind)


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of batches sorted by the first one, cut so that no run of equal values is split. A run
    is bounded by the fingerprints in reach of one variant."""
    held: list[np.ndarray] | None = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)]
        if held is not None:
            cols = [np.concatenate(p) for p in zip(held, cols)]
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        held = [c[cut:] for c in cols]
        if cut:
            yield [c[:cut] for c in cols]
    if held is not None:
        yield held


def _least_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For 0..n-1 the least number that the pairs (a, b) connect it with."""
    least = np.arange(n)
    while (least[a] != least[b]).any():
        low = np.minimum(least[a], least[b])
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        least = least[least]
    return least


def _compare(crowd: int):
    """Compares the fingerprints on one variant and links each to the first it is connected with, so
    there are fewer links than fingerprints; (u, u) marks a member of a crowd."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for variant, fp in _runs(batches):
            new = np.ones(len(fp), dtype=bool)
            new[1:] = variant[1:] != variant[:-1]
            run = np.cumsum(new) - 1
            crowded = np.bincount(run)[run] > crowd
            crowd_fps, fp, run = fp[crowded], fp[~crowded], run[~crowded]
            left, right, at = [], [], np.arange(len(fp))
            for d in range(1, crowd):
                at = at[at + d < len(fp)]
                at = at[run[at + d] == run[at]]
                if not len(at):
                    break
                near = at[_bits(fp[at] ^ fp[at + d]) <= RADIUS]
                left.append(near)
                right.append(near + d)
            if left:
                least = _least_linked(len(fp), np.concatenate(left), np.concatenate(right))
                linked = np.flatnonzero(fp[least] != fp)  # a fingerprint can reach a variant twice
                pairs = np.stack([fp[linked], fp[least[linked]]])
            else:
                pairs = np.zeros((2, 0), dtype=np.int64)
            links = np.unique(np.concatenate([pairs, np.stack([crowd_fps] * 2)], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(links[0]), pa.array(links[1])], ["u", "v"])

    return compare


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links every fingerprint on a variant to the first that is at home there, if there is one."""
    for variant, fp, kind in _runs(batches):
        new = np.ones(len(fp), dtype=bool)
        new[1:] = variant[1:] != variant[:-1]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        linked = (kind[first] == 0) & (fp != fp[first])
        links = np.unique(np.stack([fp[linked], fp[first][linked]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(links[0]), pa.array(links[1])], ["u", "v"])


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (u, v) that connect exactly the distinct fingerprints ``fp`` that chains of steps of at
    most ``RADIUS`` bits connect."""
    emitted = "variant long, fp long"
    spread = lambda df, order: df.repartition(parallel(df), "variant").sortWithinPartitions(*order)
    variants = fps.select("fp").mapInArrow(_masked, emitted)
    met = checkpointed(spread(variants, ["variant"]).mapInArrow(_compare(crowd), "u long, v long").distinct())
    crowded = met.filter("u = v").select(F.col("u").alias("fp"))
    balls = crowded.repartition(parallel(fps), "fp").mapInArrow(_balls, f"{emitted}, kind byte")
    through = spread(balls, ["variant", "kind", "fp"]).mapInArrow(_meet, "u long, v long")
    return met.filter("u <> v").unionByName(through)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[Column] | None = None, crowd: int = CROWD) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the columns ``keep``, ``fp`` and ``component_id``, the smallest
    id that chains of links reach."""
    rows = checkpointed(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), *(keep or []), fingerprint(text).alias("fp")))
    firsts = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    return _named(rows, firsts, links(firsts, crowd))


def _named(rows: DataFrame, firsts: DataFrame, found: DataFrame) -> DataFrame:
    roots = components(found).withColumnRenamed("node", "fp")
    rooted = firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # written, so that the join below has two plain sides and a root with very many members is split
    least = checkpointed(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    named = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id, of equal
    ids the one with the smallest hash of all columns. Fully equal rows are reduced before the shuffle."""
    whole, held, row = free_name(docs, "_whole"), free_name(docs, "_id"), free_name(docs, "_row")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole_hash = F.xxhash64(*[c.cast("string") for c in columns])
    key = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(0).cast("long"))
    found = near_duplicates(docs, text, doc_id, [whole_hash.alias("whole"), key.alias("held")])
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp"))]
    first = F.min(F.struct(F.col("doc_id").isNull(), "held", "whole")).alias("r")
    chosen = found.groupBy(*group).agg(first).select(F.col("r.whole").alias(whole), F.col("r.held").alias(held))
    once = docs.select(whole_hash.alias(whole), key.alias(held), F.struct(*columns).alias(row))
    once = once.groupBy(whole, held).agg(F.first(row).alias(row))
    return once.join(chosen, [whole, held], "left_semi").select(f"{row}.*")
