"""Merkle manifest of a dataset: one digest for all rows, and per row a proof that it belongs to it.

Leaves are digests of rows. The leaves of a part, in order, are hashed two by two, level by level, to
the part's subroot; the subroots, in the order of their parts, likewise to the root.

Proofs come from pointer jumping. Every node holds the segment of its path that leads to an ancestor:
per step whether a sibling stands left, right or nowhere, and the sibling's digest. At first the
ancestor is the parent. Joining the nodes with themselves on the ancestor doubles the distance and
concatenates the segments, until every leaf reaches its subroot: about as many joins as the logarithm of
the depth. A round needs only the nodes whose level is a multiple of the distance, so the tables shrink.
The segments from the subroots to the root are found alike and joined on the part.

Levels are hashed ``LEVELS`` at a time in groups of 2^LEVELS neighbours, which bounds a group whatever
the size of a part. Order comes from ``ordering.positions``.

Defined results: nulls of any column are hashed as ``-``; a null part is a part of its own and comes first; leaves
of one part with equal (or null, which come first) ids are ordered by their digests, and fully equal rows are leaves
each; a part of one row has that row's leaf as its subroot, one part's subroot is the root, and an empty
table has no root. Text is hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenurelake.llm.ordering import positions
from tenurelake.operators.scale import null_safe_join, small
from tenurelake.session import checkpointed

LEVELS = 8
FEW = 20_000  # nodes that are broadcast, with a path of at most 33 bytes a level
DIGEST = 32
STEP = 1 + DIGEST  # a step of a path: where the sibling stands, and its digest
ALONE, LEFT, RIGHT = "00", "01", "02"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, ``:`` and its text; ``-`` for a null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def _none() -> Column:
    return F.lit("").cast("binary")


def _depth(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n``."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _parents(level: Column) -> Column:
    at = lambda i: F.get(level, i.cast("int"))
    pairs = F.sequence(F.lit(0), F.shiftright(F.size(level) - 1, 1))
    return F.transform(pairs, lambda i: digest(at(2 * i), F.coalesce(at(2 * i + 1), F.lit(""))))


def trees(leaves: DataFrame, deepest: int) -> tuple[DataFrame, DataFrame]:
    """The trees over ``leaves`` (part, pos, n, hash): every node below a top as (part, level, idx,
    path), its path being the step to its parent, and the tops as (part, hash). Hashes are binary."""
    here, steps_of, tops_of = leaves.select("part", "n", F.col("pos").alias("idx"), "hash"), [], []
    for base in range(0, max(deepest, 1), LEVELS):
        group = F.shiftright("idx", LEVELS)
        held = here.groupBy("part", "n", group.alias("g")).agg(F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("l"))
        held = held.withColumn("l0", F.transform("l", lambda x: _hex(x.hash))).drop("l")
        for k in range(LEVELS):
            held = held.withColumn(f"l{k + 1}", _parents(F.col(f"l{k}")))

        def steps(k: int) -> Column:
            level = F.col(f"l{k}")
            sibling = lambda i: F.get(level, i.bitwiseXOR(F.lit(1)))
            side = lambda i: F.when(sibling(i).isNull(), ALONE).when(i % 2 == 1, LEFT).otherwise(RIGHT)
            step = lambda i: F.unhex(F.concat(side(i), F.coalesce(sibling(i), F.lit("00" * DIGEST))))
            first = F.shiftleft("g", LEVELS - k)
            return F.transform(level, lambda _, i: F.struct(F.lit(base + k).alias("level"), (first + i).alias("idx"), step(i).alias("path")))

        below = F.filter(F.flatten(F.array(*map(steps, range(LEVELS)))), lambda s: s.level < _depth(F.col("n")))
        reached = F.least(_depth(F.col("n")) - base, F.lit(LEVELS))
        top = F.unhex(F.get(F.array(*[F.get(f"l{k}", F.lit(0)) for k in range(LEVELS + 1)]), reached))
        held = checkpointed(held.select("part", "n", "g", below.alias("steps"), top.alias("hash")))
        steps_of.append(held.select("part", F.explode("steps").alias("s")).select("part", "s.*"))
        done = _depth(F.col("n")) <= base + LEVELS
        tops_of.append(held.filter(done).select("part", "hash"))
        here = held.filter(~done).select("part", "n", F.col("g").alias("idx"), "hash")
    for more in steps_of[1:]:
        steps_of[0] = steps_of[0].unionByName(more)
    for more in tops_of[1:]:
        tops_of[0] = tops_of[0].unionByName(more)
    return steps_of[0], tops_of[0]


def jump(nodes: DataFrame, deepest: int) -> DataFrame:
    """(part, pos, path) for every leaf of ``nodes`` (part, level, idx, path): the whole path to its top.

    Nodes that have reached their top find no ancestor and keep their path.
    """
    distance = 1
    while distance < deepest:
        inside = F.col("level") % (2 * distance)
        ancestors = nodes.filter(inside == distance).select(
            "part", (F.col("level") - distance).alias("level"), F.col("idx").alias("up"), F.col("path").alias("rest")
        )
        near = nodes.filter(inside == 0).withColumn("up", F.shiftright("idx", distance))
        joined = near.join(small(ancestors, FEW), ["part", "level", "up"], "left")
        nodes = joined.select("part", "level", "idx", F.concat("path", F.coalesce("rest", _none())).alias("path"))
        distance *= 2
        if distance < deepest:
            nodes = checkpointed(nodes)
    return nodes.filter("level = 0").select("part", F.col("idx").alias("pos"), "path")


def _proved(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves' paths to their tops, and the tops."""
    deepest = leaves.agg(F.coalesce(F.max(_depth(F.col("n"))), F.lit(0))).first()[0]
    nodes, tops = trees(leaves, deepest)
    return jump(nodes, deepest), tops


def manifest(rows: DataFrame, columns: list[str], part: str, order: str, keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``rows``: ``order``, the columns ``keep``, ``leaf``, ``subroot`` and ``root``
    as hex digests, and ``path``, the steps from the leaf to the root (see ``fold``, ``siblings``).

    A leaf is the digest of ``columns``; leaves of a ``part`` are in ascending ``order``.
    """
    named = [c.alias(n) for n, c in (keep or {}).items()]
    made = rows.select(
        F.col(f"`{part}`").alias("name"), F.col(f"`{order}`").alias("id"),
        F.unhex(leaf(*[F.col(f"`{c}`") for c in columns])).alias("hash"), F.struct(F.lit(0).alias("0"), *named).alias("kept"),
    )
    placed = positions(made, ["name"], ["id", "hash"])
    parts = placed.groupBy("name").agg(F.first("n").alias("rows"))
    numbered = checkpointed(positions(parts, [], ["name"]).select("name", F.col("pos").alias("part"), F.col("n").alias("parts")))
    leaves = null_safe_join(placed, small(numbered, FEW), ["name"])
    paths, tops = _proved(leaves)
    above, root = _proved(tops.join(numbered, "part").select(F.lit(0).alias("part"), F.col("part").alias("pos"), F.col("parts").alias("n"), "hash"))
    found = root.first()
    upper = tops.select("part", F.col("hash").alias("subroot")).join(
        above.select(F.col("pos").alias("part"), F.col("path").alias("rest")), "part", "left"
    )
    done = leaves.join(paths, ["part", "pos"], "left").join(small(upper, FEW), "part")
    return done.select(
        F.col("id").alias(order), *[F.col(f"kept.`{c}`") for c in keep or {}], _hex(F.col("hash")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"), F.lit(found and bytes(found["hash"]).hex()).alias("root"),
        F.concat(F.coalesce("path", _none()), F.coalesce("rest", _none())).alias("path"),
    )


def _steps(path: Column) -> Column:
    """The steps of a path as structs of ``side`` and ``sibling`` (hex)."""
    n = F.call_function("div", F.octet_length(path), F.lit(STEP)).cast("int")
    starts = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: i * STEP + 1)).otherwise(F.array().cast("array<int>"))
    cut = lambda at, size: _hex(F.substring(path, at, F.lit(size)))
    return F.transform(starts, lambda s: F.struct(cut(s, 1).alias("side"), cut(s + 1, DIGEST).alias("sibling")))


def fold(leaf_hex: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path give."""
    up = lambda h, s: digest(
        F.when(s.side == LEFT, s.sibling).otherwise(F.lit("")), h, F.when(s.side == RIGHT, s.sibling).otherwise(F.lit(""))
    )
    return F.aggregate(_steps(path), leaf_hex, up)


def siblings(path: Column) -> Column:
    """The siblings of a path as an array of hex digests, from the leaf upwards."""
    return F.transform(F.filter(_steps(path), lambda s: s.side != ALONE), lambda s: s.sibling)
