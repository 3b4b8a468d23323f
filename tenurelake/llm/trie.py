"""Prefix trie of conversations: every distinct beginning is a node with figures of its subtree.

The turn ids of a conversation are laid out as columns, ``WIDTH`` to a row, and one SQL ``ROLLUP`` over
these columns groups all conversations by all their prefixes at once; ``grouping_id`` tells how long a
prefix is. A longer conversation continues in further rows of as many columns, whose rollup is keyed by
the node at which the row before it ended. A node is known by its depth and a 128-bit key, the
exclusive-or of a hash of (place, turn id) over its turns, so the key of the node before any row follows
from a running aggregate, all rows are rolled up in one job, and a node's parent is one look-up away.

Figures of subtrees are sums of a second rollup, over the nodes' own columns. What hangs below the last
column of a row is added first: the totals of all rows are carried to the rows before them, twice as far
in each round.

No conversation, node or group of copies is gathered: conversations are numbered in ranges, rows are
made of at most ``WIDTH`` turns, rollups pre-aggregate before they shuffle, and running aggregates work
on ``RUN`` rows of a conversation at a time. Only the digest of the conversations that end at one node
passes through one task, id by id, as SHA-256 has to.

Defined results: a null role or text is empty; turns are ordered by ``turn``, nulls first, and ties by
their content, repeated rows being turns each; rows without a conversation id take no part; a
conversation without turns is a member of the root alone; without any conversation there is no node.
Texts count whole, by their words and their digest. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tenurelake.llm.ordering import positions
from tenurelake.session import checkpointed

WIDTH = 8
RUN = 4096
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "k1", "k2"]


def ordered_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, n, turn_id, words): the turns of every conversation by their place, 0 being the first."""
    filled = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    who = filled(role)
    content = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, filled(text))
    turns = rows.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.substring(F.sha2(content.cast("binary"), 256), 1, 32)).alias("turn_id"),
        F.regexp_count(filled(text), F.lit(WORD)).cast("long").alias("words"),
    ).filter("conv_id is not null")
    return positions(turns, ["conv_id"], ["turn", "turn_id"]).drop("turn")


def _marks(place: Column, turn_id: Column) -> tuple[Column, Column]:
    return F.xxhash64(place, turn_id), F.xxhash64(turn_id, place, F.lit("trie"))


def _xor(values: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), values)


def _rows(turns: DataFrame, turnless: DataFrame | None, width: int) -> DataFrame:
    """Rows of ``width`` turns: conv_id, row, p1, p2 (key of the node before), t0.., w0.., held, x1, x2."""
    row = F.call_function("div", F.col("pos"), F.lit(width))
    one, two = _marks(F.col("pos").cast("long"), F.col("turn_id"))
    told = turns.select("conv_id", "turn_id", "words", (F.col("pos") % width).alias("slot"), row.alias("row"), one.alias("e1"), two.alias("e2"))
    told = told.withColumn("run", F.call_function("div", F.col("row"), F.lit(RUN))).repartition("conv_id", "run")
    at = lambda k, c: F.max(F.when(F.col("slot") == k, F.col(c)))
    laid = told.groupBy("conv_id", "run", "row").agg(
        *[at(k, "turn_id").alias(f"t{k}") for k in range(width)], *[at(k, "words").alias(f"w{k}") for k in range(width)],
        F.count(F.lit(1)).alias("held"), F.bit_xor("e1").alias("x1"), F.bit_xor("e2").alias("x2"),
    )
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    runs = laid.groupBy("conv_id", "run").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    along, inside = before(W.partitionBy("conv_id").orderBy("run")), before(W.partitionBy("conv_id", "run").orderBy("row"))
    nothing = F.lit(0).cast("long")
    so_far = lambda x, w: F.coalesce(F.bit_xor(x).over(w), nothing)
    carried = runs.select("conv_id", "run", so_far("x1", along).alias("c1"), so_far("x2", along).alias("c2"))
    keyed = laid.withColumns({"p1": so_far("x1", inside), "p2": so_far("x2", inside)}).join(carried, ["conv_id", "run"])
    columns = [f"t{k}" for k in range(width)] + [f"w{k}" for k in range(width)]
    rows = keyed.select(
        "conv_id", "row", F.col("p1").bitwiseXOR(F.col("c1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("c2")).alias("p2"),
        *columns, "held", "x1", "x2",
    )
    if turnless is not None:
        none = {"row": 0, "p1": 0, "p2": 0, "held": 0, "x1": 0, "x2": 0}
        types = dict(rows.dtypes)
        rows = rows.unionByName(turnless.select(
            "conv_id", *[F.lit(none.get(c)).cast(types[c]).alias(c) for c in rows.columns if c != "conv_id"]
        ))
    return checkpointed(rows)


def _rollup(rows: DataFrame, width: int, figures: str) -> DataFrame:
    """``figures`` per prefix of the columns t0.. of rows with one node before them; ``level`` is its length."""
    columns = ", ".join(f"t{k}" for k in range(width))
    return rows.sparkSession.sql(
        f"select row, p1, p2, {columns}, {width} - bit_count(grouping_id()) as level, {figures}"
        f" from {{rows}} group by row, p1, p2, rollup({columns})",
        rows=rows,
    )


def _nodes(rows: DataFrame, width: int) -> DataFrame:
    longest = ", ".join(f"max(w{k}) as w{k}" for k in range(width))  # texts of one turn id have equal counts
    found = _rollup(rows, width, f"min(conv_id) as conv_id, count(1) as n_convs, {longest}")
    last = lambda c: F.get(F.array(*[f"{c}{k}" for k in range(width)]), F.col("level") - 1)
    level = F.col("level")
    found = found.filter(((level == 0) & (F.col("row") == 0)) | ((level > 0) & last("t").isNotNull()))
    key = {}
    for lane in (0, 1):
        marks = [
            (k, _marks((F.col("row") * width + k).cast("long"), F.col(f"t{k}"))[lane]) for k in range(width)
        ]
        part = lambda upto: _xor([F.col(f"p{lane + 1}"), *[F.when(upto > k, m).otherwise(F.lit(0).cast("long")) for k, m in marks]])
        key |= {f"k{lane + 1}": part(level), f"up{lane + 1}": part(level - 1)}
    words = F.when(level > 0, last("w")).otherwise(0)
    return checkpointed(found.withColumns(
        {"depth": (F.col("row") * width + level).cast("long"), "saved": (F.col("n_convs") - 1) * words} | key
    ).select("row", "p1", "p2", *[f"t{k}" for k in range(width)], "level", "conv_id", "n_convs", "saved", *NODE, "up1", "up2"))


def _below(nodes: DataFrame, width: int) -> DataFrame:
    """For the node before every row but the first (depth, k1, k2): the sums over all rows hanging from it."""
    totals = nodes.filter("row > 0").groupBy("row", "p1", "p2").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    ends = nodes.filter(F.col("level") == width).select(
        (F.col("row") + 1).alias("row"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.when(F.col("row") > 0, F.struct(F.col("p1").alias("p1"), F.col("p2").alias("p2"))).alias("up"),
    )
    hung = checkpointed(totals.join(ends, ["row", "p1", "p2"]))
    rows, distance = hung.agg(F.coalesce(F.max("row"), F.lit(0))).first()[0], 1
    while distance < rows:
        above = [(F.col("row") - distance).alias("row"), F.col("up.p1").alias("p1"), F.col("up.p2").alias("p2")]
        sent = hung.filter("up is not null").groupBy(*above).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        farther = hung.select((F.col("row") + distance).alias("row"), F.struct("p1", "p2").alias("up"), F.col("up").alias("farther"))
        summed = hung.join(sent, ["row", "p1", "p2"], "left").withColumns({
            "leaves": F.col("leaves") + F.coalesce("l", F.lit(0)), "saved": F.col("saved") + F.coalesce("s", F.lit(0)),
        })
        moved = summed.join(farther, ["row", "up"], "left")
        hung = checkpointed(moved.select("row", "p1", "p2", F.col("farther").alias("up"), "leaves", "saved"))
        distance *= 2
    return hung.select(
        (F.col("row") * width).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
        F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"),
    )


def prefix_trie(turns: DataFrame, turnless: DataFrame | None = None, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the conversations in ``turns`` (conv_id, pos, turn_id, words) and ``turnless`` (conv_id).

    Nodes: ``NODE``, conv_id (the smallest member), parent_conv_id, n_convs, n_children, n_leaves and
    saved_tokens. Ends: conv_id and the ``NODE`` of its last turn.
    """
    rows = _rows(turns, turnless, width)
    nodes = _nodes(rows, width)
    below = nodes.filter("depth > 0")
    children = below.groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("parent_conv_id")
    )
    linked = nodes.join(children, NODE, "left").join(parents, ["depth", "up1", "up2"], "left").withColumn(
        "leaf", F.col("n_children").isNull().cast("long")
    )
    linked = checkpointed(linked.drop("up1", "up2"))
    whole = linked.join(_below(linked, width), NODE, "left").withColumns({
        "leaf": F.col("leaf") + F.coalesce("more_leaves", F.lit(0)), "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
    })
    own = "named_struct('level', level, 'depth', depth, 'k1', k1, 'k2', k2, 'conv_id', conv_id, 'parent_conv_id', parent_conv_id, 'n_convs', n_convs, 'n_children', coalesce(n_children, 0))"
    summed = _rollup(whole, width, f"min({own}) as node, sum(leaf) as n_leaves, sum(saved) as saved_tokens")
    # the shallowest node of a group stands for it; groups of shorter prefixes only have none of their length
    done = summed.filter("node.level = level").select("node.*", "n_leaves", "saved_tokens").drop("level")
    last = rows.groupBy("conv_id").agg(F.max(F.struct("row", "held", *[
        F.col(f"p{k}").bitwiseXOR(F.col(f"x{k}")).alias(f"k{k}") for k in (1, 2)
    ])).alias("r"))
    ends = last.select("conv_id", (F.col("r.row") * width + F.col("r.held")).alias("depth"), "r.k1", "r.k2")
    return done, ends


def ends_digest(ends: DataFrame) -> DataFrame:
    """Per node of ``ends`` the hex SHA-256 of its conversations' ids, ascending, joined by commas."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(i).to_numpy() for i in range(4)]
            new = np.ones(b.num_rows, dtype=bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:3]])
            edges, done = [*np.flatnonzero(new).tolist(), b.num_rows], []
            for a, z in zip(edges, edges[1:]):
                ids, here = ",".join(map(str, columns[3][a:z].tolist())), tuple(int(c[a]) for c in columns[:3])
                if here == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = here, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*NODE, "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, state.hexdigest())], [*NODE, "ends_sha256"])

    told = ends.select(*[F.col(c).cast("long").alias(c) for c in NODE], "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    return told.mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")
