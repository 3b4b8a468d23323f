"""Exact top-k search by inner product: a KD-tree per shard, searched best box first.

Vectors become whole numbers and equal ones are merged first; a merged vector keeps the k + 1
smallest ids, all that a result can hold of it. Shards are dealt by a hash of the vector. A task gets
one shard and one block of queries. It builds a tree by median splits along the widest side, with the
tight box of every node, and visits nodes in the order of what their box can reach at most for any
query of the block; a box that cannot reach a query's k-th score so far is left out for that query,
and the search ends when no box is left. A first round asks each query of one shard only; the k-th
scores found there are handed on to the second round over all other shards.

Memory is bounded by ``SHARD`` vectors and ``BLOCK`` queries a task. Every query meets every shard,
as the whole set is asked for, in blocks; what a task returns is k rows a query.

Defined results: vectors that are null, empty or hold a null or non-finite component take no part, as
queries or candidates. Nothing is cut: where sums of products could leave 64 bits they are worked out in
whole numbers of any size, and only a result whose score itself leaves 64 bits fails the query, as does
a component that leaves 62 bits. Vectors of another length than the query's are no candidates for it. Rows
with one id are never candidates of each other, and equal rows count once; a null id takes no part.
Ties go to the smaller id. No candidates give no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tenurelake.session import checkpointed

SHARD = 16_384
BLOCK = 16_384
LEAF = 128
SCALE = 1024


def whole_vector(vector: str) -> Column:
    """floor(1024 x) of every component as array<long>, null for a vector that takes no part."""
    v = F.col(f"`{vector}`")
    x = lambda e: e.cast("double")
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(x(e)) | (F.abs(x(e)) == float("inf")))
    beyond = F.raise_error(F.lit("component beyond 62 bits")).cast("long")
    whole = F.transform(v, lambda e: F.when(F.abs(x(e)) < 2.0**62 / SCALE, F.floor(x(e) * SCALE)).otherwise(beyond))
    return F.when((F.size(v) > 0) & ~F.coalesce(bad, F.lit(False)), whole)


class Tree:
    """Median splits of points with the tight box of every node; leaves hold ranges of ``order``."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.lo: list[np.ndarray] = []
        self.hi: list[np.ndarray] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self._build(points, 0, len(points), leaf)
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _build(self, points: np.ndarray, a: int, b: int, leaf: int) -> int:
        own, me = points[self.order[a:b]], len(self.span)
        lo, hi = own.min(axis=0), own.max(axis=0)
        self.lo.append(lo)
        self.hi.append(hi)
        self.span.append((a, b))
        self.children.append(None)
        if b - a > leaf and (hi > lo).any():
            axis, middle = int(np.argmax(hi - lo)), (b - a) // 2
            side = own[:, axis]
            self.order[a:b] = self.order[a:b][np.argsort(side) if side.dtype == object else np.argpartition(side, middle)]
            self.children[me] = (
                self._build(points, a, a + middle, leaf), self._build(points, a + middle, b, leaf)
            )
        return me

    def reach(self, node: list[int], queries: np.ndarray) -> np.ndarray:
        """The most that any point in the nodes' boxes can score, queries x nodes."""
        most = np.maximum(queries, 0) @ self.hi[node].T + np.minimum(queries, 0) @ self.lo[node].T
        return most.astype(float)


def search(points: np.ndarray, firsts: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query the points that can be among its best, as (query, point) index pairs.

    ``floor`` is a score each query's k-th best is known to reach (-inf: unknown). Bounds are compared
    as doubles, whose rounding keeps order, and what is left is ordered by exact scores.
    """
    tree, kth = Tree(points), floor.copy()
    best = np.full((len(queries), k), -np.inf)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    wait = [(-float(tree.reach([0], queries).max(initial=-np.inf)), 0)]
    while wait:
        _, node = heapq.heappop(wait)
        reach = tree.reach([node], queries)[:, 0]
        open_ = np.flatnonzero(reach >= kth)
        if not len(open_):
            continue
        if tree.children[node] is not None:
            bound = tree.reach(list(tree.children[node]), queries[open_])
            for c, child in enumerate(tree.children[node]):
                live = bound[:, c][bound[:, c] >= kth[open_]]
                if len(live):
                    heapq.heappush(wait, (-float(live.max()), child))
            continue
        a, b = tree.span[node]
        here = tree.order[a:b]
        exact = queries[open_] @ points[here].T
        scores = exact.astype(float)
        merged = np.concatenate([best[open_], scores], axis=1)
        best[open_] = -np.partition(-merged, k - 1, axis=1)[:, :k]
        kth[open_] = np.maximum(kth[open_], best[open_].min(axis=1))
        q, p = np.nonzero(scores >= kth[open_][:, None])
        out.append((open_[q], here[p], exact[q, p]))
    if not out:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    q, p, s = (np.concatenate(x) for x in zip(*out))
    good = s.astype(float) >= kth[q]
    q, p, s = q[good], p[good], s[good]
    if s.dtype == object:
        s = np.unique(s, return_inverse=True)[1]  # their order is all that counts here
    order = np.lexsort((firsts[p], -s, q))  # of a merged vector at least its smallest id counts
    q, p, s = q[order], p[order], s[order]
    begins = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, dtype=int)
    place = np.arange(len(q)) - np.repeat(begins, np.diff(np.append(begins, len(q))))
    few = place <= k  # one more than k: the query itself may be among them
    return q[few], p[few]


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the fastest numbers in which all sums of products are exact: doubles, longs or Python's."""
    largest = float(np.abs(a).max(initial=1)) * float(np.abs(b).max(initial=1)) * a.shape[1]
    kind = float if largest < 2**52 else np.int64 if largest < 2**62 else object
    return a.astype(kind), b.astype(kind)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    scores = (a * b).sum(axis=1)
    if scores.dtype == object and any(not -(2**63) <= s < 2**63 for s in scores):
        raise OverflowError("score beyond 64 bits")
    return scores.astype(np.int64)


def _one_shard(k: int):
    def work(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        points, queries = (np.array(x["v"].tolist(), dtype=np.int64) for x in (shard, asked))
        firsts = np.fromiter((i[0] for i in shard["ids"]), dtype=np.int64, count=len(shard))
        points, queries = _exact(points, queries)
        q, p = search(points, firsts, queries, k + 1, asked["floor"].to_numpy(dtype=float))
        ids = shard["ids"].to_numpy()[p]
        sizes = np.fromiter(map(len, ids), dtype=int, count=len(ids))
        row = np.repeat(np.arange(len(q)), sizes)
        query_id = asked["query_id"].to_numpy()[q[row]]
        vec_id = np.concatenate(ids) if len(ids) else np.zeros(0, dtype=np.int64)
        other = query_id != vec_id
        row = row[other]
        found = pd.DataFrame({
            "query_id": query_id[other], "vec_id": vec_id[other], "score": _scores(queries[q[row]], points[p[row]]),
        }).astype("int64").sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return found.groupby("query_id").head(k)

    return work


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` rows of highest inner product for each row that ``is_query`` selects: query_id, rank
    (from 1), vec_id, score."""
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), whole_vector(vector).alias("v"), is_query.alias("q")
    ).filter("vec_id is not null and v is not null")
    # Of each vector the k + 1 smallest ids: a limit that Spark applies in every task before the shuffle.
    lowest = W.partitionBy("v").orderBy("vec_id")
    merged = (
        rows.select("v", "vec_id").distinct().withColumn("r", F.row_number().over(lowest)).filter(F.col("r") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    points = checkpointed(merged)
    asked = checkpointed(rows.filter("q").select(F.col("vec_id").alias("query_id"), "v").distinct())
    shards, blocks = _pieces(points.count(), SHARD), _pieces(asked.count(), BLOCK)
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards))).withColumn("dim", F.size("v"))
    asked = asked.withColumns({
        "block": F.pmod(F.xxhash64("query_id"), F.lit(blocks)), "home": F.pmod(F.xxhash64("v"), F.lit(shards)), "dim": F.size("v"),
    })
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    found_type, group = "query_id long, vec_id long, score long", ["shard", "block", "dim"]

    def round_(queries: DataFrame) -> DataFrame:
        left = dealt.withColumn("block", each(blocks)).groupBy(*group)
        right = queries.select(*[F.col(c).alias(c) for c in queries.columns]).groupBy(*group)  # columns of its own
        return left.cogroup(right).applyInPandas(_one_shard(k), found_type)

    # Round one: the shard a query's own vector is dealt to.
    known = F.lit(float("-inf"))
    near = checkpointed(round_(asked.withColumnRenamed("home", "shard").withColumn("floor", known)))
    reached = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s"))
    floors = asked.join(reached, "query_id", "left").withColumn(
        "floor", F.coalesce(F.when(F.col("n") >= k, F.col("s").cast("double")), known)
    )
    rest = floors.withColumn("shard", each(shards)).filter("shard <> home")
    every = near.unionByName(round_(rest)) if shards > 1 else near
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _pieces(n: int, size: int) -> int:
    return max(1, -(-n // size))
