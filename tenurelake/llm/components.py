"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenurelake.session import checkpointed


def _star(edges: DataFrame, smaller: bool) -> DataFrame:
    """Links every neighbour of a node to the least node of its neighbourhood: the larger neighbours
    (large star), or the smaller ones and the node itself (small star).

    The least neighbour is a map-side combined aggregate joined back to the links, so the neighbours
    of a node, however many, are never gathered.
    """
    both = edges.select(F.col("u").alias("a"), F.col("v").alias("b"))
    if not smaller:
        both = both.unionByName(edges.select(F.col("v").alias("a"), F.col("u").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    near = both.join(least, "a")
    if smaller:
        out = near.select(F.col("b").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("a").alias("u"), F.col("m").alias("v")))
    else:
        out = near.filter("b > a").select(F.col("b").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v), root being the least node it reaches.

    Links are kept with u > v; a round replaces them by links to smaller nodes and ends when nothing
    changes, after about as many rounds as the logarithm of the longest chain. Each round is written
    to the shared folder. Links of a node to itself and nulls are ignored; no links give no rows.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = checkpointed(ordered.filter("u <> v").distinct())
    before = None
    for _ in range(max_rounds):
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
        ).first()
        if state["n"] == 0 or state == before:
            break
        before = state
        edges = checkpointed(_star(_star(edges, smaller=False), smaller=True))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
