import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from rows import DOCUMENTS, clashing, documents

from tenurelake.llm import merkle
from tenurelake.llm.ordering import positions

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[c] for c in COLUMNS)])


def tree(leaves):
    """The top, and per leaf the (side, sibling) of each level."""
    steps, nodes = [[] for _ in leaves], [(x, [i]) for i, x in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for k in range(0, len(nodes), 2):
            run = nodes[k : k + 2]
            for at, (_, below) in enumerate(run):
                other = run[1 - at][0] if len(run) == 2 else None
                for i in below:
                    steps[i].append(("alone" if other is None else "left" if at else "right", other))
            above.append((h(*[x for x, _ in run]), [i for _, below in run for i in below]))
        nodes = above
    return nodes[0][0], steps


def plain(rows):
    parts = defaultdict(list)
    for r in rows:
        parts[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    lower = [tree([x[2] for x in sorted(parts[p])]) for p in names]
    root, upper = tree([top for top, _ in lower]) if lower else (None, [])
    out = []
    for p, (top, steps), above in zip(names, lower, upper):
        for (known, doc, x), own in zip(sorted(parts[p]), steps):
            out.append((doc if known else None, x, top, root, [s for _, s in own + above if s]))
    return sorted(out, key=str)


def found(df):
    done = merkle.manifest(df, COLUMNS, "lang", "doc_id")
    rows = done.select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings(F.col("path")).alias("s"),
        merkle.fold(F.col("leaf"), F.col("path")).alias("folded"), merkle.fold(F.lit(h("other")), F.col("path")).alias("wrong"),
    ).collect()
    assert all(r.folded == r.root != r.wrong for r in rows)
    return sorted([tuple(r)[:5] for r in rows], key=str)


@pytest.mark.parametrize("make", [documents, lambda s: clashing(documents(s)), lambda s: s.createDataFrame([], DOCUMENTS)])
def test_awkward_rows(spark, make):
    assert found(make(spark)) == plain(documents(spark).collect() if make(spark).count() else [])


@pytest.mark.parametrize("sizes", [[1], [2], [3], [1, 1], [1, 2, 5, 300, 257, 256], [700]])
def test_sizes_around_powers_of_two(spark, sizes):
    draw = random.Random(1)
    rows = [(i * 10 + k, f"text {i}", f"l{k}" if k else None, "s", i) for k, n in enumerate(sizes) for i in range(n)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, DOCUMENTS)
    assert found(df) == plain(df.collect())


def test_paths_without_broadcast_and_with_few_levels_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FEW", 0)
    monkeypatch.setattr(merkle, "LEVELS", 2)
    df = spark.createDataFrame([(i % 40, "x", ["a", "b", None][i % 7 % 3], "s", None) for i in range(200)], DOCUMENTS)
    assert found(df) == plain(df.collect())


def test_positions_of_one_hot_part_spread_over_ranges(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 > 0, 1).alias("g"), F.lit(5).alias("o"))
    placed = positions(rows, ["g"], ["o"])
    got = defaultdict(list)
    for r in placed.collect():
        got[r.g, r.n].append(r.pos)
    assert {k: sorted(v) for k, v in got.items()} == {(1, 2666): list(range(2666)), (None, 1334): list(range(1334))}
