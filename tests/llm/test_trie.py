import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tenurelake.llm import catalog, trie

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FIGURES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def sequences(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            content = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[c].append((t is not None, t or 0, content, (role, text)))
    return {c: [t[-1] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in turns.items()}


def rebuilt(seq):
    out = {}
    for c, own in seq.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = seq.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    return out


def plain_trie(seq):
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in seq.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, held in members.items():
        words = len(WORD.findall(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(held) - 1) * words
    return [
        (
            min(held), len(path), min(members[path[:-1]]) if path else None, len(held), len(children[path]), leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, sorted(c for c in held if len(seq[c]) == len(path)))).encode()).hexdigest(),
        )
        for path, held in members.items()
    ]


def rows_of(nodes, ends):
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    joined = nodes.join(trie.ends_digest(ends), trie.NODE, "left")
    return sorted(map(tuple, joined.select(*FIGURES, F.coalesce("ends_sha256", nothing)).collect()), key=str)


def awkward(seed, longest=23):
    draw = random.Random(seed)
    rows = []
    for c in [*range(50), -3, -20, 400, None]:
        for k in range(draw.randint(1, longest)):
            rows.append((
                c, draw.choice([k, k, k, None, 3]), draw.choice(["u", "a", None]) if k > 6 else "u",
                draw.choice(["x y", "x", None, " z\t z z", "日本 語"]) if k > 9 else "same text",
            ))
    return rows + [(7, 1, "u", "same text")] * 30 + [(8, 0, "", "x" * 50_000), (8, 0, None, "x" * 50_000)]


@pytest.mark.parametrize("width", [8, 3, 1])
def test_trie_against_plain_python(spark, width):
    rows = awkward(width)
    turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(*trie.prefix_trie(turns, width=width)) == sorted(plain_trie(sequences(rows)), key=str)


def test_long_conversations_go_on_in_further_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "RUN", 2)
    rows = [(c, k, "u", "t" if k < 30 + c else f"{c} {k}") for c in range(4) for k in range(60)]
    turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(*trie.prefix_trie(turns, width=4)) == sorted(plain_trie(sequences(rows)), key=str)


def test_rebuilt_conversations_and_turnless_ones(spark):
    rows = awkward(9, 4) + [(c, 0, "u", "only") for c in (101, 102, 103, 104)]  # 100 is absent: some lose all turns
    found = catalog.rebuilt(trie.ordered_turns(spark.createDataFrame(rows, SCHEMA)))
    want = rebuilt(sequences(rows))
    assert {r.conv_id for r in found[1].collect()} == {c for c, s in want.items() if not s} != set()
    assert rows_of(*trie.prefix_trie(*found)) == sorted(plain_trie(want), key=str)


def test_copies_and_extra_columns(spark):
    rows = [(c, k, "u", "w w") for c in range(300) for k in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("pos", "n", "row", "p1", "t0", "words", "level", "depth")})
    got = rows_of(*trie.prefix_trie(trie.ordered_turns(df)))
    assert got == sorted(plain_trie(sequences(rows)), key=str) and len(got) == 4


def test_no_conversations_no_nodes(spark):
    assert rows_of(*trie.prefix_trie(trie.ordered_turns(spark.createDataFrame([], SCHEMA)))) == []
    assert rows_of(*trie.prefix_trie(trie.ordered_turns(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)))) == []


def test_ends_of_a_node_are_hashed_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        ends = spark.range(100).selectExpr("id as conv_id", "cast(id % 3 as long) as depth", "0L as k1", "1L as k2")
        got = {r.depth: r.ends_sha256 for r in trie.ends_digest(ends).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {d: hashlib.sha256(",".join(map(str, range(d, 100, 3))).encode()).hexdigest() for d in range(3)}
