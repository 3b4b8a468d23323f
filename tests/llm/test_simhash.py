import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from rows import DOCUMENTS, LONG, clashing, documents

from tenurelake.llm import simhash
from tenurelake.llm.components import components


def naive(text):
    words = [w.encode() for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def least_reachable(values):
    """Smallest value that steps of at most three bits reach, by comparing everything."""
    values, root = sorted(values), {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


@pytest.mark.parametrize("text", ["", None, "one", "Two Words", "a b c", "A b C d e a b c", "é À ß tres\tcuatro\n\n cinco " * 40])
def test_fingerprint_is_the_majority_of_hash_bits(spark, text):
    assert simhash.fingerprint_of(text) & (2**64 - 1) == naive(text)


def test_bits_of_spark_hash_and_library_hash_agree(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("the cat sat"))).first()[0]
    assert got & (2**64 - 1) == xxhash.xxh64_intdigest(b"the cat sat", seed=42)


def family(seed, n=400):
    """Fingerprints in chains and crowds around a few centres, with strangers among them."""
    rng = np.random.default_rng(seed)
    out = {0, -1}
    for centre in rng.integers(-(2**63), 2**63 - 1, 6):
        value = int(centre)
        for _ in range(n // 8):
            flip = sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 5)), replace=False))
            near = value ^ (flip - 2**64 if flip >= 2**63 else flip)
            out.add(near)
            value = near if rng.random() < 0.3 else value
    return out | {int(x) for x in rng.integers(-(2**63), 2**63 - 1, n // 4)}


@pytest.mark.parametrize("crowd", [1, 2, 16, 512])
def test_links_connect_exactly_what_steps_of_three_bits_connect(spark, crowd):
    values = family(crowd)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(fps, crowd)).collect()}
    assert {v: roots.get(v, v) for v in values} == least_reachable(values)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_awkward_rows(spark):
    got = simhash.near_duplicates(clashing(documents(spark)).drop("fp")).collect()
    assert len(got) == 12
    of = {}
    for r in got:
        of.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    assert of[1] == {(simhash.fingerprint_of("the cat sat on the mat and looked at the dog"), 1)} == of[2]
    assert of[3] == of[4] == of[5] == {(0, 3)}
    assert of[6] == of[7] and {c for _, c in of[6]} == {6}
    assert of[None] == {(simhash.fingerprint_of("a row without an id"), None), (0, 3)}
    assert simhash.near_duplicates(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_one_of_each_keeps_one_row_of_a_group(spark):
    docs = clashing(documents(spark))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, 1), (False, 3), (False, 6), (False, 8), (False, 9), (True, 0)
    ]
    assert simhash.one_of_each(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_long_text_needs_no_spread_of_all_bits(spark, monkeypatch):
    whole = simhash.fingerprint_of(LONG)
    monkeypatch.setattr(simhash, "_STEP", 7)
    assert simhash.fingerprint_of(LONG) == whole


def test_query_agrees_with_brute_force(spark, sf_dir):
    from tenurelake.llm import catalog

    got = catalog.op1_simhash(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: naive(r.text) for r in docs}
    roots = least_reachable(set(fps.values()))
    first = {}
    for d, f in fps.items():
        first[roots[f]] = min(d, first.get(roots[f], d))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        d: (f"{f:016x}", first[roots[f]]) for d, f in fps.items()
    }
