import random
from fractions import Fraction
from itertools import islice

import pytest
from pyspark.sql import functions as F
from rows import DOCUMENTS, clashing, documents

from tenurelake.llm import mixing


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 1.5}, {str(i): i * i + 0.1 for i in range(40)}])
def test_every_block_lies_in_its_window_and_shares_deviate_by_less_than_a_block(weights):
    units = mixing.parts(weights, 512)
    assert sum(units.values()) == 512 and min(units.values()) >= 1
    had = dict.fromkeys(units, 0)
    for s, i, release, deadline, slot in mixing.schedule(units):
        assert i == had[s] and release == i * 512 // units[s] <= slot < deadline == -(-(i + 1) * 512 // units[s])
        had[s] += 1
        assert all(abs(had[t] - (slot + 1) * units[t] / 512) < 1 for t in units)
    assert had == units


def test_schedule_of_a_period_repeats():
    """Slots found by division are those that earliest deadline first gives without a period."""
    units = {"a": 5, "b": 2, "c": 1}
    slots = {(s, i): t for s, i, _, _, t in mixing.schedule(units)}
    waiting, order = {s: 0 for s in units}, []
    for t in range(24):
        ready = [(-(-(i + 1) * 8 // units[s]), s, i) for s, i in waiting.items() if i * 8 // units[s] <= t]
        _, s, i = min(ready)
        waiting[s] += 1
        order.append((s, i))
    assert all(slots[s, i % units[s]] + i // units[s] * 8 == t for t, (s, i) in enumerate(order))


@pytest.mark.parametrize("n, slots", [(20, 20000), (200, 10000), (2000, 9000)])
def test_shares_deviate_from_the_target_weights_by_less_than_a_block(n, slots):
    """One source of weight 0.5, the others alike: over several periods, and with exact windows."""
    weights = {"hot": 0.5} | {str(i): 0.5 / (n - 1) for i in range(n - 1)}
    units, had = mixing.proportion(weights), dict.fromkeys(weights, 0)
    exact = {s: Fraction(w) / sum(map(Fraction, weights.values())) for s, w in weights.items()}
    assert all(Fraction(units[s], sum(units.values())) == exact[s] for s in weights)
    for s, i, release, deadline, slot in islice(mixing.blocks(units, dict.fromkeys(weights, slots)), slots):
        assert i == had[s] and release == i // exact[s] <= slot < deadline == -(-(i + 1) // exact[s])
        had[s] += 1
        assert abs(had["hot"] - (slot + 1) * exact["hot"]) < 1
        if slot % 997 == 0:
            assert all(abs(had[t] - (slot + 1) * exact[t]) < 1 for t in weights)


def test_sources_without_a_weight_leave_the_others_in_proportion():
    units = mixing.proportion({"a": 3.0, "b": 1.0, "none": 0.0}, 64)
    assert units["a"] == 3 * units["b"] and 64 * units["none"] == sum(units.values())
    assert mixing.parts({"hot": 0.5} | {str(i): 0.5 / 19 for i in range(19)})["hot"] == 2048


def test_rows_get_the_target_weights_over_several_periods(spark, monkeypatch):
    docs = spark.range(30000).selectExpr("id as doc_id", "if(id % 2 = 0, 'hot', string(id % 37)) as source")
    weights = {"hot": 0.5} | {str(i): 0.5 / 37 for i in range(37)}
    took = []
    for limit in (mixing.DRIVER_BLOCKS, 0):
        monkeypatch.setattr(mixing, "DRIVER_BLOCKS", limit)
        placed, at = mixing.place(docs, weights, block=1)
        took.append(sorted((r.slot, r.source) for r in placed.select("source", f"{at}.slot").collect()))
        had = 0
        for slot, source in took[-1][:20000]:
            had += source == "hot"
            assert abs(had - (slot + 1) / 2) < 1
    assert took[0] == took[1]


def corpus(spark, n=6000):
    rng = random.Random(1)
    rows = [(i, f"text {i}", "en", "hot" if rng.random() < 0.5 else rng.choice("abc"), i) for i in range(n)]
    return spark.createDataFrame(rows, DOCUMENTS)


def test_rows_are_numbered_without_gaps_whatever_the_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    docs = corpus(spark)
    placed, at = mixing.place(docs, {"hot": 1, "a": 1, "b": 2, "c": 4}, block=8, period=64)
    rows = placed.select("doc_id", "source", f"{at}.*").collect()
    assert sorted(r.doc_id for r in rows) == list(range(6000))
    for s in {r.source for r in rows}:
        own = sorted(r.block * 8 + r.turn for r in rows if r.source == s)
        assert own == list(range(len(own)))
    assert len({(r.slot, r.turn) for r in rows}) == 6000
    assert len({(r.slot, r.source, r.block) for r in rows}) == len({r.slot for r in rows})
    units = mixing.parts({"hot": 1, "a": 1, "b": 2, "c": 4}, 64)
    last = min(max(r.slot for r in rows if r.source == s) for s in units) // 8
    for t in range(1, last):
        for s in units:
            assert abs(sum(r.source == s and r.slot < t and r.turn == 0 for r in rows) - t * units[s] / 64) < 1


def test_mixed_rows_follow_the_schedule(spark):
    docs = corpus(spark, 1000)
    placed, at = mixing.place(docs)
    want = [r.doc_id for r in placed.orderBy(f"{at}.slot", f"{at}.turn").collect()]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and [r.doc_id for r in mixed.collect()] == want


def test_awkward_rows(spark):
    docs = clashing(documents(spark))
    mixed = mixing.mix(docs, {"a": 1.0, "b": None, "gone": 3.0})
    key = lambda rows: sorted(map(str, rows))
    assert mixed.columns == docs.columns and key(mixed.collect()) == key(docs.collect())
    assert mixing.mix(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_too_many_sources_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    with pytest.raises(ValueError):
        mixing.mix(documents(spark))


def test_query_holds_every_document(spark, sf_dir):
    from tenurelake.llm import catalog

    got = catalog.op5_mixing(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert got.filter((F.col("slot") < F.col("release")) | (F.col("slot") >= F.col("deadline"))).count() == 0
