"""Versions of a salary log: the fold, its effect on an unknown start, and cut employees."""

import numpy as np
import pandas as pd
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tenurelake.operators import folds, scd2

cents = st.lists(st.one_of(st.integers(900, 1200), st.integers(-5, 3000)), min_size=1, max_size=60)


def plainly(events, state=None):
    """The rule as one would say it: a change of more than 5 % of the last version opens a version."""
    opened = []
    for i, e in enumerate(events):
        if state is None or (state > 0 and abs(e - state) * 20 > state):
            opened.append(i)
            state = e
    return opened, state


def through(events, state):
    effect = [r for lo, hi, r in folds.segment_effect(np.array(events)) if lo <= state <= hi]
    assert len(effect) <= 1
    return effect[0] if effect else state


@given(cents, st.one_of(st.none(), st.integers(-5, 3000)))
@settings(max_examples=400, deadline=None)
def test_fold_follows_the_rule(events, state):
    start = folds.NO_VERSION if state is None else state
    assert folds.emitted(np.array(events), start) == plainly(events, state)[0]


@given(cents, st.integers(-5, 3000))
@settings(max_examples=400, deadline=None)
def test_effect_equals_fold(events, state):
    assert through(events, state) == plainly(events, state)[1]


def test_effect_on_every_start_of_a_slow_drift():
    events = list(range(1000, 1400, 2))
    for state in range(1, 2500):
        assert through(events, state) == plainly(events, state)[1]


def test_batches_may_cut_an_employee():
    pdf = pd.DataFrame({"employee_id": [1] * 6 + [2] * 4, "_c": [100, 103, 106, 109, 112, 115, 50, 51, 52, 53]})
    whole = pd.concat(folds.fold_sorted(iter([pdf])))
    for size in (1, 2, 3, 7):
        cut = pd.concat(folds.fold_sorted(pdf.iloc[i:i + size] for i in range(0, len(pdf), size)))
        assert cut.equals(whole)
    assert list(whole["_c"]) == [100, 106, 112, 50, 53]


def test_hot_employees_give_the_same_versions(spark):
    rng = np.random.default_rng(11)
    steps = np.cumsum(rng.integers(-30, 60, 4000)) + 500000
    ids = np.where(rng.random(4000) < 0.4, 7, rng.integers(0, 40, 4000))
    data = [(int(k), int(i), int(t), float(s) / 100) for k, (i, t, s) in enumerate(
        zip(ids, rng.integers(0, 900, 4000), steps))]
    log = spark.createDataFrame(data, "event_id bigint, employee_id int, t bigint, s double").select(
        "event_id", "employee_id", F.timestamp_seconds("t").alias("change_ts"),
        F.col("s").cast("decimal(10,2)").alias("new_salary"))
    for mode in ("last_version", "previous"):
        wanted = sorted(tuple(r) for r in scd2.scd2_from_change_log(log, mode).collect())
        for hot in (50, 300):
            got = sorted(tuple(r) for r in scd2.scd2_from_change_log(log, mode, hot).collect())
            assert got == wanted


def test_short_segments_fold_without_a_call_each(spark):
    """Employees of many segments and none; the plan passes batches, not groups, to Python."""
    log = spark.range(3000).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 7 != 3, (F.col("id") % 9)).cast("int").alias("employee_id"),
        F.timestamp_seconds(F.col("id") * 7919 % 3001).alias("change_ts"),
        (F.lit(500) + F.col("id") * 104729 % 97).cast("decimal(10,2)").alias("new_salary"))
    opened = scd2.versions_from_log(log, "last_version", 5)
    assert "FlatMapGroupsInPandas" not in opened._jdf.queryExecution().toString()
    assert sorted(map(repr, opened.collect())) == sorted(map(repr, scd2.versions_from_log(log).collect()))


def test_the_modes_differ_on_small_steps(spark):
    data = [(k, 1, k, 100.0 * 1.04**k) for k in range(5)]
    log = spark.createDataFrame(data, "event_id bigint, employee_id int, t bigint, s double").select(
        "event_id", "employee_id", F.timestamp_seconds("t").alias("change_ts"),
        F.col("s").cast("decimal(10,2)").alias("new_salary"))
    opened = {m: sorted(r["event_id"] for r in scd2.versions_from_log(log, m).collect())
              for m in ("previous", "last_version")}
    assert opened == {"previous": [0], "last_version": [0, 2, 4]}


def test_effects_in_a_row_are_one_effect():
    rng = np.random.default_rng(5)
    for _ in range(60):
        parts = [rng.integers(900, 1200, rng.integers(1, 6)) for _ in range(rng.integers(1, 6))]
        effects = []
        for e in parts:
            effects.append([*folds.segment_effect(e), (folds.NO_VERSION, folds.NO_VERSION, int(e[folds.emitted(e, folds.NO_VERSION)[-1]]))])
        whole = folds.compose(effects)
        for state in [folds.NO_VERSION, -5, 0, 1, 2**61, *range(850, 1300, 3)]:
            step = state
            for effect in effects:
                step = folds.apply_effect(effect, step)
            assert folds.apply_effect(whole, state) == step
