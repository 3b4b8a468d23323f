"""Folding salary events into versions, on one sorted run of events. Runs inside Spark tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

# Tasks get these functions with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Salaries as whole cents. An event leaves a version of s cents alone when it is within 5 % of s,
# that is when 95 s <= 100 e <= 105 s; a version of zero or less has no relative change and stays.
NO_VERSION = -(2**62)  # marks "no version yet"


def _stable_band(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive versions that each event leaves alone: [ceil(100 e / 105), floor(100 e / 95)]."""
    return -((-100 * e) // 105), (100 * e) // 95


def _next_version(lo: np.ndarray, hi: np.ndarray, at: int, s: int) -> int:
    """Index of the first event from ``at`` on that replaces version ``s``, or len."""
    if s <= 0:
        return len(lo)
    step = 64
    while at < len(lo):
        out = (lo[at:at + step] > s) | (hi[at:at + step] < s)
        hit = int(out.argmax())
        if out[hit]:
            return at + hit
        at += step
        step = min(step * 4, 1 << 16)
    return len(lo)


def emitted(e: np.ndarray, state: int) -> list[int]:
    """Indexes of the events that open a version, starting from version ``state``."""
    lo, hi = _stable_band(e)
    if state == NO_VERSION:
        picked, at, s = [0], 1, int(e[0])
    else:
        picked, at, s = [], 0, state
    while (at := _next_version(lo, hi, at, s)) < len(e):
        picked.append(at)
        s = int(e[at])
        at += 1
    return picked


def segment_effect(e: np.ndarray) -> list[tuple[int, int, int]]:
    """What a run of events does to an unknown starting version: (low, high, resulting version).

    Ranges not listed pass through unchanged. The first event outside a starting version's band
    replaces it, so ranges are peeled off the edges of the still undisturbed interval; the result
    after each such event is shared by all later events that lead to it.
    """
    lo, hi = _stable_band(e)
    ends: dict[int, int] = {}

    def end_of(i: int) -> int:
        path = []
        while i not in ends:
            path.append(i)
            nxt = _next_version(lo, hi, i + 1, int(e[i]))
            if nxt >= len(e):
                ends[i] = int(e[i])
                break
            i = nxt
        for p in path:
            ends[p] = ends[i]
        return ends[i]

    effect: list[tuple[int, int, int]] = []
    low, high = 1, 2**62
    top, bottom = np.maximum.accumulate(lo), np.minimum.accumulate(hi)
    edges = np.flatnonzero(
        np.concatenate([[True], (top[1:] > top[:-1]) | (bottom[1:] < bottom[:-1])])
    )
    for i in edges:
        a, b = int(lo[i]), int(hi[i])
        if a > low:
            effect.append((low, min(a - 1, high), end_of(int(i))))
        if b < high:
            effect.append((max(b + 1, low), high, end_of(int(i))))
        low, high = max(low, a), min(high, b)
        if low > high:
            break
    return [x for x in effect if x[0] <= x[1]]


Effect = list[tuple[int, int, int]]


def apply_effect(effect: Effect, state: int) -> int:
    return next((result for lo, hi, result in effect if lo <= state <= hi), state)


def compose(effects: list[Effect]) -> Effect:
    """One effect for several applied in a row."""
    parts: list[tuple[int, int, int | None]] = [(1, 2**62, None)]  # None: passes through unchanged
    state = NO_VERSION
    for effect in effects:
        state = apply_effect(effect, state)
        ranges = sorted(x for x in effect if x[0] != NO_VERSION)
        split: list[tuple[int, int, int | None]] = []
        for lo, hi, result in parts:
            if result is not None:
                split.append((lo, hi, apply_effect(effect, result)))
                continue
            for a, b, r in ranges:
                if a <= hi and b >= lo:
                    if a > lo:
                        split.append((lo, a - 1, None))
                    split.append((max(a, lo), min(b, hi), r))
                    lo = b + 1
            if lo <= hi:
                split.append((lo, hi, None))
        parts = split[:1]
        for lo, hi, result in split[1:]:  # neighbours that lead to one version are one range
            if result == parts[-1][2]:
                parts[-1] = (parts[-1][0], hi, result)
            else:
                parts.append((lo, hi, result))
    return [x for x in parts if x[2] is not None] + [(NO_VERSION, NO_VERSION, state)]


def fold_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Versions opened by events that arrive sorted by employee and time; holds one batch at a time.
    Events without an employee are one sequence, as they are one group to Spark."""
    key, state, unset = None, NO_VERSION, True
    for batch in batches:
        ids, e = batch["employee_id"].to_numpy(), batch["_c"].to_numpy()
        none = batch["employee_id"].isna().to_numpy()
        new = (ids[1:] != ids[:-1]) & ~(none[1:] & none[:-1])
        starts = np.flatnonzero(np.concatenate([[True], new])) if len(ids) else []
        keep: list[int] = []
        for n, a in enumerate(starts):
            b = starts[n + 1] if n + 1 < len(starts) else len(ids)
            own = None if none[a] else ids[a]
            if unset or own != key:
                key, state, unset = own, NO_VERSION, False
            picked = [a + i for i in emitted(e[a:b], state)]
            if picked:
                state = int(e[picked[-1]])
                keep += picked
        yield batch.iloc[keep]


# -- segments of oversized employees, in Arrow batches of a sorted partition ----------------------

BATCH = 2_000  # groups that one batch of results tells of


def _starts(batch: pa.RecordBatch, by: list[str]) -> list[int]:
    """Where the rows of ``batch`` change one of the columns ``by``; NULL equals NULL."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[:1] = True
    for name in by:
        codes = batch.column(name).dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new).tolist()


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) of every group, from rows that arrive sorted by the columns ``by``; holds one group
    and one batch at a time."""
    key, held = None, []
    for batch in batches:
        starts = _starts(batch, by)
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            own = tuple(batch.column(name)[a].as_py() for name in by)
            if held and own != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def _told(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield batch()
            held = []
    if held:
        yield batch()


_LISTS = [pa.list_(pa.int64())] * 3


def _effects(table: pa.Table) -> list[Effect]:
    """The effects of a group, one a row."""
    lo, hi, result = (table.column(c).to_pylist() for c in ("lo", "hi", "result"))
    return [list(zip(*ranges)) for ranges in zip(lo, hi, result)]


def effects_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each segment does to an unknown starting version and to none."""
    kind: list[pa.DataType] = []

    def rows() -> Iterator[tuple]:
        for (employee, seg), table in _groups(batches, ["employee_id", "_seg"]):
            kind[:] = [table.schema.field("employee_id").type]
            e = table.column("_c").to_numpy()
            effect = [*segment_effect(e), (NO_VERSION, NO_VERSION, int(e[emitted(e, NO_VERSION)[-1]]))]
            yield employee, seg, *map(list, zip(*effect))

    return _typed(rows(), ["employee_id", "_seg", "lo", "hi", "result"], kind, [pa.int64(), *_LISTS])


def _typed(
    rows: Iterator[tuple], names: list[str], kind: list[pa.DataType], rest: list[pa.DataType]
) -> Iterator[pa.RecordBatch]:
    """``_told`` where the type of the first column is known with the first row."""
    first = next(rows, None)
    if first is not None:
        yield from _told(chain([first], rows), names, [*kind, *rest])


def compose_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One effect for the segments of each run."""
    kind: list[pa.DataType] = []

    def rows() -> Iterator[tuple]:
        for (employee, run), table in _groups(batches, ["employee_id", "_run"]):
            kind[:] = [table.schema.field("employee_id").type]
            yield employee, run, *map(list, zip(*compose(_effects(table))))

    return _typed(rows(), ["employee_id", "_run", "lo", "hi", "result"], kind, [pa.int64(), *_LISTS])


def states_sorted(batches: Iterator[pa.RecordBatch], by: list[str], number: str) -> Iterator[pa.RecordBatch]:
    """The version that each row of a group starts with, given the group's own (none, if not given)."""
    kind: list[pa.DataType] = []

    def rows() -> Iterator[tuple]:
        for (employee, *_), table in _groups(batches, by):
            kind[:] = [table.schema.field("employee_id").type]
            state = table.column("_state")[0].as_py() if "_state" in table.column_names else NO_VERSION
            for n, effect in zip(table.column(number).to_pylist(), _effects(table)):
                yield employee, n, state
                state = apply_effect(effect, state)

    return _typed(rows(), ["employee_id", number, "_state"], kind, [pa.int64(), pa.int64()])


def replay_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The events of each segment that open a version, starting from the segment's own; holds one batch."""
    by, key, state = ["employee_id", "_seg"], None, NO_VERSION
    for batch in batches:
        starts, e, given = _starts(batch, by), batch.column("_c").to_numpy(), batch.column("_state")
        keep: list[int] = []
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            own = tuple(batch.column(name)[a].as_py() for name in by)
            if own != key:
                key, state = own, given[a].as_py()
            picked = [a + i for i in emitted(e[a:b], state)]
            if picked:
                state = int(e[picked[-1]])
                keep += picked
        yield batch.take(pa.array(keep, pa.int64())).drop_columns(["_seg", "_state"])
