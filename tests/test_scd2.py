"""Hand-made cases of the versioned dimension."""

import datetime as dt
from decimal import Decimal as D

import pytest

from tenurelake import schemas
from tenurelake.operators import quality, scd2

D1, D2, D3 = dt.date(2020, 1, 1), dt.date(2021, 1, 1), dt.date(2022, 1, 1)
DIM = ("surrogate_key bigint, employee_id int, first_name string, department_name string, monthly_income decimal(10,2),"
       " percent_salary_hike int, job_satisfaction int, start_date date, end_date date, is_current int")
SNAP = "employee_id int, first_name string, department_name string, monthly_income decimal(10,2), percent_salary_hike int"


def dim_of(spark, *rows):
    return spark.createDataFrame(
        [(k, e, "n", d, D(str(i)) if i is not None else None, 5, 1, s, end, c) for k, e, d, i, s, end, c in rows], DIM)


def snap_of(spark, *rows):
    return spark.createDataFrame([(e, "new", d, D(str(i)), 9) for e, d, i in rows], SNAP)


def status(snapshot, dim):
    return {r["employee_id"]: r["status"] for r in scd2.scd2_classify(snapshot, dim).collect()}


def test_change_rule_edges(spark):
    dim = dim_of(
        spark,
        (1, 1, "A", 1000, D1, None, 1), (2, 2, "A", 1000, D1, None, 1), (3, 3, "A", 1000, D1, None, 1),
        (4, 4, None, 1000, D1, None, 1), (5, 5, "A", 0, D1, None, 1), (6, 6, "A", None, D1, None, 1),
        (7, 7, "A", 1000, D1, D2, 0),
        (8, 8, "A", 1000, D1, None, 1), (9, 8, "B", 1000, D1, None, 1),
    )
    snapshot = snap_of(
        spark, (1, "A", 1050), (2, "A", "1050.01"), (3, "A", "949.99"), (4, "B", 1000), (5, "A", 5000),
        (6, "A", 5000), (7, "A", 1000), (8, "A", 1000), (9, "A", 1),
    )
    assert status(snapshot, dim) == {
        1: "UNCHANGED",  # exactly five per cent is not more than five
        2: "CHANGED", 3: "CHANGED",
        4: "UNCHANGED",  # NULL compares as unchanged
        5: "UNCHANGED", 6: "UNCHANGED",  # no relative change from zero or NULL
        7: "NEW",  # only closed versions
        8: "CHANGED",  # one of two current versions differs
        9: "NEW",
    }


def test_merge_closes_opens_and_keeps(spark):
    dim = dim_of(spark, (10, 1, "A", 1000, D1, None, 1), (11, 2, "A", 1000, D1, None, 1),
                 (3, 3, "A", 900, D1, D2, 0), (12, 3, "A", 1000, D2, None, 1))
    snapshot = snap_of(spark, (1, "B", 1000), (2, "A", 1001), (5, "C", 10))
    after = scd2.scd2_apply_snapshot(snapshot, dim, D3)
    by_key = {r["surrogate_key"]: r for r in after.collect()}
    assert sorted(by_key) == [3, 10, 11, 12, 13, 14]
    assert (by_key[10]["end_date"], by_key[10]["is_current"]) == (D3, 0)
    assert (by_key[11]["end_date"], by_key[11]["is_current"]) == (None, 1)
    assert by_key[12]["is_current"] == 1  # missing from the snapshot: left alone
    new = by_key[13]
    assert (new["employee_id"], new["department_name"], new["first_name"]) == (1, "B", "new")
    assert (new["start_date"], new["end_date"], new["is_current"]) == (D3, None, 1)
    assert (new["percent_salary_hike"], new["job_satisfaction"]) == (9, 0)
    assert by_key[14]["employee_id"] == 5
    assert quality.scd2_integrity(after).count() == 0

    again = scd2.scd2_apply_snapshot(snapshot, after, D3)
    assert sorted(again.collect()) == sorted(after.collect())
    current, closed = scd2.scd2_merge(snapshot, dim, D3)
    assert {r["surrogate_key"] for r in closed.collect()} == {10}
    assert {r["surrogate_key"] for r in current.collect()} == {11, 12, 13, 14}

    # a second real change on the same day leaves a version of no length
    twice = scd2.scd2_apply_snapshot(snap_of(spark, (1, "D", 1000)), after, D3)
    empty = twice.filter("start_date = end_date").collect()
    assert [r["surrogate_key"] for r in empty] == [13]


def test_transfer_always_opens_a_version(spark):
    emp = spark.createDataFrame(
        [(1, "x", 10, D("5.00"), 9)],
        "employee_id int, first_name string, department_id int, monthly_income decimal(10,2), percent_salary_hike int")
    dept = spark.createDataFrame([(10, "A"), (20, "B")], "department_id int, department_name string")
    dim = dim_of(spark, (1, 1, "A", 5, D1, None, 1))
    moves = spark.createDataFrame(
        [(1, D2, 1, 20), (2, D3, 1, 10), (3, D3, 9, 10), (4, D3, 1, 99)],
        "event_id int, change_ts date, employee_id int, department_id int")
    emp_after, current, closed, rejected = scd2.apply_transfers(emp, dim, dept, moves, D3)
    dim_after = current.unionByName(closed)
    assert emp_after.first()["department_id"] == 10  # the last valid transfer leads back
    versions = {r["surrogate_key"]: r for r in dim_after.collect()}
    assert versions[1]["is_current"] == 0 and versions[2]["department_name"] == "A"
    assert (versions[2]["percent_salary_hike"], versions[2]["job_satisfaction"]) == (None, None)
    assert {(r["event_id"], r["reason"]) for r in rejected.collect()} == {
        (3, "unknown employee"), (4, "unknown department")}
    assert quality.scd2_integrity(dim_after).count() == 0


def test_department_change_gives_two_versions(spark):
    dim = dim_of(spark, (1, 5, "A", 100, D1, None, 1))
    after = scd2.scd2_apply_snapshot(snap_of(spark, (5, "B", 100)), dim, D2)
    assert [(r["department_name"], r["is_current"]) for r in after.orderBy("start_date").collect()] == [
        ("A", 0), ("B", 1)]


def test_salary_history_from_record_and_from_zero(spark):
    emp = spark.createDataFrame([(1, D("100.00")), (2, D("0.00"))], "employee_id int, monthly_income decimal(10,2)")
    log = spark.createDataFrame(
        [(1, 1, D1, D("105.00"), "r"), (2, 1, D2, D("110.26"), "r"), (3, 2, D1, D("50.00"), "r"), (4, 3, D1, D("1.00"), "r")],
        "event_id int, employee_id int, change_ts date, new_salary decimal(10,2), change_reason string")
    told = {r["event_id"]: (r["old_salary"], r["opens_version"]) for r in scd2.salary_history(log, emp).collect()}
    assert told == {1: (D("100.00"), False), 2: (D("105.00"), True), 3: (D("0.00"), False)}
    assert [r["event_id"] for r in scd2.unknown_employees(log, emp).collect()] == [4]
    assert {r["employee_id"]: r["monthly_income"] for r in scd2.latest_salaries(emp, log).collect()} == {
        1: D("110.26"), 2: D("50.00")}


def test_backfill_guards(spark):
    columns = "employee_id int, first_name string, last_name string, attrition string, over_time string, years_at_company int"
    dim = spark.createDataFrame([(1, None, "old", "No", "No", 1), (2, "f", "l", None, "Yes", 9), (3, None, None, None, None, None)], columns)
    src = spark.createDataFrame([(1, "F", "L", "Yes", "Yes", 5), (2, "F", "L", "Yes", "No", 5)], columns)
    got = {r["employee_id"]: tuple(r)[1:] for r in scd2.backfill_nulls(dim, src).collect()}
    assert got == {1: ("F", "L", "No", "No", 1), 2: ("f", "l", "Yes", "No", 5), 3: (None,) * 5}


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_asof_takes_the_version_of_the_day(spark, hot_rows):
    dim = dim_of(spark, (1, 1, "A", 1, D1, D2, 0), (2, 1, "B", 2, D2, D2, 0), (3, 1, "C", 3, D2, dt.date(2021, 6, 1), 0),
                 (4, 1, "D", 4, D3, None, 1))
    days = [dt.date(2019, 12, 31), D1, dt.date(2020, 12, 31), D2, dt.date(2021, 6, 1), D3]
    events = spark.createDataFrame([(i, 1, d) for i, d in enumerate(days)] + [(99, 2, D1)], "id int, employee_id int, day date")
    got = scd2.asof_version_join(events, dim, "day", ["id"], ["surrogate_key"], hot_rows)
    assert {r["id"]: r["surrogate_key"] for r in got.collect()} == {0: None, 1: 1, 2: 1, 3: 3, 4: None, 5: 4, 99: None}


def test_integrity_names_each_fault(spark):
    rows = [
        (1, 1, "A", 1, D1, None, 1), (2, 1, "A", 1, D2, None, 1),  # two current, first overlaps
        (3, 2, "A", 1, D1, D2, 1),  # current but ended
        (4, 3, "A", 1, D2, D1, 0),  # ends before it starts
        (5, 4, "A", 1, D1, D2, 0), (6, 4, "A", 1, D3, None, 1),  # gap
        (7, 5, "A", 1, D1, D2, 0), (8, 5, "A", 1, D2, None, 1),  # sound
    ]
    for hot_rows in (1, 10**6):
        got = {r["employee_id"]: tuple(r)[1:] for r in quality.scd2_integrity(dim_of(spark, *rows), hot_rows).collect()}
        assert got == {1: (1, 0, 0, 1, 0), 2: (0, 1, 0, 0, 0), 3: (0, 0, 1, 0, 0), 4: (0, 0, 0, 0, 1)}


def test_history_feed(spark):
    feed = spark.createDataFrame(
        [("u", "5", "Sales", "Manager", "2", "4000", "3", "1", "4", "2020-01-01", None, "1")],
        ", ".join(f"{c} string" for c in ["SurrogateKey", *schemas.HISTORY_FEED]))
    row = scd2.conform_history(feed).first()
    assert (row["employee_id"], row["monthly_income"], row["start_date"], row["end_date"], row["is_current"]) == (
        5, D("4000.00"), D1, None, 1)


@pytest.mark.parametrize("hot_rows", [3, 7, 1000])
def test_events_without_an_employee_are_one_sequence_hot_or_cold(spark, hot_rows):
    events = [(i, None if i % 3 else 1, dt.datetime(2020, 1, 1) + dt.timedelta(hours=i), D(100 + 2 * i)) for i in range(40)]
    log = spark.createDataFrame(events, "event_id int, employee_id int, change_ts timestamp, new_salary decimal(10,2)")
    want = []
    for key in (None, 1):
        held = None
        for i, k, _, salary in events:
            if k == key and (held is None or abs(salary - held) * 20 > held):
                held = salary
                want.append(i)
    got = scd2.versions_from_log(log, "last_version", hot_rows)
    assert sorted(r["event_id"] for r in got.collect()) == sorted(want)
    chained = scd2.scd2_from_change_log(log, "last_version", hot_rows).collect()
    assert sum(r["is_current"] for r in chained) == 2 and len(chained) == len(want)


def test_runs_of_segments_do_not_change_the_fold(spark, monkeypatch):
    events = [(i, 1 + i % 2, dt.datetime(2020, 1, 1) + dt.timedelta(hours=i), D(1000 + (i * 37) % 113)) for i in range(120)]
    log = spark.createDataFrame(events, "event_id int, employee_id int, change_ts timestamp, new_salary decimal(10,2)")
    want = sorted(scd2.versions_from_log(log).collect())
    fold = scd2._fold_hot
    monkeypatch.setattr(scd2, "_fold_hot", lambda part: fold(part, run=3))
    assert sorted(scd2.versions_from_log(log, hot_rows=4).collect()) == want
