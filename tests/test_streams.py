"""Streams over several micro-batches."""

import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tenurelake.operators import facts, scd2
from tenurelake.streaming import feeds, merged, stateful


def write_in_order(batches, folder, schema, spark):
    """Files become micro-batches in the order of their modification time."""
    import os

    for i, rows in enumerate(batches):
        path = f"{folder}/part{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            if name.endswith(".parquet"):
                os.makedirs(f"{folder}/in", exist_ok=True)
                os.rename(f"{path}/{name}", f"{folder}/in/{i}.parquet")
                os.utime(f"{folder}/in/{i}.parquet", (1000 + i, 1000 + i))
    return f"{folder}/in"


REVIEW = ("review_id int, employee_id int, review_date date, review_year int, review_quarter int, " +
          ", ".join(f"{c} int" for c in facts.MEASURES))


def review(rid, day, rating=3, emp=1):
    day = dt.date(2020, 1, 1) + dt.timedelta(days=day)
    return (rid, emp, day, day.year, 1, rating, 3, 3, 3, 3, 3)


@pytest.fixture
def company(spark):
    emp = spark.createDataFrame([(1, 10, D("9.00"), 1, 2, 3, "No"), (2, 10, D("9.00"), 1, 2, 3, "No")],
                                "employee_id int, department_id int, monthly_income decimal(10,2), percent_salary_hike int,"
                                " years_at_company int, training_times_last_year int, attrition string")
    dept = spark.createDataFrame([(10, "A")], "department_id int, department_name string")
    dim = spark.createDataFrame([(5, 1, 1), (6, 2, 1)], "surrogate_key bigint, employee_id int, is_current int")
    return emp, dept, dim, spark.createDataFrame([(7, 10)], "dept_key bigint, department_id int")


def test_reviews_across_batches(spark, tmp_path, company):
    folder = write_in_order([
        [review(1, 0), review(1, 0), review(2, 1, rating=9)],
        [review(3, 100), review(1, 100), review(2, 1, rating=9)],  # 1 and 2 again
        [review(5, 101)],
        [review(4, 10)],  # long after later ones
        [review(3, 102), review(6, 103)],
    ], tmp_path, REVIEW, spark)
    read = lambda: feeds.read_stream(spark, folder, spark.createDataFrame([], REVIEW).schema, max_files=1)
    feeds.stream_reviews(read(), *company, f"{tmp_path}/out")
    loaded = spark.read.parquet(f"{tmp_path}/out/fact")
    assert sorted(r["review_id"] for r in loaded.collect()) == [1, 3, 4, 5, 6]
    assert [r["review_id"] for r in spark.read.parquet(f"{tmp_path}/out/quarantine").collect()] == [2]
    # a second run has nothing left to do
    feeds.stream_reviews(read(), *company, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/fact").count() == 5


LOG = "event_id int, employee_id int, change_ts timestamp, new_salary decimal(10,2)"


def change(i, emp, salary):
    return (i, emp, dt.datetime(2020, 1, 1) + dt.timedelta(hours=i), D(str(salary)))


@pytest.mark.parametrize("hot_rows", [4, 1000])
@pytest.mark.parametrize("files", [1, 3, 7])
def test_salary_versions_equal_batch_in_any_order(spark, tmp_path, files, hot_rows):
    events = [change(i, i % 3, 1000 + (i * 37) % 97) for i in range(60)]
    shuffled = sorted(events, key=lambda e: e[0] * 7919 % 61)
    folder = write_in_order([shuffled[k::files] for k in range(files)], tmp_path, LOG, spark)
    stream = feeds.read_stream(spark, folder, spark.createDataFrame([], LOG).schema, max_files=1)
    feeds.stream_salary_versions(stream, f"{tmp_path}/out", hot_rows)
    got = feeds.salary_versions(spark, f"{tmp_path}/out")
    want = scd2.versions_from_log(spark.createDataFrame(events, LOG))
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())
    assert 3 < want.count() < 60


def test_a_late_change_moves_the_versions_after_it(spark, tmp_path):
    folder = write_in_order([[change(1, 1, 100), change(9, 1, 104)], [change(5, 1, 200)]], tmp_path, LOG, spark)
    stream = feeds.read_stream(spark, folder, spark.createDataFrame([], LOG).schema, max_files=1)
    feeds.stream_salary_versions(stream, f"{tmp_path}/out")
    assert sorted(r["event_id"] for r in feeds.salary_versions(spark, f"{tmp_path}/out").collect()) == [1, 5, 9]


def test_trend_holds_late_rows_and_open_windows(spark, tmp_path, company):
    folder = write_in_order([
        [review(1, 0, 4), review(2, 1, 1, emp=2), review(3, 40)], [review(5, 90)], [review(4, 2), review(6, 91)],
    ], tmp_path, REVIEW, spark)
    stream = feeds.read_stream(spark, folder, spark.createDataFrame([], REVIEW).schema, max_files=1)
    feeds.stream_rating_trend(stream, company[0], company[1], f"{tmp_path}/out")
    rows = feeds.rating_trend(spark, f"{tmp_path}/out").orderBy("window_start").collect()
    assert sum(r["reviews"] for r in rows) == 6
    assert sum(r["avg_rating"] * r["reviews"] for r in rows) == pytest.approx(4 + 1 + 3 + 3 + 3 + 3, abs=0.02)


def fates(spark, out, *kinds):
    return {k: spark.read.parquet(f"{out}/{k}").count() for k in kinds}


def test_every_review_is_in_fact_quarantine_or_pending(spark, tmp_path, company):
    batches = [
        [review(None, 0), review(None, 0), review(None, 1), review(1, 0), review(2, 1, rating=9), review(3, 2, emp=77)],
        [review(None, 5), review(None, 6), review(4, 6, emp=77), review(3, 2, emp=77), review(5, 7)],
    ]
    folder = write_in_order(batches, tmp_path, REVIEW, spark)
    emp, dept, dim, dim_dept = company
    out, schema = f"{tmp_path}/out", spark.createDataFrame([], REVIEW).schema
    feeds.stream_reviews(feeds.read_stream(spark, folder, schema, max_files=1), emp, dept, dim, dim_dept, out)
    assert fates(spark, out, "fact", "quarantine") == {"fact": 2, "quarantine": 6}
    assert sorted(r["review_id"] for r in feeds.pending_reviews(spark, out).collect()) == [3, 4]
    # the employee is hired: the next batch takes the pending reviews along, and a copy of one is a repetition
    hired = spark.createDataFrame([(77, 10, D("9.00"), 1, 2, 3, "No")], emp.schema)
    known = dim.unionByName(spark.createDataFrame([(8, 77, 1)], dim.schema))
    write_in_order([[review(4, 6, emp=77), review(6, 8)]], f"{tmp_path}/more", REVIEW, spark)
    import os
    import shutil

    shutil.copy(f"{tmp_path}/more/in/0.parquet", f"{folder}/9.parquet")
    os.utime(f"{folder}/9.parquet", (5000, 5000))
    feeds.stream_reviews(feeds.read_stream(spark, folder, schema, max_files=1), emp.unionByName(hired), dept, known, dim_dept, out)
    assert sorted(r["review_id"] for r in spark.read.parquet(f"{out}/fact").collect()) == [1, 3, 4, 5, 6]
    assert feeds.pending_reviews(spark, out).count() == 0


def test_trend_places_reviews_once_their_employee_is_known(spark, tmp_path, company):
    folder = write_in_order([[review(1, 0, 4), review(2, 1, 2, emp=77)]], tmp_path, REVIEW, spark)
    emp, dept, out = company[0], company[1], f"{tmp_path}/out"
    feeds.stream_rating_trend(feeds.read_stream(spark, folder, spark.createDataFrame([], REVIEW).schema), emp, dept, out)
    told = lambda *a: {r["department_name"]: r["reviews"] for r in feeds.rating_trend(spark, out, *a).collect()}
    assert told() == {"A": 1, None: 1}
    hired = emp.unionByName(spark.createDataFrame([(77, 10, D("9.00"), 1, 2, 3, "No")], emp.schema))
    assert told(hired, dept) == {"A": 2}


@pytest.mark.parametrize("files", [1, 4])
def test_state_folds_changes_in_order_and_sets_late_ones_aside(spark, tmp_path, files):
    events = sorted([change(i, i % 3, 1000 + (i * 37) % 97) for i in range(60)], key=lambda e: e[2])
    size = 60 // files
    late = [change(100, 0, 5000)[:2] + (dt.datetime(2019, 1, 1), D("5000")), change(101, 9, 70)]
    folder = write_in_order([*[events[k * size : k * size + size] for k in range(files)], late], tmp_path, LOG, spark)
    stream = feeds.read_stream(spark, folder, spark.createDataFrame([], LOG).schema, max_files=1)
    stateful.stream_salary_state(stream, f"{tmp_path}/out")
    want = scd2.versions_from_log(spark.createDataFrame([*events, late[1]], LOG)).select("employee_id", "change_ts", "event_id", "monthly_income")
    got = stateful.salary_changes(spark, f"{tmp_path}/out", stateful.VERSION)
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())
    assert [r["event_id"] for r in stateful.salary_changes(spark, f"{tmp_path}/out", stateful.LATE).collect()] == [100]


def test_window_holds_back_late_and_repeated_reviews(spark, tmp_path, company):
    batches = [
        [review(1, 0), review(2, 10)], [review(3, 100), review(3, 100), review(None, 90)], [review(8, 101)],
        [review(4, 20), review(3, 100), review(5, 95), review(1, 0)], [review(6, 99, emp=77), review(7, 99, rating=0)],
    ]
    folder = write_in_order(batches, tmp_path, REVIEW, spark)
    stream = feeds.read_stream(spark, folder, spark.createDataFrame([], REVIEW).schema, max_files=1)
    stateful.stream_reviews_window(stream, *company, f"{tmp_path}/out", delay_days=30)
    held = spark.read.parquet(f"{tmp_path}/out/held").collect()
    assert sorted((r["review_id"], r["reason"]) for r in held) == [(1, "late"), (3, "repeated"), (3, "repeated"), (4, "late")]
    assert sorted(r["review_id"] for r in spark.read.parquet(f"{tmp_path}/out/fact").collect()) == [1, 2, 3, 5, 8]
    assert feeds.pending_reviews(spark, f"{tmp_path}/out").count() == 1
    assert fates(spark, f"{tmp_path}/out", "quarantine") == {"quarantine": 2}


def test_window_state_is_bounded(spark, tmp_path, company):
    """Ids whose time has passed leave the state."""
    folder = write_in_order([[review(100 * k + i, 200 * k) for i in range(20)] for k in range(4)], tmp_path, REVIEW, spark)
    stream = feeds.read_stream(spark, folder, spark.createDataFrame([], REVIEW).schema, max_files=1)
    stateful.stream_reviews_window(stream, *company, f"{tmp_path}/out", delay_days=30)
    held = spark.read.format("statestore").load(f"{tmp_path}/out/_checkpoint").count()
    assert 0 < held <= 40


def test_windows_stay_open_until_the_watermark_passes(spark, tmp_path, company):
    folder = write_in_order([[review(1, 0, 4), review(2, 1, 2)], [review(3, 100, 3)], [review(6, 100, 3)], [review(4, 0, 1), review(5, 90, 1)]], tmp_path, REVIEW, spark)
    stream = feeds.read_stream(spark, folder, spark.createDataFrame([], REVIEW).schema, max_files=1)
    stateful.stream_trend_window(stream, company[0], company[1], f"{tmp_path}/out", delay_days=30)
    rows = sorted((r["window_start"], r["reviews"], r["is_open"]) for r in stateful.windowed_trend(spark, f"{tmp_path}/out").collect())
    assert [r[1:] for r in rows] == [(2, False), (3, True)]  # the review of day 0 came after its window had closed


def batches_of(folder):
    return sorted(int(f.split("=")[1]) for f in os.listdir(folder) if "=" in f)


def test_merged_sums_and_versions_read_the_same(spark, tmp_path, company):
    emp, dept = company[:2]
    folder = write_in_order([[review(k, k, 1 + k % 4, emp=1 + k % 3)] for k in range(6)], tmp_path, REVIEW, spark)
    out, schema = f"{tmp_path}/out", spark.createDataFrame([], REVIEW).schema
    feeds.stream_rating_trend(feeds.read_stream(spark, folder, schema, max_files=1), emp, dept, out)
    before = sorted(feeds.rating_trend(spark, out).collect(), key=str)
    feeds.merge_trend(spark, out)
    assert batches_of(f"{out}/sums") == [] and batches_of(f"{out}/sums.merged") == [5]
    assert sorted(feeds.rating_trend(spark, out).collect(), key=str) == before
    feeds.merge_trend(spark, out)  # nothing new
    # later batches count beside the merge, and go into the next one
    write_in_order([[review(9, 1, 4)]], tmp_path / "more", REVIEW, spark)
    os.rename(tmp_path / "more/in/0.parquet", f"{folder}/9.parquet")
    feeds.stream_rating_trend(feeds.read_stream(spark, folder, schema, max_files=1), emp, dept, out)
    total = lambda: sum(r["reviews"] for r in feeds.rating_trend(spark, out).collect())
    assert batches_of(f"{out}/sums") == [6] and total() == 7
    feeds.merge_trend(spark, out)
    assert batches_of(f"{out}/sums.merged") == [6] and total() == 7


def test_a_merge_that_breaks_off_changes_nothing(spark, tmp_path, company, monkeypatch):
    emp, dept = company[:2]
    folder = write_in_order([[review(k, k)] for k in range(3)], tmp_path, REVIEW, spark)
    out, schema = f"{tmp_path}/out", spark.createDataFrame([], REVIEW).schema
    feeds.stream_rating_trend(feeds.read_stream(spark, folder, schema, max_files=1), emp, dept, out)
    total = lambda: sum(r["reviews"] for r in feeds.rating_trend(spark, out).collect())
    fail = lambda sums: sums.withColumn("n", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception):
        merged.merge(spark, out, "sums", fail)
    assert total() == 3 and batches_of(f"{out}/sums") == [0, 1, 2]
    # merged, but no batch removed yet
    with monkeypatch.context() as patch:
        patch.setattr(merged, "_clear", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            feeds.merge_trend(spark, out)
    assert total() == 3 and batches_of(f"{out}/sums") == [0, 1, 2]
    feeds.merge_trend(spark, out)
    assert total() == 3 and batches_of(f"{out}/sums") == []


def test_a_batch_that_was_not_committed_is_not_merged(spark, tmp_path, company):
    folder = write_in_order([[review(k, k, emp=77 if k == 1 else 1)] for k in range(3)], tmp_path, REVIEW, spark)
    out, schema = f"{tmp_path}/out", spark.createDataFrame([], REVIEW).schema
    run = lambda: feeds.stream_reviews(feeds.read_stream(spark, folder, schema, max_files=1), *company, out)
    run()
    for name in ("2", ".2.crc"):  # as if the job had ended before it noted the last batch
        os.remove(f"{out}/_checkpoint/commits/{name}")
    feeds.merge_reviews(spark, out)
    assert batches_of(f"{out}/ids") == [2] and batches_of(f"{out}/ids.merged") == [1]
    assert batches_of(f"{out}/pending") == [1, 2]
    run()  # repeats batch 2
    assert fates(spark, out, "fact", "quarantine") == {"fact": 2, "quarantine": 0}
    assert [r["review_id"] for r in feeds.pending_reviews(spark, out).collect()] == [1]
    feeds.merge_reviews(spark, out)
    # ids seen are known from the merge
    write_in_order([[review(0, 0), review(8, 0)]], tmp_path / "more", REVIEW, spark)
    os.rename(tmp_path / "more/in/0.parquet", f"{folder}/9.parquet")
    run()
    assert sorted(r["review_id"] for r in spark.read.parquet(f"{out}/fact").collect()) == [0, 2, 8]


def test_merging_before_the_first_batch(spark, tmp_path):
    for merge in (feeds.merge_reviews, feeds.merge_salaries, feeds.merge_trend):
        merge(spark, f"{tmp_path}/none")


def test_no_join_sends_the_employees_through_the_driver(spark, sf_dir):
    """Only departments are broadcast, however small Spark takes the employees' files to be."""
    from tenurelake.catalog.fixtures import view
    from tenurelake.operators import facts

    v = [view(spark, sf_dir, f"hr_{n}") for n in ("reviews", "employees_raw", "departments", "dim_employee", "dim_department")]
    lines = facts.load_fact_reviews(*v, number=False)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    sent = []
    for n, line in enumerate(lines):
        if "BroadcastExchange" in line:
            inside = next((k for k, x in enumerate(lines[n + 1:], n + 1) if depth(x) <= depth(line)), len(lines))
            sent += lines[n:inside]
    assert sent and not any("custkey" in line for line in sent)
