"""States that add up, sketches with a bounded error, the search index and overlapping versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tenurelake.operators import scd2
from tenurelake.plans import browse, marts, rollups, search

FACT = ("surrogate_key bigint, dept_key bigint, employee_id int, review_year int, performance_rating int, job_satisfaction int,"
        " work_life_balance int, attrition_flag int")


@pytest.fixture(scope="module")
def star(spark):
    draw = random.Random(1)
    rows = [(k % 90, k % 3, draw.choice([None, 5, 40_000, *range(60)]), 2000 + k % 4, draw.randint(1, 4),
             draw.choice([None, 1, 4]), draw.randint(1, 4), k % 2) for k in range(2000)]
    fact = spark.createDataFrame(rows, FACT)
    dept = spark.createDataFrame([(0, "A"), (1, "B"), (2, "B")], "dept_key bigint, department_name string")
    emp = spark.createDataFrame([(k, k % 60, k * 10.0, int(k % 5 > 0)) for k in range(90)],
                                "surrogate_key bigint, employee_id int, monthly_income double, is_current int")
    return fact, emp.withColumn("monthly_income", F.col("monthly_income").cast("decimal(10,2)")), dept


@pytest.mark.parametrize("full", [True, False])
def test_yearly_states_add_up(star, full):
    fact, _, dept = star
    parts = [rollups.yearly_state(fact.filter(F.col("performance_rating") == k)) for k in (1, 2, 3, 4)]
    merged = rollups.merge_yearly(parts[0].unionByName(parts[1]))
    states = merged.unionByName(parts[2]).unionByName(parts[3])
    assert rollups.yoy_from_state(states, dept, full).collect() == marts.yoy_performance(fact, dept, full).collect()


def test_version_states_add_up(star):
    fact, emp, dept = star
    parts = [rollups.version_state(fact.filter(F.col("review_year") % 2 == k)) for k in (0, 1)]
    got = rollups.kpis_from_state(parts[0].unionByName(parts[1]), emp, dept, with_total=True)
    assert got.collect() == marts.department_kpis(fact, emp, dept, with_total=True).collect()


def test_sketched_quartiles_are_near_the_exact_ones(spark):
    dim = spark.range(200_000).select(
        F.lit("A").alias("department_name"), ((F.col("id") * 7919 % 200_000) + 1).cast("decimal(10,2)").alias("monthly_income"),
        F.lit(1).alias("is_current"), F.col("id"),
    )
    parts = [rollups.salary_sketch(dim.filter(F.col("id") % 4 == k)) for k in range(4)]
    whole = rollups.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]))
    row = rollups.box_from_sketch(whole).first()
    assert (row["min_salary"], row["max_salary"], row["employees"]) == (1.0, 200_000.0, 200_000)
    for name, q in (("q1_salary", 0.25), ("median_salary", 0.5), ("q3_salary", 0.75)):
        assert abs(row[name] / 200_000 - q) < 0.01  # salaries are the ranks
    assert len(whole.first()["sketch"]) < 60_000


def test_few_salaries_are_sketched_exactly(spark):
    dim = spark.range(1, 102).selectExpr("'A' as department_name", "cast(id as decimal(10,2)) as monthly_income", "1 as is_current")
    assert rollups.box_from_sketch(rollups.salary_sketch(dim)).collect() == marts.salary_box(dim).collect()


@pytest.mark.parametrize("keyword", ["ann", "AN", "a%b", "x_y", "nn@c", "", "%", "anna%nn", "é", "ééa", "zzz", "İst", "a\\\\_b"])
def test_search_by_index_equals_search(spark, tmp_path, keyword):
    names = ["Ann", "anna", "Bann", "x1y", "ÉÉA", "a_b", "İstanbul", "", None, "annna nn", "ab"]
    emp = spark.createDataFrame(
        [(k, n, names[(k * 3 + 1) % len(names)], f"{n}@c.d", "role", 10, 5, "No") for k, n in enumerate(names * 2)],
        "employee_id int, first_name string, last_name string, email string, job_role string, department_id int, monthly_income int, attrition string")
    dept = spark.createDataFrame([(10, "D")], "department_id int, department_name string")
    search.build_index(emp.filter("employee_id < 15"), f"{tmp_path}/i")
    search.build_index(emp.filter("employee_id >= 15"), f"{tmp_path}/i", "append")
    got = search.search_indexed(emp, dept, keyword, f"{tmp_path}/i").collect()
    assert sorted(got, key=str) == sorted(browse.employee_search(emp, dept, keyword).collect(), key=str)


def test_search_reads_the_folders_of_its_pieces_only(spark, tmp_path):
    emp = spark.range(300).selectExpr("cast(id as int) as employee_id", "concat('n', id * 7919) as first_name", "'x' as last_name",
                                      "'y' as email", "'role' as job_role")
    search.build_index(emp, f"{tmp_path}/i")
    found = search.candidates(spark, f"{tmp_path}/i", "n7919")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and found.count() < 10
    files = {r[0].rsplit("/", 2)[-2] for r in spark.read.parquet(f"{tmp_path}/i").filter(
        F.col("piece").isin(search.keyword_pieces("n7919"))).select(F.input_file_name()).distinct().collect()}
    assert len(files) <= 3


@pytest.mark.parametrize("bin_days", [1, 7, 64, 10_000])
def test_every_valid_version_is_met(spark, bin_days):
    draw, base = random.Random(4), dt.date(2020, 1, 1)
    day = lambda k: None if k is None else base + dt.timedelta(days=k)
    events = [(k, draw.choice([None, 1, 1, 1, 2, 3]), day(draw.choice([None, *range(300)]))) for k in range(120)]
    versions = []
    for v in range(60):
        start = draw.choice([None, *range(-400, 350)])
        end = None if start is None or draw.random() < 0.3 else start + draw.randint(-5, 200)
        versions.append((v, draw.choice([1, 1, 2]), day(start), day(end)))
    e = spark.createDataFrame(events, "event int, employee_id int, at date")
    d = spark.createDataFrame(versions, "version int, employee_id bigint, start_date date, end_date date")
    got = sorted(scd2.asof_all_versions(e, d, "at", ["version"], bin_days).select("event", "version").collect(), key=str)
    want = []
    for k, emp, at in events:
        met = [v for v, owner, a, z in versions if at and a and owner == emp and a <= at and (z is None or at < z)]
        want += [(k, v) for v in met or [None]]
    assert [tuple(r) for r in got] == sorted(want, key=lambda x: str(scd2_row(*x)))
    empty = e.limit(0)
    assert scd2.asof_all_versions(empty, d, "at", ["version"], bin_days).count() == 0


def scd2_row(event, version):
    from pyspark.sql import Row

    return Row(event=event, version=version)
