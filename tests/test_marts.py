"""Marts on hand-made stars: ties, fan-out, gaps and NULLs."""

import datetime as dt
from decimal import Decimal as D

import pytest

from tenurelake.plans import marts

FACT = ("surrogate_key bigint, dept_key bigint, employee_id int, review_year int, performance_rating int,"
        " job_satisfaction int, work_life_balance int, environment_satisfaction int, attrition_flag int")
EMP = ("surrogate_key bigint, employee_id int, first_name string, last_name string, department_name string, job_role string,"
       " job_level int, monthly_income decimal(10,2), over_time string, attrition string, years_at_company int,"
       " start_date date, end_date date, is_current int")


def fact(spark, *rows):
    return spark.createDataFrame([(k, d, e, y, p, s, s, s, a) for k, d, e, y, p, s, a in rows], FACT)


def emp(spark, *rows):
    return spark.createDataFrame(
        [(k, e, "f", str(e), d, "r", 1, D(str(i)), ot, at, yrs, dt.date(2020, 1, 1), None, c)
         for k, e, d, i, ot, at, yrs, c in rows], EMP)


@pytest.fixture
def dept(spark):
    return spark.createDataFrame([(1, "A"), (2, "B")], "dept_key bigint, department_name string")


def test_previous_year_is_the_previous_one_with_reviews(spark, dept):
    f = fact(spark, (1, 1, 1, 2018, 4, 1, 0), (1, 1, 1, 2020, 3, 1, 0), (2, 1, 2, 2020, 2, 1, 0), (1, 1, 1, 2020, 2, 1, 0))
    rows = marts.yoy_performance(f, dept).collect()
    assert [(r["review_year"], r["avg_rating"], r["employee_count"], r["prev_year_rating"], r["rating_change"]) for r in rows] == [
        (2018, 4.0, 1, None, None), (2020, 2.33, 2, 4.0, -1.67)]


def test_ties_return_more_than_the_limit(spark):
    e = emp(spark, *[(k, k, "A", 100 * (k % 2), "No", "No", 5, 1) for k in range(1, 7)], (9, 9, "A", 1, "No", "No", 5, 0))
    f = fact(spark, *[(k, 1, k, 2020, 4, 1, 0) for k in range(1, 7)], (9, 1, 9, 2020, 4, 1, 0), (1, 1, 1, 2019, 1, 1, 0))
    assert marts.top_performers(f, e, 2020, 1, tie_break=False).count() == 6
    assert marts.top_performers(f, e, 2020, 1, tie_break=True).count() == 3
    assert marts.top_performers(f, e, None, 1, tie_break=False).count() == 5  # 2019 lowers employee 1


def test_risk_score_and_labels(spark):
    e = emp(spark, (1, 1, "A", 1, "Yes", "No", 1, 1), (2, 2, "A", 1, "No", "No", 9, 1), (3, 3, "A", 1, "No", None, 9, 1),
            (4, 4, "A", 1, "No", "Yes", 9, 1), (5, 5, "A", 1, "No", "No", None, 1))
    f = fact(spark, *[(k, 1, k, 2020, 3, s, 0) for k, s in [(1, 1), (2, 3), (2, 4), (3, 1), (4, 1), (5, 4)]])
    rows = marts.attrition_risk(f, e).collect()
    # 3.5 rounds to 4; unknown tenure adds nothing; unknown attrition is left out
    assert [(r["employee_id"], r["risk_score"], r["risk_category"]) for r in rows] == [
        (1, 17, "High Risk"), (2, 3, "Medium Risk"), (5, 3, "Low Risk")]


def test_kpis_weigh_by_reviews_and_total_does_not(spark, dept):
    e = emp(spark, (1, 1, "A", 100, "No", "Yes", 1, 1), (2, 2, "A", 400, "No", "No", 1, 1), (3, 3, "B", 1000, "No", "No", 1, 1))
    f = fact(spark, *[(1, 1, 1, 2020, 4, 1, 1)] * 3, (2, 1, 2, 2020, 1, 1, 0), (3, 2, 3, 2020, 2, 1, 0))
    rows = {r["department_name"]: r for r in marts.department_kpis(f, e, dept, with_total=True).collect()}
    assert (rows["A"]["headcount"], rows["A"]["avg_salary"], rows["A"]["attrition_count"]) == (2, 175.0, 3)
    assert rows["A"]["attrition_rate_pct"] == 150.0
    assert rows["Company Total"]["avg_salary"] == 587.5 and rows["Company Total"]["total_reviews"] == 5


def test_single_employee_department_ranks_zero(spark):
    e = emp(spark, (1, 1, "A", 100, "No", "No", 1, 1), (2, 2, "B", 1, "No", "No", 1, 1), (3, 3, "B", 2, "No", "No", 1, 1),
            (4, 4, "B", 2, "No", "No", 1, 1))
    got = {r["employee_id"]: (r["salary_percentile"], r["dept_avg_salary"]) for r in marts.salary_distribution(e).collect()}
    assert got == {1: (0.0, 100.0), 2: (0.0, 1.67), 3: (50.0, 1.67), 4: (50.0, 1.67)}


def test_open_versions_end_on_the_day(spark):
    e = emp(spark, (1, 1, "A", 100, "No", "No", 1, 1))
    day = dt.date(2020, 1, 31)
    row = marts.employee_history(e, day, 1).first()
    assert (row["end_date"], row["days_in_role"]) == ("Present", 30)
    assert marts.career_timeline(e, day).first()["end"] == day and marts.employee_history(e, day, 2).count() == 0
