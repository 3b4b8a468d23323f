"""Entity rules on golden rows, audits and duplicates."""

import datetime as dt

from pyspark.sql import functions as F

from tenurelake.functions import scalars as S
from tenurelake.operators import dims, quality

EMP = ("first_name string, last_name string, email string, hire_date date, department_id int, job_role string,"
       " monthly_income decimal(10,2), age int, job_level int, gender string, attrition string, marital_status string,"
       " business_travel string")
DAY = dt.date(2024, 1, 1)


def emp(spark, *rows):
    from decimal import Decimal

    tail = ("Male", "No", "Single", "Travel_Rarely")
    return spark.createDataFrame([(a, b, c, DAY, 1, role, Decimal(i), age, level, *tail)
                                  for a, b, c, role, i, age, level in rows], EMP)


def test_golden_employees(spark):
    good, bad = quality.validate_employees(
        emp(spark, ("A", "B", "a@b.com", "Analyst", 5000, 25, 2), ("", "", "bad", "X", -1, 200, 9))
    ).withColumns({"n": S.full_name(), "y": S.annual_income()}).orderBy(F.desc("first_name")).collect()
    assert good["errors"] == [] and good["n"] == "A B" and good["y"] == 60000
    assert len(bad["errors"]) == 5


def test_null_breaks_a_rule_but_passes_a_check(spark):
    df = spark.createDataFrame([(None, 3, 9)], "age int, job_level int, education int")
    assert {r["rule"]: r["violations"] for r in quality.check_audit(df, "employees").collect()} == {
        "check age": 0, "check job_level": 0, "check education": 1}
    reviews = spark.createDataFrame(
        [(4, None, 1, 1, 1, 5, 2, 1999)],
        ", ".join(f"{c} int" for c in [*S.SCORE_COLUMNS, "review_quarter", "review_year"]))
    assert quality.validate_reviews(reviews).first()["errors"] == [
        "job_satisfaction must be between 1 and 4.", "job_involvement must be between 1 and 4.",
        "Review year seems invalid."]


def test_optional_columns_may_be_null(spark):
    columns = "project_name string, status string, start_date date, end_date date, budget decimal(15,2)"
    df = spark.createDataFrame([("p", "Active", DAY, None, None), ("", "Done", DAY, dt.date(2023, 1, 1), None)], columns)
    assert sorted(len(r["errors"]) for r in quality.validate_projects(df).collect()) == [0, 3]
    valid, broken = quality.split_valid(df, quality.project_rules())
    assert (valid.count(), broken.count()) == (1, 1) and "errors" not in valid.columns


def test_blank_department(spark):
    df = spark.createDataFrame([(" \t",), ("x" * 101,), ("Sales",), (None,)], "department_name string")
    assert sorted(len(r["errors"]) for r in quality.validate_departments(df).collect()) == [0, 1, 1, 1]


def test_labels_and_scores(spark):
    df = spark.createDataFrame([(r, 3, 3, 3, 3, 4) for r in (1, 2, 3, 4, 7)], ", ".join(f"{c} int" for c in S.SCORE_COLUMNS))
    got = df.select(S.rating_label().alias("l"), S.overall_score().alias("s")).collect()
    assert [r["l"] for r in got] == ["Poor", "Below Average", "Good", "Outstanding", "Unknown"]
    assert [r["s"] for r in got] == [2.83, 3.0, 3.17, 3.33, 3.83]


def test_exact_rounding(spark):
    # 199 ones and a two average 1.005: exactly halfway
    df = spark.createDataFrame([(1,)] * 199 + [(2,)], "x int")
    assert df.agg(S.exact_avg(F.sum("x"), F.count("x")).alias("a")).first()["a"] == 1.01
    assert spark.range(1).select(S.safe_pct(F.lit(3), F.lit(0)).alias("p")).first()["p"] is None


def test_duplicates_in_batch_and_target(spark):
    batch = spark.createDataFrame([(1, "A@x.y"), (2, "a@x.Y"), (3, "b@x.y"), (4, "c@x.y")], "id int, email string")
    target = spark.createDataFrame([("B@X.Y",)], "email string")
    accepted, rejected = quality.reject_duplicates(batch, target, "email", ["id"])
    assert sorted(r["id"] for r in accepted.collect()) == [1, 4]
    assert sorted(r["id"] for r in rejected.collect()) == [2, 3]


def test_left_anti_ignores_null_keys(spark):
    """An unguarded NOT IN would return nothing here."""
    src = spark.createDataFrame([(1,), (2,)], "k int")
    assert [r["k"] for r in dims.new_rows(src, spark.createDataFrame([(None,), (1,)], "k int"), "k").collect()] == [2]


def test_calendar(spark):
    days = dims.build_dim_date(spark)
    assert days.count() == 5844 and days.filter("is_weekend").count() == 1670
    row = days.filter("date_key = 20160103").first()
    assert (row["day_of_week"], row["day_name"], row["week_of_year"], row["is_holiday"]) == (1, "Sunday", 53, False)
    assert dims.load_dim_date(days, days.filter("year < 2030")).count() == 365
    orphans = quality.calendar_audit(
        spark.createDataFrame([(DAY,), (dt.date(2031, 1, 1),)], "d date"), "d", days)
    assert [tuple(r) for r in orphans.collect()] == [(20310101, 1)]
