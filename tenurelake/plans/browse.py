"""Browse queries of the operational tables and enriched entity rows.

Functions that look up one id return every id when it is omitted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tenurelake.functions import scalars as S


def with_department(df: DataFrame, dept: DataFrame, how: str = "inner") -> DataFrame:
    return df.join(dept.select("department_id", "department_name"), "department_id", how)


def _one(df: DataFrame, column: str, value: int | None) -> DataFrame:
    return df if value is None else df.filter(F.col(column) == value)


def departments(dept: DataFrame) -> DataFrame:
    return dept.select("department_id", "department_name", "location").orderBy("department_name")


def department_by_id(dept: DataFrame, department_id: int) -> DataFrame:
    return dept.filter(F.col("department_id") == department_id).limit(1)


def employee_directory(emp: DataFrame, dept: DataFrame, active_only: bool = True) -> DataFrame:
    if active_only:
        emp = emp.filter("is_active")
    return with_department(emp, dept).select(
        "employee_id", "first_name", "last_name", S.full_name().alias("full_name"), "email", "gender",
        "age", "department_name", "job_role", "job_level", "monthly_income", "attrition", "over_time",
        "years_at_company", "hire_date", "is_active",
    ).orderBy("last_name", "first_name", "employee_id")


def employee_detail(emp: DataFrame, dept: DataFrame, employee_id: int | None = None) -> DataFrame:
    found = _one(emp, "employee_id", employee_id).alias("e")
    named = dept.select("department_id", "department_name").alias("d")
    return found.join(named, F.col("e.department_id") == F.col("d.department_id")).select(
        "e.*", "d.department_name"
    )


SEARCHED = ["first_name", "last_name", "email", "job_role"]


def employee_search(emp: DataFrame, dept: DataFrame, keyword: str) -> DataFrame:
    """Employees whose name, e-mail or role contains ``keyword`` in any case; ``%`` and ``_`` in it
    are wildcards."""
    hit = reduce(lambda a, b: a | b, [F.col(c).ilike(f"%{keyword}%") for c in SEARCHED])
    return with_department(emp.filter(hit), dept).select(
        "employee_id", S.full_name().alias("full_name"), "email", "job_role", "department_name",
        "monthly_income", "attrition",
    )


def projects(proj: DataFrame, dept: DataFrame) -> DataFrame:
    """Projects, newest first, with their department if they have one."""
    return with_department(proj, dept, "left").select(*proj.columns, "department_name").orderBy(
        F.col("start_date").desc(), "project_id"
    )


def project_by_id(proj: DataFrame, project_id: int) -> DataFrame:
    return proj.filter(F.col("project_id") == project_id).limit(1)


def project_assignments(
    assignments: DataFrame, emp: DataFrame, dept: DataFrame, project_id: int | None = None
) -> DataFrame:
    """Assignments with the assigned employee's name, role and department."""
    who = with_department(emp, dept).select(
        "employee_id", S.full_name().alias("employee_name"), "job_role", "department_name"
    )
    return _one(assignments, "project_id", project_id).join(who, "employee_id").select(
        *assignments.columns, "employee_name", "job_role", "department_name"
    )


def with_reviewer(reviews: DataFrame, emp: DataFrame) -> DataFrame:
    """Reviews with their reviewer's name, NULL where there is none.

    Reviews without a reviewer skip the join: their NULL keys would all meet in one task.
    """
    names = emp.select(F.col("employee_id").alias("_rid"), S.full_name().alias("reviewer_name"))
    known = reviews.filter(F.col("reviewer_id").isNotNull())
    signed = known.join(names, F.col("reviewer_id") == F.col("_rid"), "left").drop("_rid")
    unsigned = reviews.filter(F.col("reviewer_id").isNull()).withColumn(
        "reviewer_name", F.lit(None).cast("string")
    )
    return signed.unionByName(unsigned)


def reviews_by_employee(
    reviews: DataFrame, emp: DataFrame, employee_id: int | None = None
) -> DataFrame:
    return with_reviewer(_one(reviews, "employee_id", employee_id), emp).orderBy(
        "employee_id", F.col("review_date").desc(), "review_id"
    )


def reviews_by_year(reviews: DataFrame, year: int) -> DataFrame:
    return reviews.filter(F.col("review_year") == year).orderBy(F.col("review_date").desc(), "review_id")


def rating_trend(reviews: DataFrame, employee_id: int | None = None) -> DataFrame:
    return _one(reviews, "employee_id", employee_id).select(
        "employee_id", "review_year", "review_id", "performance_rating"
    ).orderBy("employee_id", "review_year", "review_id")


def inventory(emp: DataFrame, dept: DataFrame, dim_emp: DataFrame) -> DataFrame:
    """What the warehouse holds, as (section, item, rows): sizes, then how employees are spread."""
    sizes = dim_emp.agg(
        F.count(F.lit(1)).alias("history rows"),
        F.count_distinct("employee_id").alias("employees with history"),
        F.count_if(F.col("is_current") == 1).alias("current records"),
        F.count_if(F.col("is_current") == 0).alias("historical records"),
    )
    names = sizes.columns
    unpivoted = sizes.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("item"), F.col(n).alias("rows")) for n in names
    ])).alias("_r")).select(F.lit("size").alias("section"), "_r.*")
    snapshot = emp.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("size").alias("section"), F.lit("snapshot rows").alias("item"), "rows"
    )
    by_dept = with_department(emp, dept).groupBy(F.col("department_name").alias("item")).agg(
        F.count(F.lit(1)).alias("rows")
    ).select(F.lit("department").alias("section"), "item", "rows")
    by_level = emp.groupBy(F.col("job_level").cast("string").alias("item")).agg(
        F.count(F.lit(1)).alias("rows")
    ).select(F.lit("job level").alias("section"), "item", "rows")
    return reduce(DataFrame.unionByName, [snapshot, unpivoted, by_dept, by_level])


def enrich_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id", "employee_id", "reviewer_id", F.col("review_date").cast("string").alias("review_date"),
        "review_year", "review_quarter", *S.SCORE_COLUMNS,
        S.rating_label().alias("rating_label"), S.overall_score().alias("overall_score"),
    )


def enrich_employees(emp: DataFrame) -> DataFrame:
    return emp.withColumns({
        "full_name": S.full_name(), "annual_income": S.annual_income(),
        "hire_date": F.col("hire_date").cast("string"),
    })


def enrich_projects(proj: DataFrame) -> DataFrame:
    return proj.withColumns({
        "is_active": F.coalesce(F.col("status") == "Active", F.lit(False)),
        "duration_days": S.duration_days("start_date", "end_date"),
    }).withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})


def enrich_assignments(assignments: DataFrame) -> DataFrame:
    return assignments.withColumns(
        {c: F.col(c).cast("string") for c in ("assigned_date", "released_date")}
    )


def sample_exact(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in seeded random order: the same ones however the data is partitioned."""
    shuffled = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.orderBy(shuffled, key).limit(n)


def first_n(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)
