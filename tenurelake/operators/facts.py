"""The review fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenurelake.functions import scalars as S
from tenurelake.operators import dims, scale
from tenurelake.session import checkpointed

MEASURES = [
    "performance_rating", "job_satisfaction", "environment_satisfaction",
    "relationship_satisfaction", "work_life_balance", "job_involvement",
]


def bind_employees(
    emp: DataFrame, dept: DataFrame, dim_emp: DataFrame, dim_dept: DataFrame
) -> DataFrame:
    """Per employee: the dimension keys and the attributes a review takes over at load time.

    Only employees with a known department and a current version appear; more than one current
    version gives more than one row.
    """
    live = dim_emp.filter(F.col("is_current") == 1).select("employee_id", "surrogate_key")
    depts = dept.select("department_id").join(
        dim_dept.select("department_id", "dept_key"), "department_id"
    )
    return (
        emp.select(
            "employee_id", "department_id", F.col("monthly_income").alias("monthly_income_at_review"),
            "percent_salary_hike", "years_at_company", "training_times_last_year",
            F.when(F.col("attrition") == "Yes", 1).otherwise(0).alias("attrition_flag"),
        )
        .join(scale.small(depts), "department_id")
        .join(scale.shuffled(live), "employee_id")
        .drop("department_id")
    )


def load_fact_reviews(
    reviews: DataFrame, emp: DataFrame, dept: DataFrame, dim_emp: DataFrame, dim_dept: DataFrame,
    fact: DataFrame | None = None, number: bool = True, after: int | None = None,
) -> DataFrame:
    """Fact rows of the reviews not loaded yet, numbered after ``after`` (the largest number of ``fact``).

    Where the ids of loaded reviews are kept in buckets (``sources.buckets.KeyBuckets``), give the new
    reviews and no ``fact``: the history is then neither shuffled nor read.

    Reviews bind to the employee's current version, not to the one valid at the review date
    (see ``asof_version_join``); the project key stays NULL. The employee side is assembled first
    and is employee-sized, so the reviews are shuffled once per join key and no more. The rows are
    written once before they are numbered, so the joins are not repeated.
    """
    fresh = reviews if fact is None else dims.new_rows(reviews, fact, "review_id")
    bound = scale.shuffled(bind_employees(emp, dept, dim_emp, dim_dept))
    rows = fresh.join(bound, "employee_id").select(
        "surrogate_key", "dept_key", F.lit(None).cast("bigint").alias("project_key"),
        S.date_key(F.col("review_date")).alias("date_key"), "employee_id", "review_id", *MEASURES,
        "monthly_income_at_review", "percent_salary_hike", "years_at_company",
        "training_times_last_year", "review_year", "review_quarter", "attrition_flag",
    )
    if not number:
        return rows
    rows = checkpointed(rows)
    if after is None:
        after = dims.max_key(fact, "fact_id") if fact is not None and "fact_id" in fact.columns else 0
    return dims.assign_surrogate(rows, "review_id", "fact_id", after, ["surrogate_key", "dept_key"])
