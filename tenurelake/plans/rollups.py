"""Marts kept up to date: each load adds a small state, and marts merge states instead of reading facts.

A state is what a mart needs of some reviews, reduced so that states of disjoint sets of reviews add up
to the state of all. Distinct heads are exact bitmaps, 2^15 employees to one; quartiles are quantile
sketches, which are estimates with a bounded error of rank. States are stored by appending them per load
(``tables.Warehouse.append``) and merged now and then to keep them few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenurelake.functions import scalars as S
from tenurelake.operators import scale
from tenurelake.plans import marts

RATINGS = ["performance_rating", "job_satisfaction", "work_life_balance"]
SKETCH_SIZE = 800  # ranks are off by about half a percent of the rows

_YEARLY = ["review_year", "dept_key", "bucket"]
_SALARIES = ["department_name"]


def yearly_state(fact: DataFrame) -> DataFrame:
    """Per year, department and bucket of employees: rating sums and the bitmap of employees reviewed.

    Reviews without an employee count in the sums, in a bucket of their own without heads.
    """
    return fact.groupBy("review_year", "dept_key", F.bitmap_bucket_number("employee_id").alias("bucket")).agg(
        *marts._sums(RATINGS), F.bitmap_construct_agg(F.bitmap_bit_position("employee_id")).alias("heads")
    )


def merge_yearly(states: DataFrame) -> DataFrame:
    """One state out of many, of the same form."""
    return states.groupBy(*_YEARLY).agg(*marts._merged(RATINGS), F.bitmap_or_agg("heads").alias("heads"))


def yoy_from_state(states: DataFrame, dim_dept: DataFrame, full: bool = True) -> DataFrame:
    """``marts.yoy_performance`` from the states of all its reviews."""
    names = scale.small(dim_dept.select("dept_key", "department_name"))
    # departments of one name are one line: their bitmaps are merged before heads are counted
    named = states.join(names, "dept_key").groupBy("review_year", "department_name", "bucket").agg(
        *marts._merged(RATINGS), F.bitmap_or_agg("heads").alias("heads")
    )
    heads = F.coalesce(F.sum(F.bitmap_count("heads")), F.lit(0)).cast("bigint")
    yearly = named.groupBy("review_year", "department_name").agg(*marts._merged(RATINGS), heads.alias("employee_count"))
    return marts.yoy_of(yearly, full)


def version_state(fact: DataFrame) -> DataFrame:
    """Per employee version and department the sums that department KPIs need."""
    return marts.version_sums(fact)


def merge_versions(states: DataFrame) -> DataFrame:
    return states.groupBy("surrogate_key", "dept_key").agg(
        *marts._merged(["performance_rating"]), F.sum("attrition").alias("attrition"), F.sum("reviews").alias("reviews")
    )


def kpis_from_state(states: DataFrame, dim_emp: DataFrame, dim_dept: DataFrame, with_total: bool = False) -> DataFrame:
    """``marts.department_kpis`` from the states of all its reviews; versions closed since then drop out."""
    return marts.kpis_of(marts.metrics_of(merge_versions(states), dim_emp, dim_dept), with_total)


def salary_sketch(dim_emp: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Per department a sketch of the current salaries, a few kilobytes however many there are."""
    rows = marts.current(dim_emp).select("department_name", S.cents(F.col("monthly_income")).cast("bigint").alias("_c"))
    return rows.filter(F.col("_c").isNotNull()).groupBy(*_SALARIES).agg(
        F.kll_sketch_agg_bigint("_c", F.lit(size)).alias("sketch"), F.min("_c").alias("least"), F.max("_c").alias("most"),
        F.count(F.lit(1)).alias("employees"),
    )


def merge_sketches(states: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    return states.groupBy(*_SALARIES).agg(
        F.kll_merge_agg_bigint("sketch", F.lit(size)).alias("sketch"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.sum("employees").alias("employees"),
    )


def box_from_sketch(states: DataFrame) -> DataFrame:
    """The columns of ``marts.salary_box``: extremes and counts exact, quartiles salaries that occur, of
    nearly the rank asked for."""
    at = lambda q: F.kll_sketch_get_quantile_bigint("sketch", F.lit(q))
    points = {"min_salary": F.col("least"), "q1_salary": at(0.25), "median_salary": at(0.5), "q3_salary": at(0.75), "max_salary": F.col("most")}
    return states.select(
        "department_name", "employees", *[F.round(c / 100, 4).alias(n) for n, c in points.items()]
    ).orderBy("department_name")
