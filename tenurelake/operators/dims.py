"""Calendar, department and project dimensions, and surrogate keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tenurelake.functions import scalars as S
from tenurelake.operators import scale


def _calendar(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    weekday = F.dayofweek(day)  # 1 = Sunday
    return days.select(
        S.date_key(day).alias("date_key"), "full_date", weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"), F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"), F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_number"), F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"), F.year(day).alias("year"),
        weekday.isin(1, 7).alias("is_weekend"), F.lit(False).alias("is_holiday"),
    )


def build_dim_date(
    spark: SparkSession, start: dt.date = dt.date(2015, 1, 1), end: dt.date = dt.date(2030, 12, 31)
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    span = spark.range(1).select(F.sequence(F.lit(start), F.lit(end)).alias("days"))
    return _calendar(span.select(F.explode("days").alias("full_date")))


def dim_date_covering(events: DataFrame, day: str) -> DataFrame:
    """The calendar of every whole year that ``events`` touches; a row per day, not per event."""
    years = events.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    first = F.make_date(F.year("lo"), F.lit(1), F.lit(1))
    last = F.make_date(F.year("hi"), F.lit(12), F.lit(31))
    return _calendar(years.select(F.explode(F.sequence(first, last)).alias("full_date")))


def max_key(df: DataFrame, key: str) -> Column:
    return F.coalesce(df.agg(F.max(key).cast("bigint")).scalar(), F.lit(0))


def assign_surrogate(
    df: DataFrame, order: str, key: str, start: Column | int = 0, ties: list[str] | None = None
) -> DataFrame:
    """Gives rows the keys ``start``+1, +2, … in ``order`` (a whole number). Dense, and numbered in
    parallel."""
    after = start if isinstance(start, Column) else F.lit(start)
    numbered = scale.dense_numbers(df, order, "_rn", ties)
    return numbered.withColumn(key, F.col("_rn") + after).drop("_rn").select(key, *df.columns)


def new_rows(src: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``src`` whose ``key`` the target does not hold. NULL keys in the target match nothing,
    and the join can sort-merge at any size, unlike ``NOT IN``."""
    return src.join(target.filter(F.col(key).isNotNull()).select(key), key, "left_anti")


def load_dim_date(calendar: DataFrame, dim: DataFrame) -> DataFrame:
    """Days the dimension lacks."""
    return new_rows(calendar, dim, "date_key").select(*dim.columns)


def load_dim_department(src: DataFrame, dim: DataFrame) -> DataFrame:
    """Departments the dimension lacks, with keys continuing after its largest. Rows already there
    stay as they are: a renamed department keeps its old name."""
    fresh = new_rows(src, dim, "department_id").select("department_id", "department_name", "location")
    return assign_surrogate(fresh, "department_id", "dept_key", max_key(dim, "dept_key"))


def load_dim_project(src: DataFrame, dim_dept: DataFrame, dim: DataFrame) -> DataFrame:
    """Projects the dimension lacks, with their department key, or NULL when they have none.
    Status and budget of projects already there stay as they are."""
    fresh = new_rows(src, dim, "project_id").join(
        dim_dept.select("department_id", "dept_key"), "department_id", "left"
    ).select("project_id", "project_name", "status", "start_date", "end_date", "budget", "dept_key")
    return assign_surrogate(
        fresh, "project_id", "project_key", max_key(dim, "project_key"), ["dept_key"]
    )
