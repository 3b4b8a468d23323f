"""People-analytics marts over the star schema.

Marts over employees first reduce the fact to one row per dimension key (partial sums and counts,
combined on the map side) and only then join the employee dimension: the large table is shuffled in
reduced form, and a key that holds a third of all reviews is one row by the time it meets a join.
Departments are joined by broadcast where a bounded count has shown that they fit.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window as W, functions as F

from tenurelake.functions import scalars as S
from tenurelake.operators import scale


def current(dim_emp: DataFrame) -> DataFrame:
    return dim_emp.filter(F.col("is_current") == 1)


def _sums(columns: list[str]):
    out = []
    for c in columns:
        out += [F.sum(c).alias(f"s_{c}"), F.count(c).alias(f"n_{c}")]
    return out


def _merged(columns: list[str]):
    out = []
    for c in columns:
        out += [F.sum(f"s_{c}").alias(f"s_{c}"), F.sum(f"n_{c}").alias(f"n_{c}")]
    return out


def _avg(c: str, k: int = 2):
    return S.exact_avg(F.col(f"s_{c}"), F.col(f"n_{c}"), k)


def _steps(c: str, k: int = 2):
    return S.half_up(F.col(f"s_{c}"), F.col(f"n_{c}"), k)


def yoy_performance(fact: DataFrame, dim_dept: DataFrame, full: bool = True) -> DataFrame:
    """Average ratings and reviewed headcount per department and year, with the previous year's.

    The previous year is the previous year that has reviews. ``full=False`` gives the dashboard's
    shorter form, without work-life balance and change.
    """
    ratings = ["performance_rating", "job_satisfaction"] + (["work_life_balance"] if full else [])
    names = scale.small(dim_dept.select("dept_key", "department_name"))
    yearly = (
        fact.join(names, "dept_key").groupBy("review_year", "department_name")
        .agg(*_sums(ratings), F.count_distinct("employee_id").alias("employee_count"))
    )
    return yoy_of(yearly, full)


def yoy_of(yearly: DataFrame, full: bool = True) -> DataFrame:
    """``yoy_performance`` from sums, counts and heads per department and year."""
    along = W.partitionBy("department_name").orderBy("review_year")  # a row per year: small
    yearly = yearly.withColumn("_rating", _steps("performance_rating"))
    yearly = yearly.withColumn("_prev", F.lag("_rating").over(along))
    columns = [
        F.col("review_year"),
        F.col("department_name"),
        S.unscale(F.col("_rating"), 2).alias("avg_rating"),
        _avg("job_satisfaction").alias("avg_job_satisfaction" if full else "avg_satisfaction"),
        F.col("employee_count"),
        S.unscale(F.col("_prev"), 2).alias("prev_year_rating"),
    ]
    if full:
        columns += [
            _avg("work_life_balance").alias("avg_wlb"),
            S.unscale(F.col("_rating") - F.col("_prev"), 2).alias("rating_change"),
        ]
    return yearly.select(*columns).orderBy("review_year", "department_name")


def headcount_by_year(yoy: DataFrame) -> DataFrame:
    return yoy.select("department_name", "review_year", "employee_count")


def satisfaction_by_year(yoy: DataFrame) -> DataFrame:
    name = "avg_satisfaction" if "avg_satisfaction" in yoy.columns else "avg_job_satisfaction"
    return yoy.select("review_year", "department_name", F.col(name).alias("avg_satisfaction"))


def top_performers(
    fact: DataFrame, dim_emp: DataFrame, year: int | None = None, limit: int = 10,
    tie_break: bool = True,
) -> DataFrame:
    """Employees whose average rating has dense rank <= ``limit`` in their current department.

    With ``tie_break`` equal averages are ranked by income; without it all of them share a rank,
    so a department can return far more than ``limit`` rows.
    """
    if year is not None:
        fact = fact.filter(F.col("review_year") == year)
    who = ["employee_id", "first_name", "last_name", "department_name", "job_role", "job_level",
           "monthly_income"]
    rating = ["performance_rating"]
    per_employee = (
        fact.groupBy("surrogate_key").agg(*_sums(rating), F.count(F.lit(1)).alias("reviews"))
        .join(current(dim_emp).select("surrogate_key", *who), "surrogate_key")
        .groupBy(*who).agg(*_merged(rating), F.sum("reviews").alias("total_reviews"))
        # sums and counts are whole numbers: equal averages are equal doubles
        .withColumn("_avg", F.col("s_performance_rating") / F.col("n_performance_rating"))
    )
    order = ["_avg", "monthly_income"] if tie_break else ["_avg"]
    ranked = scale.top_n_per_group(per_employee, ["department_name"], order, limit, "dept_rank")
    return ranked.select(
        "employee_id", S.full_name().alias("full_name"), "department_name", "job_role", "job_level",
        "monthly_income", _avg("performance_rating").alias("avg_rating"), "total_reviews", "dept_rank",
    ).orderBy("department_name", "dept_rank", "employee_id")


def top_performers_report(top: DataFrame) -> DataFrame:
    """The leaderboard's columns under their display names."""
    names = {
        "dept_rank": "Rank", "full_name": "Name", "department_name": "Dept", "job_role": "Role",
        "job_level": "Level", "avg_rating": "Avg Rating", "monthly_income": "Monthly Income",
    }
    return top.select(*names).withColumnsRenamed(names)


def risk_scores(fact: DataFrame, dim_emp: DataFrame) -> DataFrame:
    """Whole-number attrition risk per employee still here: low satisfaction, overtime, short tenure.

    Employees whose attrition is unknown are left out, as are those marked as gone.
    """
    who = ["employee_id", "first_name", "last_name", "department_name", "job_role", "monthly_income",
           "over_time", "years_at_company"]
    ratings = ["job_satisfaction", "work_life_balance", "environment_satisfaction"]
    staying = current(dim_emp).filter(F.col("attrition") == "No")
    per_employee = (
        fact.groupBy("surrogate_key").agg(*_sums(ratings))
        .join(staying.select("surrogate_key", *who), "surrogate_key")
        .groupBy(*who).agg(*_merged(ratings))
    )
    score = sum((F.lit(5) - _steps(c, 0) for c in ratings), F.lit(0))
    score += F.when(F.col("over_time") == "Yes", 3).otherwise(0)
    score += F.when(F.col("years_at_company") < 2, 2).otherwise(0)
    return per_employee.select(
        "employee_id", S.full_name().alias("full_name"), "department_name", "job_role",
        "monthly_income", "over_time", "years_at_company",
        _avg("job_satisfaction").alias("avg_job_satisfaction"),
        _avg("work_life_balance").alias("avg_wlb"),
        _avg("environment_satisfaction").alias("avg_env_satisfaction"),
        score.cast("bigint").alias("risk_score"),
    )


def attrition_risk(fact: DataFrame, dim_emp: DataFrame, full: bool = True) -> DataFrame:
    """Risk scores cut into four quartiles, highest risk first; ties go to the lower employee id.

    ``full=False`` is the dashboard's form: quartile number, no environment average.
    """
    ties = ["full_name", "department_name", "job_role", "monthly_income", "years_at_company"]
    ranked = scale.distributed_ntile(
        risk_scores(fact, dim_emp), "risk_score", "employee_id", 4, "risk_quartile", ties
    )
    if full:
        ranked = ranked.withColumn("risk_category", S.label(F.col("risk_quartile"), S.RISK_LABELS))
        ranked = ranked.drop("risk_quartile")
    else:
        ranked = ranked.drop("avg_env_satisfaction").withColumnRenamed(
            "avg_job_satisfaction", "avg_satisfaction"
        )
    return ranked.orderBy(F.col("risk_score").desc(), "employee_id")


def with_risk_category(risk: DataFrame) -> DataFrame:
    if "risk_category" in risk.columns:
        return risk
    return risk.withColumn("risk_category", S.label(F.col("risk_quartile"), S.RISK_LABELS))


def value_counts(df: DataFrame, column: str, by: str = "count") -> DataFrame:
    """Frequency of each non-NULL value, most frequent first (``by='key'``: in value order)."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.col("count").desc(), column) if by == "count" else counted.orderBy(column)


def risk_distribution(risk: DataFrame) -> DataFrame:
    counted = value_counts(with_risk_category(risk), "risk_category")
    return counted.withColumnRenamed("risk_category", "category")


def high_risk(risk: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` highest scores of the High Risk quartile."""
    top = with_risk_category(risk).filter(F.col("risk_category") == S.RISK_LABELS[1])
    return top.orderBy(F.col("risk_score").desc(), "employee_id").limit(n).select(
        "employee_id", "full_name", "department_name", "job_role", "over_time", "years_at_company",
        "risk_score",
    )


def risk_scatter(risk: DataFrame, n: int = 500) -> DataFrame:
    """The first ``n`` employees by risk, as the scatter chart shows them."""
    satisfaction = "avg_satisfaction" if "avg_satisfaction" in risk.columns else "avg_job_satisfaction"
    return (
        with_risk_category(risk).orderBy(F.col("risk_score").desc(), "employee_id").limit(n)
        .select("employee_id", "full_name", "department_name", "over_time", F.col(satisfaction).alias("avg_satisfaction"), "avg_wlb",
                "risk_category", "risk_score")
    )


def department_metrics(fact: DataFrame, dim_emp: DataFrame, dim_dept: DataFrame) -> DataFrame:
    """Per department: distinct headcount, review-weighted salary, rating, attrition and reviews.

    Averages stay in hundredths so that the company row can average them exactly.
    """
    return metrics_of(version_sums(fact), dim_emp, dim_dept)


def version_sums(fact: DataFrame) -> DataFrame:
    """What the KPIs need of the reviews of each employee version: sums that further reviews add to."""
    return fact.groupBy("surrogate_key", "dept_key").agg(
        *_sums(["performance_rating"]),
        F.sum("attrition_flag").alias("attrition"), F.count(F.lit(1)).alias("reviews"),
    )


def metrics_of(per_version: DataFrame, dim_emp: DataFrame, dim_dept: DataFrame) -> DataFrame:
    income = S.cents(F.col("monthly_income"))
    per_employee = (
        per_version
        .join(current(dim_emp).select("surrogate_key", "employee_id", "monthly_income"), "surrogate_key")
        .join(scale.small(dim_dept.select("dept_key", "department_name")), "dept_key")
    )
    paid = F.when(F.col("monthly_income").isNotNull(), F.col("reviews"))
    return per_employee.groupBy("department_name").agg(
        F.count_distinct("employee_id").alias("headcount"),
        F.sum(income * F.col("reviews")).alias("s_salary"), F.sum(paid).alias("n_salary"),
        *_merged(["performance_rating"]),
        F.sum("attrition").alias("attrition_count"), F.sum("reviews").alias("total_reviews"),
    ).select(
        "department_name", "headcount",
        S.half_up(F.col("s_salary"), F.col("n_salary")).alias("salary_h"),
        _steps("performance_rating").alias("performance_h"),
        "attrition_count", "total_reviews",
    )


def company_total(metrics: DataFrame) -> DataFrame:
    """One row: sums over departments, and plain (not headcount-weighted) means of their averages."""
    return metrics.agg(
        F.lit("Company Total").alias("department_name"),
        F.sum("headcount").alias("headcount"),
        S.half_up(F.sum("salary_h"), F.count("salary_h")).alias("salary_h"),
        S.half_up(F.sum("performance_h"), F.count("performance_h")).alias("performance_h"),
        F.sum("attrition_count").alias("attrition_count"),
        F.sum("total_reviews").alias("total_reviews"),
    )


def department_kpis(
    fact: DataFrame, dim_emp: DataFrame, dim_dept: DataFrame, with_total: bool = False
) -> DataFrame:
    """Department KPIs, largest first. Attrition counts reviews while headcount counts people, so
    the rate can pass 100 %; that is the definition in use. ``with_total`` adds the company row."""
    return kpis_of(department_metrics(fact, dim_emp, dim_dept), with_total)


def kpis_of(metrics: DataFrame, with_total: bool = False) -> DataFrame:
    if with_total:
        metrics = metrics.unionByName(company_total(metrics))
    return metrics.select(
        "department_name", "headcount",
        S.unscale(F.col("salary_h"), 2).alias("avg_salary"),
        S.unscale(F.col("performance_h"), 2).alias("avg_performance"),
        "attrition_count", "total_reviews",
        S.safe_pct(F.col("attrition_count"), F.col("headcount")).alias("attrition_rate_pct"),
    ).orderBy(F.col("headcount").desc(), "department_name")


def employee_history(
    dim_emp: DataFrame, as_of: dt.date, employee_id: int | None = None
) -> DataFrame:
    """Every version with the days it held; of one employee, or of all of them."""
    if employee_id is not None:
        dim_emp = dim_emp.filter(F.col("employee_id") == employee_id)
    return dim_emp.select(
        "surrogate_key", "employee_id", "department_name", "job_role", "job_level", "monthly_income",
        "start_date",
        F.coalesce(F.col("end_date").cast("string"), F.lit("Present")).alias("end_date"),
        "is_current",
        F.datediff(F.coalesce("end_date", F.lit(as_of)), "start_date").alias("days_in_role"),
    ).orderBy("employee_id", "start_date", "surrogate_key")


def career_timeline(dim_emp: DataFrame, as_of: dt.date, employee_id: int | None = None) -> DataFrame:
    """Versions as closed intervals: an open version ends at ``as_of``."""
    if employee_id is not None:
        dim_emp = dim_emp.filter(F.col("employee_id") == employee_id)
    return dim_emp.select(
        "surrogate_key", "employee_id", "department_name", "job_role",
        F.col("start_date").alias("start"), F.coalesce("end_date", F.lit(as_of)).alias("end"),
    ).orderBy("employee_id", "start", "surrogate_key")


def salary_distribution(dim_emp: DataFrame) -> DataFrame:
    """Percentile rank of each current salary in its department, and the department's mean."""
    rows = current(dim_emp).select(
        "employee_id", "department_name", "job_role", "monthly_income",
        S.cents(F.col("monthly_income")).alias("_c"),
    )
    ranks = scale.value_ranks(rows, ["department_name"], "_c")
    percentile = F.when(F.col("total") == 1, F.lit(0.0)).otherwise(
        S.exact_avg(F.col("before") * 100, F.col("total") - 1, 1)
    )
    return scale.null_safe_join(rows, ranks, ["department_name", "_c"]).select(
        "employee_id", "department_name", "job_role", "monthly_income",
        percentile.alias("salary_percentile"),
        S.from_cents(S.half_up(F.col("value_sum"), F.col("value_n"))).alias("dept_avg_salary"),
    ).orderBy("department_name", F.col("monthly_income").desc(), "employee_id")


def salary_box(dim_emp: DataFrame) -> DataFrame:
    """Five-number summary of current salaries per department, quartiles linearly interpolated."""
    rows = current(dim_emp).select("department_name", S.cents(F.col("monthly_income")).alias("_c"))
    points = {"min_salary": 0.0, "q1_salary": 0.25, "median_salary": 0.5, "q3_salary": 0.75,
              "max_salary": 1.0}
    box = scale.percentiles(rows, ["department_name"], "_c", points)
    return box.select(
        "department_name", F.col("total").alias("employees"),
        *[F.round(F.col(p) / 100, 4).alias(p) for p in points],
    ).orderBy("department_name")
