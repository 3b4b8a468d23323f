"""The nightly run: calendar, departments, projects, employee versions, review facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tenurelake.operators import dims, facts, scd2
from tenurelake.sources.tables import Warehouse

REPORT = "step string, inserted bigint, updated bigint, total bigint, error string"


def observed(df: DataFrame, name: str, **counts) -> tuple[DataFrame, Observation]:
    """``df`` and the counts taken while it is written, without a scan of their own."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in counts.items()]), seen


def _append(olap: Warehouse, rows: DataFrame, name: str) -> tuple[int, int, int]:
    before = olap.rows(name)  # noted by the last run, so no file of the table is opened for it
    rows, seen = observed(rows, name, inserted=F.count(F.lit(1)))
    olap.append(rows, name)
    inserted = seen.get["inserted"]
    olap.note_rows(name, before + inserted)
    return inserted, 0, before + inserted


def load_calendar(spark: SparkSession, olap: Warehouse, start: dt.date, end: dt.date):
    dim = olap.read("dim_date")
    return _append(olap, dims.load_dim_date(dims.build_dim_date(spark, start, end), dim), "dim_date")


def load_departments(oltp: Warehouse, olap: Warehouse):
    rows = dims.load_dim_department(oltp.read("departments"), olap.read("dim_department"))
    return _append(olap, rows, "dim_department")


def load_projects(oltp: Warehouse, olap: Warehouse):
    rows = dims.load_dim_project(
        oltp.read("projects"), olap.read("dim_department"), olap.read("dim_project")
    )
    return _append(olap, rows, "dim_project")


def merge_employees(oltp: Warehouse, olap: Warehouse, as_of: dt.date):
    """Replaces the current versions and archives the closed ones; what is archived is not rewritten."""
    snapshot = scd2.snapshot_of(oltp.read("employees"), oltp.read("departments"))
    dim = olap.read("dim_employee")
    current, closed = scd2.scd2_merge(snapshot, dim, as_of)
    current, live = observed(current, "current", rows=F.count(F.lit(1)))
    closed, ended = observed(closed, "closed", rows=F.count(F.lit(1)))
    # history that was loaded next to current rows moves to the archive with them
    past = olap.read_live("dim_employee").filter(~F.col("is_current").eqNullSafe(F.lit(1)))
    before = dim.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_current") == 1).alias("live")).first()
    olap.replace(current, "dim_employee", archive=closed.unionByName(past))
    updated = ended.get["rows"]
    inserted = live.get["rows"] - (before["live"] - updated)
    return inserted, updated, before["n"] + inserted


def load_facts(oltp: Warehouse, olap: Warehouse):
    rows = facts.load_fact_reviews(
        oltp.read("performance_reviews"), oltp.read("employees"), oltp.read("departments"),
        olap.read_live("dim_employee"), olap.read("dim_department"), olap.read("fact_performance_reviews"),
    )
    return _append(olap, rows, "fact_performance_reviews")


def run_pipeline(
    spark: SparkSession, root: str, as_of: dt.date, on_error: str = "stop",
    calendar: tuple[dt.date, dt.date] = (dt.date(2015, 1, 1), dt.date(2030, 12, 31)),
) -> DataFrame:
    """Runs the five loads over ``root``/oltp into ``root``/olap and reports one row per step.

    Every load only adds what is missing, so a second run changes nothing. A failing step stops the
    run; ``on_error='skip'`` notes it and goes on.
    """
    oltp, olap = Warehouse(spark, f"{root}/oltp"), Warehouse(spark, f"{root}/olap")
    steps: dict[str, Callable[[], tuple[int, int, int]]] = {
        "dim_date": lambda: load_calendar(spark, olap, *calendar),
        "dim_department": lambda: load_departments(oltp, olap),
        "dim_project": lambda: load_projects(oltp, olap),
        "dim_employee": lambda: merge_employees(oltp, olap, as_of),
        "fact_performance_reviews": lambda: load_facts(oltp, olap),
    }
    report = []
    for name, step in steps.items():
        try:
            report.append((name, *step(), None))
        except Exception as problem:
            if on_error != "skip":
                raise
            report.append((name, None, None, None, str(problem)))
    return spark.createDataFrame(report, REPORT)
