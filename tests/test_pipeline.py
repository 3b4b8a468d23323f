"""The nightly run over stored tables, twice, and with a failing step."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenurelake import schemas
from tenurelake.catalog.fixtures import view
from tenurelake.operators import ingest, quality
from tenurelake.plans import marts, pipeline
from tenurelake.sources.tables import Warehouse

CALENDAR = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))
DAY1, DAY2 = dt.date(2001, 9, 1), dt.date(2001, 9, 2)


@pytest.fixture(scope="module")
def root(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("house"))
    oltp = Warehouse(spark, f"{root}/oltp")
    for table, source in {"departments": "hr_departments", "employees": "hr_employees_full",
                          "projects": "hr_projects", "performance_reviews": "hr_reviews"}.items():
        oltp.append(schemas.conform(ingest.apply_defaults(view(spark, sf_dir, source), table)
                                    if table in schemas.DEFAULTS else view(spark, sf_dir, source), table), table)
    return root


def report(spark, root, day, **options):
    rows = pipeline.run_pipeline(spark, root, day, calendar=CALENDAR, **options).collect()
    return {r["step"]: (r["inserted"], r["updated"], r["total"]) for r in rows}


def test_run_rerun_and_change(spark, root):
    first = report(spark, root, DAY1)
    assert first == {"dim_date": (2557, 0, 2557), "dim_department": (25, 0, 25), "dim_project": (200, 0, 200),
                     "dim_employee": (150, 0, 150), "fact_performance_reviews": (1500, 0, 1500)}
    again = report(spark, root, DAY1)
    assert again == {step: (0, 0, total) for step, (_, _, total) in first.items()}

    oltp, olap = Warehouse(spark, f"{root}/oltp"), Warehouse(spark, f"{root}/olap")
    before = marts.department_kpis(olap.read("fact_performance_reviews"), olap.read("dim_employee"),
                                   olap.read("dim_department")).agg(F.sum("total_reviews")).first()[0]
    yoy = marts.yoy_performance(olap.read("fact_performance_reviews"), olap.read("dim_department")).collect()
    oltp.replace(oltp.read("employees").withColumn(
        "monthly_income", F.when(F.col("employee_id") < 10, F.col("monthly_income") * 2 + 100).otherwise(
            F.col("monthly_income")).cast("decimal(10,2)")), "employees")
    changed = report(spark, root, DAY2)
    inserted, updated, total = changed["dim_employee"]
    assert inserted == updated > 0 and total == 150 + inserted
    dim = olap.read("dim_employee")
    assert dim.count() == total and quality.scd2_integrity(dim).count() == 0
    assert olap.read_live("dim_employee").filter("is_current = 0").count() == 0

    # facts keep the key of the version they were loaded with: marts over current employees lose the
    # reviews of those just versioned, the yearly mart does not
    after = marts.department_kpis(olap.read("fact_performance_reviews"), dim, olap.read("dim_department")).agg(
        F.sum("total_reviews")).first()[0]
    assert after < before
    assert marts.yoy_performance(olap.read("fact_performance_reviews"), olap.read("dim_department")).collect() == yoy


def test_failing_step(spark, root, monkeypatch):
    monkeypatch.setattr(pipeline, "load_projects", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        pipeline.run_pipeline(spark, root, DAY2, calendar=CALENDAR)
    rows = pipeline.run_pipeline(spark, root, DAY2, on_error="skip", calendar=CALENDAR).collect()
    assert [r["step"] for r in rows if r["error"]] == ["dim_project"] and len(rows) == 5


def test_history_loaded_beforehand_is_kept(spark, sf_dir, tmp_path):
    """History goes into the dimension first, with names unknown; the nightly merge builds on it."""
    oltp, olap = Warehouse(spark, f"{tmp_path}/oltp"), Warehouse(spark, f"{tmp_path}/olap")
    oltp.append(schemas.conform(view(spark, sf_dir, "hr_departments"), "departments"), "departments")
    oltp.append(schemas.conform(view(spark, sf_dir, "hr_employees_full"), "employees"), "employees")
    history = schemas.conform(view(spark, sf_dir, "hr_dim_employee"), "dim_employee")
    olap.append(history, "dim_employee")
    held = history.count()
    inserted, updated, total = pipeline.merge_employees(oltp, olap, DAY1)
    assert inserted == updated > 0 and total == held + inserted == olap.read("dim_employee").count()
    after = olap.read("dim_employee")
    assert after.filter("is_current = 0").count() == history.filter("is_current = 0").count() + updated
    assert after.select("surrogate_key").distinct().count() == total
    assert pipeline.merge_employees(oltp, olap, DAY1) == (0, 0, total)
