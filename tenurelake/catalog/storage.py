"""Queries that go through stored tables and files, and their oracles."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import functions as F

from tenurelake import schemas
from tenurelake.catalog.common import AS_OF, plain
from tenurelake.catalog.fixtures import view, with_views
from tenurelake.catalog.warehouse import ORACLES as _LOADS
from tenurelake.operators import ingest, quality, scd2
from tenurelake.plans import pipeline
from tenurelake.session import shared_dir
from tenurelake.sources import tables
from tenurelake.sources.partitions import BlockTable

_SOURCES = {"departments": "hr_departments", "employees": "hr_employees_full", "projects": "hr_projects",
            "performance_reviews": "hr_reviews"}


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _pipeline(s, d, runs, reviews="true"):
    """The report of the last of ``runs`` nightly runs over freshly stored tables; ``reviews`` selects
    the reviews that there are."""
    root = _folder(s, "warehouse")
    oltp = tables.Warehouse(s, f"{root}/oltp")
    for table, source in _SOURCES.items():
        rows = view(s, d, source)
        if table == "performance_reviews":
            rows = rows.filter(reviews)
        if table in schemas.DEFAULTS:
            rows = ingest.apply_defaults(rows, table)
        oltp.append(schemas.conform(rows, table), table)
    span = view(s, d, "hr_reviews").agg(
        F.min(F.trunc("review_date", "year")).alias("lo"), F.max(F.last_day("review_date")).alias("hi")
    ).first()
    for _ in range(runs):
        report = pipeline.run_pipeline(s, root, AS_OF, calendar=(span["lo"], span["hi"]))
    return report.drop("error")


def _csv(s, d):
    folder = _folder(s, "feed")
    tables.write_feed_csv(view(s, d, "hr_feed"), folder)
    feed, _ = tables.read_feed_csv(s, folder, dict.fromkeys(view(s, d, "hr_feed").columns))
    return plain(ingest.conform_employee_feed(feed, view(s, d, "hr_departments")))


def _snapshot_load(s, d):
    """A feed with more columns than wanted, in another order, with quotes and commas in its values."""
    folder, feed = _folder(s, "feed"), view(s, d, "hr_feed")
    wide = feed.select(
        F.lit('left, "for good"').alias("Notes"), *reversed(feed.columns),
        *[F.lit(str(k)).alias(f"Extra{k}") for k in range(24)],
    )
    tables.write_feed_csv(wide, folder)
    rows, _ = tables.read_feed_csv(s, folder, schemas.EMPLOYEE_FEED)
    loaded = ingest.load_employee_feed(rows, view(s, d, "hr_staff"), view(s, d, "hr_departments"))
    return plain(loaded.select("employee_id", "email", "hire_date", "monthly_income", "is_active", "department_id"))


def _history_load(s, d):
    folder, dim = _folder(s, "history"), view(s, d, "hr_dim_employee")
    feed = dim.select(F.lit("a, b").alias("Source"), *[
        F.col(c).cast("string").alias(name) for name, c in reversed(schemas.HISTORY_FEED.items()) if c in dim.columns
    ])
    tables.write_feed_csv(feed, folder)
    rows, _ = tables.read_feed_csv(s, folder, schemas.HISTORY_FEED)
    return plain(scd2.conform_history(rows).select(
        "employee_id", "department_name", "job_role", "job_level", "monthly_income", "start_date", "end_date", "is_current"
    ))


def _backfill_stored(s, d):
    """A stored dimension with an archive, repaired as a whole, stored and read back."""
    house = tables.Warehouse(s, _folder(s, "warehouse"))
    dim = schemas.conform(view(s, d, "hr_dim_employee"), "dim_employee")
    house.replace(dim.filter("is_current = 1"), "dim_employee", archive=dim.filter("is_current = 0"))
    house.replace_whole(scd2.backfill_nulls(house.read("dim_employee"), view(s, d, "hr_employees_raw")), "dim_employee")
    return plain(house.read("dim_employee").select(*view(s, d, "hr_dim_employee").columns))


def _mixed_headers(s, d):
    """A feed in two kinds of files: columns in another order, and one with a column more."""
    folder, feed = _folder(s, "feed"), view(s, d, "hr_feed")
    odd = F.col("EmployeeID").cast("int") % 2 == 1
    tables.write_feed_csv(feed.filter(~odd), f"{folder}/a")
    tables.write_feed_csv(feed.filter(odd).select(F.lit("x, y").alias("Notes"), *reversed(feed.columns)), f"{folder}/b")
    rows, _ = tables.read_feed_csv(s, f"{folder}/*", dict.fromkeys(feed.columns))
    return plain(ingest.conform_employee_feed(rows, view(s, d, "hr_departments")))


BLOCK_BITS = 6  # the supplied tables are small; a block of this many keys makes several


def _upsert_stored(s, d):
    table = BlockTable(s, _folder(s, "assignments"), "project_id", BLOCK_BITS)
    table.create(view(s, d, "hr_assignments_held"))
    valid, _ = quality.split_valid(view(s, d, "hr_assignments_new"), quality.assignment_rules())
    table.upsert(
        valid, ["employee_id", "project_id"], ["role_in_project", "hours_allocated"],
        ["assigned_date", "l_orderkey", "l_linenumber", "hours_allocated", "role_in_project"], insert=["assigned_date"],
    )
    return table.read().select(*view(s, d, "hr_assignments_held").columns)


def _delete_stored(s, d):
    table = BlockTable(s, _folder(s, "employees"), "employee_id", BLOCK_BITS)
    table.create(view(s, d, "hr_employees"))
    table.delete(view(s, d, "hr_leavers"))
    return plain(table.read().select(*view(s, d, "hr_employees").columns))


def _transfers_stored(s, d):
    """Transfers on a stored dimension: current versions are written anew, closed ones added."""
    house = tables.Warehouse(s, _folder(s, "warehouse"))
    dim = schemas.conform(view(s, d, "hr_dim_employee"), "dim_employee")
    house.replace(dim.filter("is_current = 1"), "dim_employee", archive=dim.filter("is_current = 0"))
    _, current, closed, _ = scd2.apply_transfers(
        view(s, d, "hr_employees_full"), house.read("dim_employee"), view(s, d, "hr_departments"), view(s, d, "hr_transfers"), AS_OF
    )
    house.replace(current, "dim_employee", archive=closed)
    return plain(house.read("dim_employee").select(*view(s, d, "hr_dim_employee").columns))


def _vacuumed(s, d):
    """A dimension that was replaced whole, then three times with closed versions archived, stripped of
    its old versions after every step."""
    house, dim = tables.Warehouse(s, _folder(s, "warehouse")), schemas.conform(view(s, d, "hr_dim_employee"), "dim_employee")
    live, ended = dim.filter("is_current = 1"), dim.filter("is_current = 0")
    house.replace(live, "dim_employee", archive=ended)
    house.replace_whole(house.read("dim_employee").filter("is_current = 1"), "dim_employee")  # retires the archive
    for k in range(3):
        house.replace(live, "dim_employee", archive=ended.filter(F.col("employee_id") % 3 == k))
        house.vacuum("dim_employee", keep=1)
    return plain(house.read("dim_employee").select(*view(s, d, "hr_dim_employee").columns))


def _appends_compacted(s, d):
    """Reviews that came in three loads, merged, and read for one year."""
    house, reviews = tables.Warehouse(s, _folder(s, "warehouse")), schemas.conform(view(s, d, "hr_reviews"), "performance_reviews")
    for k in range(3):
        house.append(reviews.filter(F.col("review_id") % 3 == k), "performance_reviews")
    house.compact("performance_reviews")
    house.append(reviews.filter("review_id < 0"), "performance_reviews")
    return house.read("performance_reviews").filter("review_year = 2000").select(*view(s, d, "hr_reviews").columns)


def _seeded(s, d):
    """The departments with the seed rows that they lack, numbered after them."""
    held = view(s, d, "hr_departments")
    last = held.agg(F.max("department_id")).first()[0]
    seeds = tables.seed_departments(s).withColumn("department_id", F.col("department_id") + F.lit(last))
    return held.unionByName(ingest.insert_ignore(seeds.drop("created_at"), held, ["department_name"], ["department_id"]))


QUERIES = {
    "feed_mixed_headers": _mixed_headers,
    "upsert_stored": _upsert_stored,
    "delete_stored": _delete_stored,
    "transfers_stored": _transfers_stored,
    "appends_compacted": _appends_compacted,
    "dimension_vacuumed": _vacuumed,
    "seed_departments": _seeded,
    "pipeline_empty_reviews": partial(_pipeline, runs=2, reviews="false"),
    "feed_snapshot_load": _snapshot_load,
    "feed_history_load": _history_load,
    "backfill_stored": _backfill_stored,
    "pipeline_report": partial(_pipeline, runs=1),
    "pipeline_rerun_report": partial(_pipeline, runs=2),
    "feed_csv_round_trip": _csv,
}


def _report_sql(inserted: str) -> str:
    return with_views(f"""select step, {inserted} as inserted, 0::bigint as updated, n as total from (
select 'dim_date' as step, (select cast(last_day(max(review_date)) - date_trunc('year', min(review_date))::date + 1 as bigint)
 from hr_reviews) as n
union all select 'dim_department', count(*) from hr_departments
union all select 'dim_project', count(*) from hr_projects
union all select 'dim_employee', count(*) from hr_employees_full
union all select 'fact_performance_reviews', count(*) from hr_reviews r join hr_employees_full e
 on r.employee_id = e.employee_id)""")


_SEEDS = ", ".join(f"({k}, '{name}', '{place}')" for k, name, place in schemas.SEED_DEPARTMENTS)

ORACLES = {
    "feed_mixed_headers": _LOADS["conform_feed"],
    "upsert_stored": _LOADS["assignments_upsert"],
    "delete_stored": _LOADS["delete_employees"],
    "transfers_stored": _LOADS["transfers_apply"],
    "dimension_vacuumed": with_views(
        "select * replace (cast(monthly_income as double) as monthly_income) from hr_dim_employee"),
    "appends_compacted": with_views("select * from hr_reviews where review_year = 2000"),
    "seed_departments": with_views(f"""select department_id, department_name, location from hr_departments
union all select cast(k + (select max(department_id) from hr_departments) as int), name, place from (values {_SEEDS}) as s(k, name, place)
where lower(name) not in (select lower(department_name) from hr_departments)"""),
    "pipeline_empty_reviews": _report_sql("0::bigint").replace("from hr_reviews r join", "from (from hr_reviews limit 0) r join"),
    "feed_snapshot_load": with_views("""select employee_id, email, hire_date, monthly_income, true as is_active, department_id
from (select *, row_number() over (partition by lower(email) order by employee_id) as rn from c)
where rn = 1 and lower(email) not in (select lower(email) from hr_staff)""", {
        "c": """select cast("EmployeeID" as int) as employee_id, "Email" as email,
 coalesce(try_cast("HireDate" as date), date '2020-01-01') as hire_date,
 cast(least(greatest(cast("MonthlyIncome" as decimal(10,2)), 1000), 19999) as double) as monthly_income,
 coalesce(d.department_id, 1) as department_id
from hr_feed f left join hr_departments d on f."Department" = d.department_name"""}),
    "feed_history_load": with_views("""select employee_id, department_name, job_role, job_level,
 cast(monthly_income as double) as monthly_income, start_date, end_date, is_current from hr_dim_employee"""),
    "backfill_stored": _LOADS["backfill_nulls"],
    "pipeline_report": _report_sql("n"),
    "pipeline_rerun_report": _report_sql("0::bigint"),
    "feed_csv_round_trip": _LOADS["conform_feed"],
}
