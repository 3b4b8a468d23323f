"""Warehouse-load and application-write queries and their oracles."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import functions as F

from tenurelake.catalog.common import AS_OF, plain
from tenurelake.catalog.fixtures import view, with_views
from tenurelake.catalog.marts import merge_steps
from tenurelake.operators import dims, facts, ingest, quality, scale, scd2
from tenurelake.session import checkpointed, shared_dir
from tenurelake.sources.buckets import KeyBuckets


def _dim_date(s, d):
    return dims.dim_date_covering(view(s, d, "hr_reviews"), "review_date")


def _dim_department(s, d):
    held = view(s, d, "hr_dim_department").filter("location <> 'ASIA'")
    return dims.load_dim_department(view(s, d, "hr_departments"), held)


def _dim_project(s, d):
    proj, dept = view(s, d, "hr_projects"), view(s, d, "hr_dim_department")
    held = proj.filter("status in ('Completed', 'Cancelled')").select(
        (F.col("project_id") + 1).cast("bigint").alias("project_key"), "project_id"
    )
    return plain(dims.load_dim_project(proj, dept, held))


def _facts(s, d, held=None):
    v = partial(view, s, d)
    rows = facts.load_fact_reviews(
        v("hr_reviews"), v("hr_employees_raw"), v("hr_departments"), v("hr_dim_employee"),
        v("hr_dim_department"), held,
    )
    return plain(rows.drop("project_key"))


def _facts_incremental(s, d):
    held = view(s, d, "hr_fact_loaded").withColumn("fact_id", F.col("review_id").cast("bigint") + 1)
    return _facts(s, d, held)


def _facts_bucketed(s, d):
    """The incremental load against bucketed ids, which came in by two loads."""
    held, v = view(s, d, "hr_fact_loaded"), partial(view, s, d)
    keys = KeyBuckets(s, f"{shared_dir(s)}/review-ids-{uuid.uuid4().hex}", "review_id")
    keys.add(held.filter("review_year < 1998"))
    keys.add(held.filter("review_year >= 1998"))
    last = held.agg(F.max("review_id")).first()[0] or 0
    rows = facts.load_fact_reviews(
        keys.new(v("hr_reviews")), v("hr_employees_raw"), v("hr_departments"), v("hr_dim_employee"), v("hr_dim_department"), after=last + 1
    )
    return plain(rows.drop("project_key"))


# Rows of a key from which on the hot queries cut it into segments.
HOT = 20


def _facts_asof(s, d, hot_rows=scale.HOT_ROWS):
    reviews = view(s, d, "hr_reviews").select("review_id", "employee_id", "review_date", "performance_rating")
    return plain(scd2.asof_version_join(
        reviews, view(s, d, "hr_dim_employee"), "review_date", ["review_id"],
        ["surrogate_key", "department_name", "monthly_income"], hot_rows,
    ))


def _all_versions(s, d):
    reviews = view(s, d, "hr_reviews").select("review_id", "employee_id", "review_date")
    return scd2.asof_all_versions(reviews, view(s, d, "hr_dim_broken"), "review_date", ["surrogate_key", "start_date"])


def _merge(s, d):
    return scd2.scd2_apply_snapshot(view(s, d, "hr_snapshot"), view(s, d, "hr_dim_employee_loaded"), AS_OF)


def _merge_again(s, d):
    after = checkpointed(_merge(s, d))
    return scd2.scd2_apply_snapshot(view(s, d, "hr_snapshot"), after, AS_OF)


def _classify(s, d):
    judged = scd2.scd2_classify(view(s, d, "hr_snapshot"), view(s, d, "hr_dim_employee_loaded"))
    return judged.select("employee_id", "status")


def _versions(s, d, hot_rows=scale.HOT_ROWS):
    log = view(s, d, "hr_salary_log").withColumn("start_date", F.to_date("change_ts"))
    chained = scd2.scd2_from_versions(log, "employee_id", ["change_ts", "event_id"], "start_date", hot_rows)
    return plain(chained.select("event_id", "employee_id", "new_salary", "start_date", "end_date", "is_current"))


def _log(s, d, mode):
    versions = scd2.scd2_from_change_log(view(s, d, "hr_salary_drift"), mode)
    return plain(versions.select("event_id", "employee_id", "monthly_income", "start_date", "end_date", "is_current"))


def _log_hot(s, d):
    """Oversized employees, some events without one."""
    unknown = F.when(F.col("event_id") % 10 != 3, F.col("employee_id"))
    log = view(s, d, "hr_salary_drift").withColumn("employee_id", unknown)
    versions = scd2.scd2_from_change_log(log, "last_version", HOT)
    return plain(versions.select("event_id", "employee_id", "monthly_income", "start_date", "end_date", "is_current"))


def _salaries(s, d, part):
    v = partial(view, s, d)
    emp = v("hr_employees_full").withColumn("updated_at", F.lit(None).cast("timestamp"))
    return scd2.apply_salary_changes(
        emp, v("hr_dim_employee"), v("hr_departments"), v("hr_salary_log"), AS_OF, HOT
    )[part]


def _history(s, d):
    return plain(scd2.salary_history(view(s, d, "hr_salary_log"), view(s, d, "hr_employees")))


def _latest(s, d):
    after = scd2.latest_salaries(view(s, d, "hr_employees"), view(s, d, "hr_salary_log"))
    return plain(after)


def _transfers(s, d, part):
    v = partial(view, s, d)
    return scd2.apply_transfers(
        v("hr_employees_full"), v("hr_dim_employee"), v("hr_departments"), v("hr_transfers"), AS_OF
    )[part]


def _transferred(s, d):
    """The whole dimension after the transfers: its earlier versions, those closed and the current ones."""
    past = view(s, d, "hr_dim_employee").filter("is_current = 0")
    return plain(past.unionByName(_transfers(s, d, 1)).unionByName(_transfers(s, d, 2)))


def _backfill(s, d):
    return plain(scd2.backfill_nulls(view(s, d, "hr_dim_employee"), view(s, d, "hr_employees_raw")))


def _upsert(s, d):
    valid, _ = quality.split_valid(view(s, d, "hr_assignments_new"), quality.assignment_rules())
    return ingest.upsert(
        valid, view(s, d, "hr_assignments_held"), ["employee_id", "project_id"], ["role_in_project", "hours_allocated"],
        ["assigned_date", "l_orderkey", "l_linenumber", "hours_allocated", "role_in_project"], insert=["assigned_date"],
    )


def _mixed_case(s, d):
    loud = F.when(F.col("employee_id") % 3 == 0, F.upper("email")).otherwise(F.col("email"))
    return view(s, d, "hr_employees_full").withColumn("email", loud)


def _append(s, d, table, rules, id_col, held):
    rows = view(s, d, table)
    return quality.append_valid(rows.filter(~F.expr(held)), rows.filter(held), rules, id_col, id_col)[0]


def _onboard(s, d, part):
    v = partial(view, s, d)
    return ingest.onboard(
        v("hr_hires"), v("hr_staff"), v("hr_dim_employee_loaded"), v("hr_departments"), AS_OF, "employee_id"
    )[part]


def _onboard_rejected(s, d):
    valid, invalid = quality.split_valid(view(s, d, "hr_hires"), quality.employee_rules())
    _, duplicate = quality.reject_duplicates(valid, view(s, d, "hr_staff"), "email", ["employee_id"])
    return invalid.select("employee_id", F.lit("invalid").alias("reason")).unionByName(
        duplicate.select("employee_id", F.lit("duplicate e-mail").alias("reason"))
    )


def _valid_reviews(s, d):
    return quality.split_valid(view(s, d, "hr_reviews"), quality.review_rules())[0]


def _conform(s, d):
    return plain(ingest.conform_employee_feed(view(s, d, "hr_feed"), view(s, d, "hr_departments")))


def _status(s, d, part):
    return ingest.update_project_status(
        view(s, d, "hr_projects"), view(s, d, "hr_status_changes"), ["change_ts", "l_orderkey", "l_linenumber"]
    )[part]


def _closing(s, d):
    return view(s, d, "hr_departments").filter("location = 'EUROPE'").select("department_id")


def _delete_employees(s, d, table):
    v = partial(view, s, d)
    tables = {"employees": v("hr_employees"), "project_assignments": v("hr_assignments"),
              "performance_reviews": v("hr_reviews")}
    return ingest.apply_delete(tables, "employees", v("hr_leavers"))[table]


def _close_departments(s, d, table):
    """European departments go, but for those that employees still refer to."""
    tables = {"departments": view(s, d, "hr_departments"), "projects": view(s, d, "hr_projects"),
              "employees": view(s, d, "hr_employees").filter("department_id % 2 = 0")}
    return ingest.apply_delete(tables, "departments", _closing(s, d))[table]


def _restrict(s, d):
    return ingest.restrict_check(_closing(s, d), "department_id", {
        "employees": (view(s, d, "hr_employees"), "department_id"),
        "projects": (view(s, d, "hr_projects"), "department_id"),
    })


QUERIES = {
    "dim_date": _dim_date,
    "dim_department_load": _dim_department,
    "dim_project_load": _dim_project,
    "fact_reviews_load": _facts,
    "fact_reviews_incremental": _facts_incremental,
    "fact_reviews_bucketed": _facts_bucketed,
    "fact_reviews_asof": _facts_asof,
    "asof_all_versions": _all_versions,
    "scd2_classify": _classify,
    "scd2_snapshot_apply": lambda s, d: plain(_merge(s, d)),
    "scd2_snapshot_rerun": lambda s, d: plain(_merge_again(s, d)),
    "scd2_from_versions": _versions,
    "scd2_change_log_previous": lambda s, d: _log(s, d, "previous"),
    "scd2_change_log_last_version": lambda s, d: _log(s, d, "last_version"),
    "salary_history": _history,
    "latest_salaries": _latest,
    "transfers_apply": _transferred,
    "transfers_employees": lambda s, d: plain(_transfers(s, d, 0)),
    "transfers_rejected": lambda s, d: _transfers(s, d, 3).select("event_id", "employee_id", "reason"),
    "backfill_nulls": _backfill,
    "insert_ignore_employees": lambda s, d: plain(ingest.insert_ignore(
        view(s, d, "hr_employees_full"), view(s, d, "hr_staff"), ["email"], ["employee_id"]
    ).select("employee_id", "email", "hire_date", "monthly_income")),
    "assignments_upsert": _upsert,
    "deactivate": lambda s, d: plain(ingest.deactivate(
        view(s, d, "hr_employees_full").withColumn("updated_at", F.lit(None).cast("timestamp")),
        view(s, d, "hr_leavers"), AS_OF,
    ).withColumn("updated_at", F.to_date("updated_at"))),
    "project_status_update": lambda s, d: plain(_status(s, d, 0)),
    "project_status_rejected": lambda s, d: _status(s, d, 1).select("project_id", "l_orderkey", "l_linenumber", "status"),
    "onboard_batch": lambda s, d: plain(_onboard(s, d, 0).select(
        "employee_id", "email", "department_id", "monthly_income")),
    "onboard_versions": lambda s, d: plain(_onboard(s, d, 1)),
    "onboard_rejected": _onboard_rejected,
    "append_reviews": _valid_reviews,
    "conform_feed": _conform,
    "apply_defaults": lambda s, d: plain(ingest.apply_defaults(view(s, d, "hr_employees"), "employees")),
    "cascade_delete_children": lambda s, d: _delete_employees(s, d, "performance_reviews"),
    "cascade_delete_assignments": lambda s, d: _delete_employees(s, d, "project_assignments"),
    "delete_employees": lambda s, d: plain(_delete_employees(s, d, "employees")),
    "nullify_refs": lambda s, d: plain(_close_departments(s, d, "projects")),
    "delete_restricted": lambda s, d: _close_departments(s, d, "departments"),
    "delete_without_children": lambda s, d: ingest.apply_delete(
        {"employees": view(s, d, "hr_employees")}, "employees", view(s, d, "hr_leavers"))["employees"].select("employee_id"),
    "insert_ignore_mixed_case": lambda s, d: ingest.insert_ignore(
        _mixed_case(s, d), view(s, d, "hr_staff"), ["email"], ["employee_id"]).select("employee_id", "email"),
    "append_reviews_numbered": lambda s, d: _append(
        s, d, "hr_reviews", quality.review_rules(), "review_id", "review_year < 2000"),
    "append_departments": lambda s, d: _append(
        s, d, "hr_departments", quality.department_rules(), "department_id", "location <> 'ASIA'"),
    "append_projects": lambda s, d: plain(_append(
        s, d, "hr_projects", quality.project_rules(), "project_id", "project_id % 3 = 0").select(
        "project_id", "project_name", "status", "budget")),
    "fact_reviews_asof_hot": partial(_facts_asof, hot_rows=HOT),
    "scd2_from_versions_hot": partial(_versions, hot_rows=HOT),
    "scd2_change_log_hot": _log_hot,
    "salary_apply_employees": lambda s, d: plain(_salaries(s, d, 0).select("employee_id", "monthly_income", F.col("updated_at").isNotNull().alias("touched"))),
    "salary_apply_current": lambda s, d: plain(_salaries(s, d, 1)),
    "salary_apply_closed": lambda s, d: plain(_salaries(s, d, 2)),
    "salary_apply_history": lambda s, d: plain(_salaries(s, d, 3)),
    "restrict_check": _restrict,
}

_FACT_COLUMNS = """m.surrogate_key, m.dept_key, cast(strftime(r.review_date, '%Y%m%d') as int) as date_key,
 r.employee_id, r.review_id, r.performance_rating, r.job_satisfaction, r.environment_satisfaction,
 r.relationship_satisfaction, r.work_life_balance, r.job_involvement,
 cast(e.monthly_income as double) as monthly_income_at_review, e.percent_salary_hike, e.years_at_company,
 e.training_times_last_year, r.review_year, r.review_quarter,
 case when e.attrition = 'Yes' then 1 else 0 end as attrition_flag"""
FACT_STEPS = {
    "m": """select e.employee_id, de.surrogate_key, dd.dept_key from hr_employees_raw e
join hr_departments d on e.department_id = d.department_id
join hr_dim_employee de on de.employee_id = e.employee_id and de.is_current = 1
join hr_dim_department dd on dd.department_id = d.department_id""",
}


def fact_sql(where: str = "", number: str | None = "0") -> str:
    numbered = f", {number} + row_number() over (order by r.review_id, m.surrogate_key) as fact_id" if number else ""
    return f"""select {_FACT_COLUMNS}{numbered} from hr_reviews r join hr_employees_raw e on r.employee_id = e.employee_id
join m on m.employee_id = r.employee_id {where}"""


_PLAIN_DIM = """surrogate_key, employee_id, first_name, last_name, department_name, job_role, job_level,
 cast(monthly_income as double) as monthly_income, over_time, attrition, years_at_company, start_date,
 end_date, is_current"""

_LOG = {
    "e": """select employee_id, event_id, change_ts, cast(new_salary * 100 as bigint) as c,
 row_number() over (partition by employee_id order by change_ts, event_id) as rn from hr_salary_drift""",
}
_FOLD = _LOG | {
    "f": """select employee_id, rn, c as held, true as opened from e where rn = 1
union all
select e.employee_id, e.rn, case when f.held > 0 and abs(e.c - f.held) * 20 > f.held then e.c else f.held end,
 f.held > 0 and abs(e.c - f.held) * 20 > f.held
from f join e on e.employee_id = f.employee_id and e.rn = f.rn + 1""",
    "o": "select e.* from e join f on e.employee_id = f.employee_id and e.rn = f.rn where f.opened",
}
_PREVIOUS = _LOG | {
    "l": "select *, lag(c) over (partition by employee_id order by rn) as p from e",
    "o": "select * from l where p is null or (p > 0 and abs(c - p) * 20 > p)",
}
_CHAIN = """select event_id, employee_id, cast(c as double) / 100 as monthly_income, cast(change_ts as date) as start_date,
 lead(cast(change_ts as date)) over w as end_date, case when lead(rn) over w is null then 1 else 0 end as is_current
from o window w as (partition by employee_id order by rn)"""

_SALARY = {
    "h": """select l.*, coalesce(lag(l.new_salary) over (partition by l.employee_id order by l.change_ts, l.event_id),
 e.monthly_income) as old from hr_salary_log l join hr_employees_full e on l.employee_id = e.employee_id""",
    "x": """select employee_id, new_salary from (select *, row_number() over
 (partition by employee_id order by change_ts desc, event_id desc) as rn from h) where rn = 1""",
    "v": """select employee_id, new_salary from (select *, row_number() over
 (partition by employee_id order by change_ts desc, event_id desc) as rn from h
 where old > 0 and abs(old - new_salary) * 100 > old * 5) where rn = 1""",
}
_NULL_FOLD = {
    "e": """select k as employee_id, event_id, change_ts, cast(new_salary * 100 as bigint) as c,
 row_number() over (partition by k order by change_ts, event_id) as rn
from (select *, case when event_id % 10 <> 3 then employee_id end as k from hr_salary_drift)""",
    "f": """select employee_id, rn, c as held, true as opened from e where rn = 1
union all
select e.employee_id, e.rn, case when f.held > 0 and abs(e.c - f.held) * 20 > f.held then e.c else f.held end,
 f.held > 0 and abs(e.c - f.held) * 20 > f.held
from f join e on e.employee_id is not distinct from f.employee_id and e.rn = f.rn + 1""",
    "o": "select e.* from e join f on e.employee_id is not distinct from f.employee_id and e.rn = f.rn where f.opened",
}

_TRANSFER = {
    "j": """select t.*, case when e.employee_id is null then 'unknown employee'
 when d.department_id is null then 'unknown department' end as reason
from hr_transfers t left join hr_employees_full e on t.employee_id = e.employee_id
left join hr_departments d on t.department_id = d.department_id""",
    "k": """select employee_id, department_id from (select *, row_number() over
 (partition by employee_id order by change_ts desc, event_id desc) as rn from j where reason is null) where rn = 1""",
}

_ERRORS_EMPLOYEE = """coalesce(first_name, '') = '' or coalesce(last_name, '') = '' or email not like '%@%'
 or email not like '%.%' or age not between 18 and 100 or job_level not between 1 and 5 or monthly_income <= 0
 or department_id <= 0 or gender not in ('Male', 'Female', 'Other') or attrition not in ('Yes', 'No')
 or marital_status not in ('Single', 'Married', 'Divorced')
 or business_travel not in ('Non-Travel', 'Travel_Rarely', 'Travel_Frequently')"""
_ONBOARD = {
    "valid": f"select * from hr_hires where not ({_ERRORS_EMPLOYEE})",
    "ranked": """select v.*, row_number() over (partition by lower(email) order by employee_id) as rn,
 lower(email) in (select lower(email) from hr_staff) as taken from valid v""",
    "hired": """select (select max(employee_id) from hr_staff) + row_number() over (order by employee_id) as new_id, *
from ranked where rn = 1 and not taken""",
}

ORACLES = {
    "dim_date": with_views("""select cast(strftime(full_date, '%Y%m%d') as int) as date_key, full_date,
 cast(dayofweek(full_date) + 1 as int) as day_of_week, dayname(full_date) as day_name, cast(day(full_date) as int) as day_of_month,
 cast(dayofyear(full_date) as int) as day_of_year, cast(weekofyear(full_date) as int) as week_of_year,
 cast(month(full_date) as int) as month_number, monthname(full_date) as month_name,
 cast(quarter(full_date) as int) as quarter, cast(year(full_date) as int) as year,
 dayofweek(full_date) in (0, 6) as is_weekend, false as is_holiday from days""", {
        "span": "select min(review_year) as lo, max(review_year) as hi from hr_reviews",
        "days": """select cast(unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), interval 1 day)) as date)
 as full_date from span"""}),
    "dim_department_load": with_views("""select (select max(dept_key) from held) + row_number() over (order by department_id) as dept_key,
 department_id, department_name, location from hr_departments
where department_id not in (select department_id from held)""", {
        "held": "select * from hr_dim_department where location <> 'ASIA'"}),
    "dim_project_load": with_views("""select (select max(project_id) + 1 from held) + row_number() over (order by p.project_id) as project_key,
 p.project_id, p.project_name, p.status, p.start_date, p.end_date, cast(p.budget as double) as budget, dd.dept_key
from hr_projects p left join hr_dim_department dd on p.department_id = dd.department_id
where p.project_id not in (select project_id from held)""", {
        "held": "select project_id from hr_projects where status in ('Completed', 'Cancelled')"}),
    "fact_reviews_load": with_views(fact_sql(), FACT_STEPS),
    "fact_reviews_incremental": with_views(fact_sql(
        "where r.review_id not in (select review_id from hr_fact_loaded)",
        "(select max(review_id) + 1 from hr_fact_loaded)"), FACT_STEPS),
    "asof_all_versions": with_views("""select r.review_id, r.employee_id, r.review_date, d.surrogate_key, d.start_date
from hr_reviews r left join hr_dim_broken d on d.employee_id = r.employee_id and r.review_date >= d.start_date
 and (d.end_date is null or r.review_date < d.end_date)"""),
    "fact_reviews_asof": with_views("""select r.review_id, r.employee_id, r.review_date, r.performance_rating, d.surrogate_key,
 d.department_name, cast(d.monthly_income as double) as monthly_income
from hr_reviews r left join hr_dim_employee d on d.employee_id = r.employee_id and r.review_date >= d.start_date
 and (d.end_date is null or r.review_date < d.end_date)"""),
    "scd2_classify": with_views("select employee_id, status from judged", merge_steps("hr_dim_employee_loaded")),
    "scd2_snapshot_apply": with_views(f"select {_PLAIN_DIM} from merged", merge_steps("hr_dim_employee_loaded")),
    "scd2_snapshot_rerun": with_views(f"select {_PLAIN_DIM} from merged", merge_steps("hr_dim_employee_loaded")),
    "scd2_from_versions": with_views("""select event_id, employee_id, cast(new_salary as double) as new_salary,
 cast(change_ts as date) as start_date, lead(cast(change_ts as date)) over w as end_date,
 case when lead(event_id) over w is null then 1 else 0 end as is_current
from hr_salary_log window w as (partition by employee_id order by change_ts, event_id)"""),
    "scd2_change_log_previous": with_views(_CHAIN, _PREVIOUS),
    "scd2_change_log_last_version": with_views(_CHAIN, _FOLD),
    "salary_history": with_views("""select event_id, employee_id, cast(old as double) as old_salary,
 cast(new_salary as double) as new_salary, cast(change_ts as date) as change_date, change_reason,
 old > 0 and abs(old - new_salary) * 100 > old * 5 as opens_version from h""", {
        "h": """select l.*, coalesce(lag(l.new_salary) over (partition by l.employee_id order by l.change_ts, l.event_id),
 e.monthly_income) as old from hr_salary_log l join hr_employees e on l.employee_id = e.employee_id"""}),
    "latest_salaries": with_views("""select e.* replace (cast(coalesce(l.new_salary, e.monthly_income) as double) as monthly_income)
from hr_employees e left join l on e.employee_id = l.employee_id""", {
        "l": """select employee_id, new_salary from (select *, row_number() over
 (partition by employee_id order by change_ts desc, event_id desc) as rn from hr_salary_log) where rn = 1"""}),
    "transfers_apply": with_views(f"""select d.surrogate_key, d.employee_id, d.first_name, d.last_name, d.department_name,
 d.job_role, d.job_level, cast(d.monthly_income as double) as monthly_income, d.over_time, d.attrition,
 d.years_at_company, d.start_date,
 case when d.is_current = 1 and k.employee_id is not null then date '{AS_OF}' else d.end_date end as end_date,
 case when d.is_current = 1 and k.employee_id is not null then 0 else d.is_current end as is_current
from hr_dim_employee d left join k on d.employee_id = k.employee_id
union all
select (select max(surrogate_key) from hr_dim_employee) + row_number() over (order by e.employee_id), e.employee_id,
 e.first_name, e.last_name, dp.department_name, e.job_role, e.job_level, cast(e.monthly_income as double),
 e.over_time, e.attrition, e.years_at_company, date '{AS_OF}', cast(null as date), 1
from k join hr_employees_full e on k.employee_id = e.employee_id
join hr_departments dp on dp.department_id = k.department_id""", _TRANSFER),
    "transfers_employees": with_views("""select e.* replace (coalesce(k.department_id, e.department_id) as department_id,
 cast(e.monthly_income as double) as monthly_income) from hr_employees_full e left join k on e.employee_id = k.employee_id""", _TRANSFER),
    "transfers_rejected": with_views(
        "select event_id, employee_id, reason from j where reason is not null", _TRANSFER),
    "backfill_nulls": with_views("""select d.surrogate_key, d.employee_id,
 case when d.first_name is null then e.first_name else d.first_name end as first_name,
 case when d.first_name is null then e.last_name else d.last_name end as last_name,
 d.department_name, d.job_role, d.job_level, cast(d.monthly_income as double) as monthly_income,
 case when d.attrition is null then e.over_time else d.over_time end as over_time,
 case when d.attrition is null then e.attrition else d.attrition end as attrition,
 case when d.attrition is null then e.years_at_company else d.years_at_company end as years_at_company,
 d.start_date, d.end_date, d.is_current
from hr_dim_employee d join hr_employees_raw e on d.employee_id = e.employee_id"""),
    "insert_ignore_employees": with_views("""select employee_id, email, hire_date, cast(monthly_income as double) as monthly_income
from (select *, row_number() over (partition by lower(email) order by employee_id) as rn from hr_employees_full)
where rn = 1 and lower(email) not in (select lower(email) from hr_staff)"""),
    "insert_ignore_mixed_case": with_views("""select employee_id, loud as email from (select employee_id, loud, row_number() over
 (partition by lower(loud) order by employee_id) as rn from (select employee_id,
  case when employee_id % 3 = 0 then upper(email) else email end as loud from hr_employees_full))
where rn = 1 and lower(loud) not in (select lower(email) from hr_staff)"""),
    "append_reviews_numbered": with_views("""select * replace (cast((select max(review_id) from hr_reviews where review_year < 2000)
 + row_number() over (order by review_id) as int) as review_id) from hr_reviews
where review_year >= 2000 and review_quarter between 1 and 4
 and performance_rating between 1 and 4 and job_satisfaction between 1 and 4 and environment_satisfaction between 1 and 4
 and relationship_satisfaction between 1 and 4 and work_life_balance between 1 and 4 and job_involvement between 1 and 4"""),
    "append_departments": with_views("""select * replace (cast((select max(department_id) from hr_departments where location <> 'ASIA')
 + row_number() over (order by department_id) as int) as department_id) from hr_departments where location = 'ASIA'"""),
    "append_projects": with_views("""select cast((select max(project_id) from hr_projects where project_id % 3 = 0)
 + row_number() over (order by project_id) as int) as project_id, project_name, status, cast(budget as double) as budget
from hr_projects where project_id % 3 <> 0 and project_name <> '' and budget >= 0 and (end_date is null or end_date >= start_date)
 and status in ('Planning', 'Active', 'On Hold', 'Completed', 'Cancelled')"""),
    "scd2_change_log_hot": with_views(_CHAIN, _NULL_FOLD),
    "salary_apply_employees": with_views("""select e.employee_id, cast(coalesce(x.new_salary, e.monthly_income) as double) as monthly_income,
 x.employee_id is not null as touched from hr_employees_full e left join x on e.employee_id = x.employee_id""", _SALARY),
    "salary_apply_current": with_views(f"""select {_PLAIN_DIM} from hr_dim_employee
where is_current = 1 and employee_id not in (select employee_id from v)
union all
select (select max(surrogate_key) from hr_dim_employee) + row_number() over (order by e.employee_id), e.employee_id,
 e.first_name, e.last_name, d.department_name, e.job_role, e.job_level, cast(v.new_salary as double),
 e.over_time, e.attrition, e.years_at_company, date '{AS_OF}', cast(null as date), 1
from v join hr_employees_full e on v.employee_id = e.employee_id
join hr_departments d on d.department_id = e.department_id""", _SALARY),
    "salary_apply_closed": with_views(f"""select * replace (cast(monthly_income as double) as monthly_income,
 date '{AS_OF}' as end_date, 0 as is_current) from hr_dim_employee
where is_current = 1 and employee_id in (select employee_id from v)""", _SALARY),
    "salary_apply_history": with_views("""select event_id, employee_id, cast(old as double) as old_salary,
 cast(new_salary as double) as new_salary, cast(change_ts as date) as change_date, change_reason,
 old > 0 and abs(old - new_salary) * 100 > old * 5 as opens_version from h""", _SALARY),
    "assignments_upsert": with_views("""select coalesce(h.employee_id, b.employee_id) as employee_id, coalesce(h.project_id, b.project_id) as project_id,
 coalesce(b.role_in_project, h.role_in_project) as role_in_project, coalesce(h.assigned_date, b.assigned_date) as assigned_date,
 h.released_date, coalesce(b.hours_allocated, h.hours_allocated) as hours_allocated
from hr_assignments_held h full join b on h.employee_id = b.employee_id and h.project_id = b.project_id""", {
        "n": """select *, row_number() over (partition by employee_id, project_id
   order by assigned_date, l_orderkey, l_linenumber, hours_allocated, role_in_project) as up,
 row_number() over (partition by employee_id, project_id
   order by assigned_date desc, l_orderkey desc, l_linenumber desc, hours_allocated desc, role_in_project desc) as down
from hr_assignments_new where hours_allocated >= 0 and (released_date is null or released_date >= assigned_date)""",
        "b": """select f.employee_id, f.project_id, f.assigned_date, l.role_in_project, l.hours_allocated
from n f join n l on f.employee_id = l.employee_id and f.project_id = l.project_id and f.up = 1 and l.down = 1"""}),
    "deactivate": with_views(f"""select * exclude (gone) replace (is_active and not gone as is_active,
 case when gone then 'Yes' else attrition end as attrition, cast(monthly_income as double) as monthly_income),
 case when gone then date '{AS_OF}' end as updated_at
from (select *, employee_id in (select employee_id from hr_leavers) as gone from hr_employees_full)"""),
    "project_status_update": with_views("""select p.* replace (coalesce(l.status, p.status) as status, cast(p.budget as double) as budget)
from hr_projects p left join l on p.project_id = l.project_id and l.rn = 1""", {
        "l": """select *, row_number() over (partition by project_id
 order by change_ts desc, l_orderkey desc, l_linenumber desc, status desc) as rn
from hr_status_changes where status <> 'Archived'"""}),
    "project_status_rejected": with_views(
        "select project_id, l_orderkey, l_linenumber, status from hr_status_changes where status = 'Archived'"),
    "onboard_batch": with_views("""select cast(new_id as int) as employee_id, email, department_id,
 cast(monthly_income as double) as monthly_income from hired""", _ONBOARD),
    "onboard_versions": with_views(f"""select (select max(surrogate_key) from hr_dim_employee_loaded) + row_number() over (order by new_id) as surrogate_key,
 cast(new_id as int) as employee_id, first_name, last_name, d.department_name, job_role, job_level,
 cast(monthly_income as double) as monthly_income, over_time, attrition, years_at_company,
 date '{AS_OF}' as start_date, cast(null as date) as end_date, 1 as is_current
from hired join hr_departments d on hired.department_id = d.department_id""", _ONBOARD),
    "onboard_rejected": with_views(f"""select employee_id, 'invalid' as reason from hr_hires where {_ERRORS_EMPLOYEE}
union all select employee_id, 'duplicate e-mail' from ranked where rn > 1 or taken""", _ONBOARD),
    "append_reviews": with_views("""select * from hr_reviews where review_year >= 2000 and review_quarter between 1 and 4
 and performance_rating between 1 and 4 and job_satisfaction between 1 and 4 and environment_satisfaction between 1 and 4
 and relationship_satisfaction between 1 and 4 and work_life_balance between 1 and 4 and job_involvement between 1 and 4"""),
    "conform_feed": with_views("""select cast("EmployeeID" as int) as employee_id, "FirstName" as first_name, "LastName" as last_name,
 "Email" as email, substr("Phone", 1, 15) as phone, "Gender" as gender, cast("Age" as int) as age,
 coalesce(try_cast("HireDate" as date), date '2020-01-01') as hire_date, "JobRole" as job_role,
 cast("JobLevel" as int) as job_level,
 cast(least(greatest(cast("MonthlyIncome" as decimal(10,2)), 1000), 19999) as double) as monthly_income,
 coalesce(d.department_id, 1) as department_id
from hr_feed f left join hr_departments d on f."Department" = d.department_name"""),
    "apply_defaults": with_views("""select employee_id, first_name, last_name, department_id, job_role, job_level,
 cast(monthly_income as double) as monthly_income, 'No' as attrition, 'No' as over_time, 0 as stock_option_level,
 0 as total_working_years, 0 as num_companies_worked, 0 as percent_salary_hike, 0 as training_times_last_year,
 0 as years_at_company, 0 as years_in_current_role, 0 as years_since_last_promo, 0 as years_with_curr_manager,
 true as is_active from hr_employees"""),
    "cascade_delete_children": with_views("""select review_id, employee_id,
 case when reviewer_id in (select employee_id from hr_leavers) then null else reviewer_id end as reviewer_id,
 review_date, review_year, review_quarter, performance_rating, job_satisfaction, environment_satisfaction,
 relationship_satisfaction, work_life_balance, job_involvement
from hr_reviews where employee_id not in (select employee_id from hr_leavers)"""),
    "cascade_delete_assignments": with_views("""select * from hr_assignments
where employee_id not in (select employee_id from hr_leavers)"""),
    "delete_employees": with_views("""select * replace (cast(monthly_income as double) as monthly_income) from hr_employees
where employee_id not in (select employee_id from hr_leavers)"""),
    "nullify_refs": with_views("""select * replace (cast(budget as double) as budget,
 case when department_id in (select department_id from hr_departments
 where location = 'EUROPE' and department_id not in (select department_id from hr_employees where department_id % 2 = 0))
 then null else department_id end as department_id) from hr_projects"""),
    "delete_restricted": with_views("""select * from hr_departments where location <> 'EUROPE'
 or department_id in (select department_id from hr_employees where department_id % 2 = 0)"""),
    "delete_without_children": with_views("""select employee_id from hr_employees
where employee_id not in (select employee_id from hr_leavers)"""),
    "restrict_check": with_views("""select 'employees' as child, count(*) as blocking_rows from hr_employees
 where department_id in (select department_id from hr_departments where location = 'EUROPE')
union all select 'projects', count(*) from hr_projects
 where department_id in (select department_id from hr_departments where location = 'EUROPE')"""),
}
ORACLES["fact_reviews_asof_hot"] = ORACLES["fact_reviews_asof"]
ORACLES["scd2_from_versions_hot"] = ORACLES["scd2_from_versions"]
ORACLES["fact_reviews_bucketed"] = ORACLES["fact_reviews_incremental"]
