"""Data-quality queries and their oracles."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tenurelake.catalog.common import plain
from tenurelake.catalog.fixtures import view, with_views
from tenurelake.functions import scalars as S
from tenurelake.operators import dims, quality

_ENTITIES = {
    "departments": ("hr_departments", quality.department_rules, ["department_id"]),
    "employees": ("hr_employees_full", quality.employee_rules, ["employee_id"]),
    "projects": ("hr_projects", quality.project_rules, ["project_id"]),
    "reviews": ("hr_reviews", quality.review_rules, ["review_id"]),
    "assignments": ("hr_assignments", quality.assignment_rules,
                    ["employee_id", "project_id", "assigned_date", "l_orderkey", "l_linenumber"]),
}


def _errors(s, d, entity):
    name, rules, keys = _ENTITIES[entity]
    return plain(quality.validate(view(s, d, name), rules()).select(*keys, "errors"))


def _report(s, d):
    return quality.quality_report({e: (view(s, d, n), rules()) for e, (n, rules, _) in _ENTITIES.items()})


def _constraints(s, d):
    v = partial(view, s, d)
    emp, reviews, proj = v("hr_employees_full"), v("hr_reviews"), v("hr_projects")
    return (
        quality.check_audit(emp, "employees")
        .unionByName(quality.check_audit(reviews, "performance_reviews"))
        .unionByName(quality.not_null_audit(emp, "employees"))
        .unionByName(quality.not_null_audit(proj, "projects"))
        .unionByName(quality.not_null_audit(v("hr_departments"), "departments"))
        .unionByName(quality.not_null_audit(v("hr_assignments"), "project_assignments"))
        .unionByName(quality.not_null_audit(reviews, "performance_reviews"))
    )


def _unique(s, d):
    v = partial(view, s, d)
    return (
        quality.unique_audit(v("hr_departments"), "departments")
        .unionByName(quality.unique_audit(v("hr_employees_full"), "employees"))
        .unionByName(quality.unique_audit(v("hr_assignments"), "project_assignments"))
        .unionByName(quality.unique_audit(v("hr_dim_department"), "dim_department"))
        .unionByName(quality.unique_audit(v("hr_projects"), "projects"))
        .unionByName(quality.unique_audit(v("hr_reviews"), "performance_reviews"))
    )


def _foreign(s, d):
    v = partial(view, s, d)
    return quality.fk_audit({
        "departments": v("hr_departments"), "employees": v("hr_staff"), "projects": v("hr_projects"),
        "project_assignments": v("hr_assignments"), "performance_reviews": v("hr_reviews"),
        "salary_history": v("hr_salary_log"),
    })


def _foreign_star(s, d):
    v = partial(view, s, d)
    fact = v("hr_fact_reviews").withColumns({
        "date_key": S.date_key(F.col("review_date")), "project_key": (F.col("review_id") % 300).cast("bigint"),
    })
    proj = v("hr_projects").filter("project_id % 5 <> 0").select(
        (F.col("project_id") + 1).cast("bigint").alias("project_key"),
        (F.col("department_id") + 1).cast("bigint").alias("dept_key"),
    )
    return quality.fk_audit({
        "fact_performance_reviews": fact, "dim_employee": v("hr_dim_employee_loaded"), "dim_project": proj,
        "dim_department": v("hr_dim_department").filter("location <> 'ASIA'"),
        "dim_date": dims.dim_date_covering(v("hr_projects"), "start_date"),
    })


def _calendar(s, d):
    days = dims.dim_date_covering(view(s, d, "hr_projects"), "start_date")
    return quality.calendar_audit(view(s, d, "hr_reviews"), "review_date", days)


def _volume(s, d):
    v = partial(view, s, d)
    return quality.volume_audit({
        "departments": (v("hr_departments"), 3),
        "employee snapshot": (v("hr_employees_raw"), 100_000),
        "current versions": (v("hr_dim_employee").filter("is_current = 1"), 5_000),
        "reviews": (v("hr_reviews"), 10_000),
    })


QUERIES = {f"validate_{e}": partial(_errors, entity=e) for e in _ENTITIES} | {
    "quality_report": _report,
    "constraint_audit": _constraints,
    "unique_audit": _unique,
    "fk_audit": _foreign,
    "fk_audit_star": _foreign_star,
    "calendar_audit": _calendar,
    "scd2_integrity": lambda s, d: quality.scd2_integrity(view(s, d, "hr_dim_broken")),
    "volume_audit": _volume,
}

_RULES = {
    "departments": [
        ("Department name cannot be empty.", "trim(department_name) = ''"),
        ("Department name too long (max 100 chars).", "length(department_name) > 100"),
    ],
    "employees": [
        ("First and last name are required.", "first_name = '' or last_name = ''"),
        ("Invalid email address.", "email not like '%@%' or email not like '%.%'"),
        ("Age must be between 18 and 100.", "age < 18 or age > 100"),
        ("Job level must be 1–5.", "job_level < 1 or job_level > 5"),
        ("Monthly income must be positive.", "monthly_income <= 0"),
        ("A valid department must be selected.", "department_id <= 0"),
        ("Gender must be Male, Female, or Other.", "gender not in ('Male', 'Female', 'Other')"),
        ("Attrition must be Yes or No.", "attrition not in ('Yes', 'No')"),
        ("Invalid marital status.", "marital_status not in ('Single', 'Married', 'Divorced')"),
        ("Invalid business travel value.",
         "business_travel not in ('Non-Travel', 'Travel_Rarely', 'Travel_Frequently')"),
    ],
    "projects": [
        ("Project name is required.", "project_name = ''"),
        ("Status must be one of: (''Planning'', ''Active'', ''On Hold'', ''Completed'', ''Cancelled'')",
         "status not in ('Planning', 'Active', 'On Hold', 'Completed', 'Cancelled')"),
        ("End date cannot be before start date.", "end_date < start_date"),
        ("Budget cannot be negative.", "budget < 0"),
    ],
    "reviews": [
        (f"{c} must be between 1 and 4.", f"{c} < 1 or {c} > 4") for c in [
            "performance_rating", "job_satisfaction", "environment_satisfaction",
            "relationship_satisfaction", "work_life_balance", "job_involvement"]
    ] + [
        ("Quarter must be 1–4.", "review_quarter < 1 or review_quarter > 4"),
        ("Review year seems invalid.", "review_year < 2000"),
    ],
    "assignments": [
        ("Hours allocated cannot be negative.", "hours_allocated < 0"),
        ("Release date cannot be before assignment date.", "released_date < assigned_date"),
    ],
}


def _validate_sql(entity: str) -> str:
    name, _, keys = _ENTITIES[entity]
    texts = ", ".join(f"case when {broken} then '{text}' end" for text, broken in _RULES[entity])
    return with_views(f"select {', '.join(keys)}, concat_ws('; ', {texts}) as errors from {name}")


def _report_sql() -> str:
    parts = [
        f"select '{e}' as entity, '{text}' as rule, count(*) as rows from {_ENTITIES[e][0]} where {broken} having count(*) > 0"
        for e, rules in _RULES.items() for text, broken in rules
    ]
    return with_views("\nunion all ".join(parts))


def _audit_sql(table: str, name: str, kind: str, broken: dict[str, str]) -> str:
    return "\nunion all ".join(
        f"select '{table}' as table_name, '{kind} {c}' as rule, count(*) as violations from {name} where {bad}"
        for c, bad in broken.items()
    )


def _unique_sql(table: str, name: str, keys: list[str]) -> str:
    group = ", ".join("lower(email)" if k == "email" else "lower(department_name)" if k == "department_name" else k
                      for k in keys)
    return f"""select '{table}' as table_name, '{", ".join(keys)}' as key_columns, count(*) as repeated_keys,
 cast(coalesce(sum(n - 1), 0) as bigint) as excess_rows
from (select count(*) as n from {name} group by {group} having count(*) > 1)"""


def _orphans_sql(child: str, name: str, column: str, parent: str, view_name: str, key: str) -> str:
    return f"""select '{child}' as child, '{column}' as column_name, '{parent}' as parent, count(*) as orphans
from {name} where {column} is not null and {column} not in (select {key} from {view_name})"""


_SCORES = ["performance_rating", "job_satisfaction", "environment_satisfaction", "relationship_satisfaction",
           "work_life_balance", "job_involvement"]

ORACLES = {f"validate_{e}": _validate_sql(e) for e in _ENTITIES} | {
    "quality_report": _report_sql(),
    "constraint_audit": with_views("\nunion all ".join([
        _audit_sql("employees", "hr_employees_full", "check", {
            "age": "age not between 18 and 100", "job_level": "job_level not between 1 and 5",
            "education": "education not between 1 and 5"}),
        _audit_sql("performance_reviews", "hr_reviews", "check",
                   {c: f"{c} not between 1 and 4" for c in ["review_quarter", *_SCORES]}),
        _audit_sql("employees", "hr_employees_full", "not null", {c: f"{c} is null" for c in [
            "employee_id", "first_name", "last_name", "email", "hire_date", "department_id", "job_role",
            "monthly_income"]}),
        _audit_sql("projects", "hr_projects", "not null",
                   {c: f"{c} is null" for c in ["project_id", "project_name", "start_date"]}),
        *[_audit_sql(table, name, "not null", {c: f"{c} is null" for c in quality.REQUIRED[table]}) for table, name in (
            ("departments", "hr_departments"), ("project_assignments", "hr_assignments"), ("performance_reviews", "hr_reviews"))],
    ])),
    "unique_audit": with_views("\nunion all ".join([
        _unique_sql("departments", "hr_departments", ["department_id"]),
        _unique_sql("departments", "hr_departments", ["department_name"]),
        _unique_sql("employees", "hr_employees_full", ["employee_id"]),
        _unique_sql("employees", "hr_employees_full", ["email"]),
        _unique_sql("project_assignments", "hr_assignments", ["employee_id", "project_id"]),
        _unique_sql("dim_department", "hr_dim_department", ["department_id"]),
        _unique_sql("projects", "hr_projects", ["project_id"]),
        _unique_sql("performance_reviews", "hr_reviews", ["review_id"]),
    ])),
    "fk_audit": with_views("\nunion all ".join([
        _orphans_sql("employees", "hr_staff", "department_id", "departments", "hr_departments", "department_id"),
        _orphans_sql("projects", "hr_projects", "department_id", "departments", "hr_departments", "department_id"),
        _orphans_sql("project_assignments", "hr_assignments", "employee_id", "employees", "hr_staff", "employee_id"),
        _orphans_sql("project_assignments", "hr_assignments", "project_id", "projects", "hr_projects", "project_id"),
        _orphans_sql("performance_reviews", "hr_reviews", "employee_id", "employees", "hr_staff", "employee_id"),
        _orphans_sql("performance_reviews", "hr_reviews", "reviewer_id", "employees", "hr_staff", "employee_id"),
        _orphans_sql("salary_history", "hr_salary_log", "employee_id", "employees", "hr_staff", "employee_id"),
    ])),
    "fk_audit_star": with_views("""select 'fact_performance_reviews' as child, 'surrogate_key' as column_name,
 'dim_employee' as parent, count(*) as orphans from hr_fact_reviews
where surrogate_key not in (select surrogate_key from hr_dim_employee_loaded)
union all select 'fact_performance_reviews', 'dept_key', 'dim_department', count(*) from hr_fact_reviews
where dept_key not in (select dept_key from hr_dim_department where location <> 'ASIA')
union all select 'dim_project', 'dept_key', 'dim_department', count(*) from p
where dept_key not in (select dept_key from hr_dim_department where location <> 'ASIA')
union all select 'fact_performance_reviews', 'project_key', 'dim_project', count(*) from hr_fact_reviews
where review_id % 300 not in (select project_key from p)
union all select 'fact_performance_reviews', 'date_key', 'dim_date', count(*) from hr_fact_reviews
where review_year < (select min(year(start_date)) from hr_projects)
 or review_year > (select max(year(start_date)) from hr_projects)""", {
        "p": "select project_id + 1 as project_key, department_id + 1 as dept_key from hr_projects where project_id % 5 <> 0"}),
    "calendar_audit": with_views("""select cast(strftime(review_date, '%Y%m%d') as int) as date_key, count(*) as rows from hr_reviews
where review_year < (select min(year(start_date)) from hr_projects)
 or review_year > (select max(year(start_date)) from hr_projects) group by review_date"""),
    "scd2_integrity": with_views("""select employee_id, cast(greatest(sum(is_current) - 1, 0) as bigint) as extra_current,
 count(*) filter (where (is_current = 1) <> (end_date is null)) as flag_mismatches,
 count(*) filter (where end_date < start_date) as negative_intervals,
 count(*) filter (where nxt is not null and (end_date is null or end_date > nxt)) as overlaps,
 count(*) filter (where end_date < nxt) as gaps
from v group by employee_id having sum(is_current) > 1
 or count(*) filter (where (is_current = 1) <> (end_date is null)) > 0 or count(*) filter (where end_date < start_date) > 0
 or count(*) filter (where nxt is not null and (end_date is null or end_date > nxt)) > 0
 or count(*) filter (where end_date < nxt) > 0""", {
        "v": """select *, lead(start_date) over (partition by employee_id order by start_date, surrogate_key) as nxt
from hr_dim_broken"""}),
    "volume_audit": with_views("""select check_name, actual, expected, actual >= expected as passed from (
select 'departments' as check_name, count(*) as actual, 3::bigint as expected from hr_departments
union all select 'employee snapshot', count(*), 100000 from hr_employees_raw
union all select 'current versions', count(*), 5000 from hr_dim_employee where is_current = 1
union all select 'reviews', count(*), 10000 from hr_reviews)"""),
}
