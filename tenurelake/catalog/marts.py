"""Mart queries and their oracles."""

from __future__ import annotations

import uuid
from functools import partial

from tenurelake.catalog.common import AS_OF, YEAR, avg2, half_up, plain
from tenurelake.catalog.fixtures import view, with_views
from tenurelake.operators import scd2
from tenurelake.plans import marts as M, rollups
from tenurelake.session import shared_dir
from tenurelake.sources.tables import Warehouse


def _star(spark, sf_dir):
    v = partial(view, spark, sf_dir)
    return v("hr_fact_reviews"), v("hr_dim_employee"), v("hr_dim_department")


def _yoy(spark, sf_dir, full=True):
    fact, _, dept = _star(spark, sf_dir)
    return M.yoy_performance(fact, dept, full)


def _top(spark, sf_dir, **options):
    fact, emp, _ = _star(spark, sf_dir)
    return M.top_performers(fact, emp, **options)


def _risk(spark, sf_dir, full=True):
    fact, emp, _ = _star(spark, sf_dir)
    return M.attrition_risk(fact, emp, full)


def _kpis(spark, sf_dir, with_total=False):
    return plain(M.department_kpis(*_star(spark, sf_dir), with_total))


def _kpis_after_scd2(spark, sf_dir):
    fact, dim, dept = _star(spark, sf_dir)
    after = scd2.scd2_apply_snapshot(view(spark, sf_dir, "hr_snapshot"), dim, AS_OF)
    return M.department_kpis(fact, after, dept)


def _dim(spark, sf_dir):
    return view(spark, sf_dir, "hr_dim_employee")


LOADS = ["review_date < date '1998-01-01'", "review_date between date '1998-01-01' and date '1999-12-31'", "review_date > date '1999-12-31'"]


def _states(spark, sf_dir, state):
    """The states of three loads of reviews, stored one after the other."""
    house = Warehouse(spark, f"{shared_dir(spark)}/states-{uuid.uuid4().hex}")
    for load in LOADS:
        house.append(state(view(spark, sf_dir, "hr_fact_reviews").filter(load)), "review_state")
    return house.read("review_state")


def _kpis_incremental(s, d):
    _, emp, dept = _star(s, d)
    return plain(rollups.kpis_from_state(_states(s, d, rollups.version_state), emp, dept))


def _sketched(s, d):
    parts = [rollups.salary_sketch(_dim(s, d).filter(f"employee_id % 3 = {k}")) for k in range(3)]
    return rollups.box_from_sketch(rollups.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2])))


QUERIES = {
    "yoy_incremental": lambda s, d: rollups.yoy_from_state(
        rollups.merge_yearly(_states(s, d, rollups.yearly_state)), view(s, d, "hr_dim_department")),
    "kpis_incremental": _kpis_incremental,
    "salary_box_sketch": _sketched,
    "yoy_performance": _yoy,
    "yoy_performance_basic": lambda s, d: _yoy(s, d, False),
    "headcount_by_year": lambda s, d: M.headcount_by_year(_yoy(s, d)),
    "satisfaction_by_year": lambda s, d: M.satisfaction_by_year(_yoy(s, d)),
    "top_performers_year": lambda s, d: plain(_top(s, d, year=YEAR, limit=10)),
    "top_performers_all": lambda s, d: plain(_top(s, d, limit=5, tie_break=False)),
    "top_performers_report": lambda s, d: plain(M.top_performers_report(_top(s, d, limit=5, tie_break=False))),
    "attrition_risk": lambda s, d: plain(_risk(s, d)),
    "attrition_risk_basic": lambda s, d: plain(_risk(s, d, False)),
    "risk_distribution": lambda s, d: M.risk_distribution(_risk(s, d)),
    "high_risk_top20": lambda s, d: M.high_risk(_risk(s, d), 20),
    "risk_scatter_500": lambda s, d: M.risk_scatter(_risk(s, d), 500),
    "department_kpis": _kpis,
    "department_kpis_total": lambda s, d: _kpis(s, d, True),
    "kpis_after_scd2": _kpis_after_scd2,
    "employee_history": lambda s, d: plain(M.employee_history(_dim(s, d), AS_OF)),
    "history_of_employee": lambda s, d: plain(M.employee_history(_dim(s, d), AS_OF, 7)),
    "career_timeline": lambda s, d: M.career_timeline(_dim(s, d), AS_OF),
    "salary_distribution": lambda s, d: plain(M.salary_distribution(_dim(s, d))),
    "salary_box": lambda s, d: M.salary_box(_dim(s, d)),
    "job_level_counts": lambda s, d: M.value_counts(_dim(s, d), "job_level", by="key"),
}

_YEARLY = {
    "tally": """select dept_key, review_year, count(*) as n, list(distinct employee_id) as people,
 sum(performance_rating) as s1, sum(job_satisfaction) as s2, sum(work_life_balance) as s3
from hr_fact_reviews group by dept_key, review_year""",
    "g": """select department_name, review_year, sum(n) as n, sum(s1) as s1, sum(s2) as s2, sum(s3) as s3,
 len(list_distinct(flatten(list(people)))) as employee_count
from tally natural join hr_dim_department group by department_name, review_year""",
    "y": f"""select *, {half_up('s1', 'n', 2)} as r, lag({half_up('s1', 'n', 2)}) over
 (partition by department_name order by review_year) as p from g""",
}


# The staff with their current versions, and what each version's reviews add up to.
_STAFF = "select *, first_name || ' ' || last_name as full_name from hr_dim_employee where is_current = 1"


def _tally(columns: str, only: str = "true") -> str:
    sums = ", ".join(f"sum({c}) as {c}" for c in columns.split())
    return f"select surrogate_key, count(*) as held, {sums} from hr_fact_reviews where {only} group by surrogate_key"


def _top_sql(only: str, tie: str, limit: int, columns: str = "*") -> str:
    steps = {
        "staff": _STAFF,
        "tally": _tally("performance_rating", only),
        "board": f"""select employee_id, full_name, department_name, job_role, job_level,
 cast(monthly_income as double) as monthly_income, {avg2('performance_rating', 'held')} as avg_rating, held as total_reviews,
 dense_rank() over (partition by department_name order by performance_rating / held desc{tie}) as dept_rank
from tally join staff using (surrogate_key)""",
    }
    return with_views(f"select {columns} from board where dept_rank <= {limit}", steps)


_TOP_ALL = partial(_top_sql, "true", "", 5)

_SCORES = {"job_satisfaction": "avg_job_satisfaction", "work_life_balance": "avg_wlb", "environment_satisfaction": "avg_env_satisfaction"}
_RISK = {
    "staff": f"{_STAFF} and attrition = 'No'",
    "tally": _tally(" ".join(_SCORES)),
    "g": f"""select employee_id, full_name, department_name, job_role, cast(monthly_income as double) as monthly_income,
 over_time, years_at_company, {', '.join(f"{avg2(c, 'held')} as {name}" for c, name in _SCORES.items())},
 cast((over_time = 'Yes')::int * 3 + coalesce(years_at_company < 2, false)::int * 2
  + {' + '.join(f"(5 - {half_up(c, 'held')})" for c in _SCORES)} as bigint) as risk_score
from staff join tally using (surrogate_key)""",
    "q": """select *, cast(ntile(4) over (order by risk_score desc, employee_id) as int) as risk_quartile from g""",
    "risk": """select * exclude (risk_quartile), case risk_quartile when 1 then 'High Risk' when 2 then 'Medium Risk'
 when 3 then 'Low Risk' when 4 then 'Very Low Risk' end as risk_category from q""",
}


def kpi_steps(dim: str) -> dict[str, str]:
    return {
        "tally": """select surrogate_key, dept_key, count(*) as n, sum(performance_rating) as points, sum(attrition_flag) as gone
from hr_fact_reviews group by surrogate_key, dept_key""",
        "paid": f"select surrogate_key, employee_id, cast(monthly_income * 100 as bigint) as cents from {dim} where is_current = 1",
        "m": f"""select department_name, count(distinct employee_id) as headcount, {half_up('sum(cents * n)', 'sum(n)')} as sal,
 {half_up('sum(points)', 'sum(n)', 2)} as perf, cast(sum(gone) as bigint) as attrition_count, cast(sum(n) as bigint) as total_reviews
from tally natural join paid join hr_dim_department using (dept_key) group by department_name""",
        "t": f"""select * from m union all select 'Company Total', cast(sum(headcount) as bigint),
 {half_up('sum(sal)', 'count(*)')}, {half_up('sum(perf)', 'count(*)')},
 cast(sum(attrition_count) as bigint), cast(sum(total_reviews) as bigint) from m""",
    }


def kpi_sql(source: str) -> str:
    return f"""select department_name, headcount, cast(sal as double) / 100 as avg_salary,
 cast(perf as double) / 100 as avg_performance, attrition_count, total_reviews,
 {avg2('attrition_count * 100', 'headcount')} as attrition_rate_pct from {source}"""


# The dimension after the snapshot merge, as steps "judged" and "merged" over the named dimension.
def merge_steps(dim: str) -> dict[str, str]:
    return {
        "cur": f"select * from {dim} where is_current = 1",
        "judged": """select s.*, case when c.employee_id is null then 'NEW'
 when c.department_name <> s.department_name
   or (c.monthly_income > 0 and abs(c.monthly_income - s.monthly_income) * 100 > c.monthly_income * 5)
 then 'CHANGED' else 'UNCHANGED' end as status
from hr_snapshot s left join cur c on s.employee_id = c.employee_id""",
        "merged": f"""select d.surrogate_key, d.employee_id, d.first_name, d.last_name, d.department_name, d.job_role,
 d.job_level, d.monthly_income, d.over_time, d.attrition, d.years_at_company, d.start_date,
 case when d.is_current = 1 and j.status = 'CHANGED' then date '{AS_OF}' else d.end_date end as end_date,
 case when d.is_current = 1 and j.status = 'CHANGED' then 0 else d.is_current end as is_current
from {dim} d left join judged j on d.employee_id = j.employee_id
union all
select (select max(surrogate_key) from {dim}) + row_number() over (order by employee_id), employee_id,
 first_name, last_name, department_name, job_role, job_level, monthly_income, over_time, attrition,
 years_at_company, date '{AS_OF}', cast(null as date), 1
from judged where status <> 'UNCHANGED'""",
    }


ORACLES = {
    "yoy_performance": with_views(f"""select review_year, department_name, cast(r as double) / 100 as avg_rating,
 {avg2('s2', 'n')} as avg_job_satisfaction, {avg2('s3', 'n')} as avg_wlb, employee_count,
 cast(p as double) / 100 as prev_year_rating, cast(r - p as double) / 100 as rating_change from y""", _YEARLY),
    "yoy_performance_basic": with_views(f"""select review_year, department_name, cast(r as double) / 100 as avg_rating,
 {avg2('s2', 'n')} as avg_satisfaction, employee_count, cast(p as double) / 100 as prev_year_rating from y""", _YEARLY),
    "headcount_by_year": with_views("select department_name, review_year, employee_count from y", _YEARLY),
    "satisfaction_by_year": with_views(
        f"select review_year, department_name, {avg2('s2', 'n')} as avg_satisfaction from y", _YEARLY),
    "top_performers_year": _top_sql(f"review_year = {YEAR}", ", monthly_income desc", 10),
    "top_performers_all": _TOP_ALL(),
    "top_performers_report": _TOP_ALL(
        'dept_rank as "Rank", full_name as "Name", department_name as "Dept", job_role as "Role",'
        ' job_level as "Level", avg_rating as "Avg Rating", monthly_income as "Monthly Income"'),
    "attrition_risk": with_views("select * from risk", _RISK),
    "attrition_risk_basic": with_views(
        "select * exclude (avg_env_satisfaction, avg_job_satisfaction), avg_job_satisfaction as avg_satisfaction from q",
        _RISK),
    "risk_distribution": with_views(
        "select risk_category as category, count(*) as count from risk group by risk_category", _RISK),
    "high_risk_top20": with_views("""select employee_id, full_name, department_name, job_role, over_time, years_at_company,
 risk_score from risk where risk_category = 'High Risk' order by risk_score desc, employee_id limit 20""", _RISK),
    "risk_scatter_500": with_views("""select employee_id, full_name, department_name, over_time, avg_job_satisfaction as avg_satisfaction, avg_wlb, risk_category,
 risk_score from risk order by risk_score desc, employee_id limit 500""", _RISK),
    "department_kpis": with_views(kpi_sql("m"), kpi_steps("hr_dim_employee")),
    "department_kpis_total": with_views(kpi_sql("t"), kpi_steps("hr_dim_employee")),
    "kpis_after_scd2": with_views(kpi_sql("m"), merge_steps("hr_dim_employee") | kpi_steps("merged")),
    "employee_history": with_views(f"""select surrogate_key, employee_id, department_name, job_role, job_level,
 cast(monthly_income as double) as monthly_income, start_date,
 coalesce(cast(end_date as varchar), 'Present') as end_date, is_current,
 cast(coalesce(end_date, date '{AS_OF}') - start_date as int) as days_in_role from hr_dim_employee"""),
    "career_timeline": with_views(f"""select surrogate_key, employee_id, department_name, job_role, start_date as start,
 coalesce(end_date, date '{AS_OF}') as "end" from hr_dim_employee"""),
    "salary_distribution": with_views("""select employee_id, department_name, job_role, cast(monthly_income as double) as monthly_income,
 case when n = 1 then 0.0::double else cast((2 * lt * 1000 + (n - 1)) // (2 * (n - 1)) as double) / 10 end as salary_percentile,
 cast((2 * s + n) // (2 * n) as double) / 100 as dept_avg_salary from r""", {
        "r": """select *, rank() over (partition by department_name order by monthly_income) - 1 as lt,
 count(*) over (partition by department_name) as n,
 sum(cast(monthly_income * 100 as bigint)) over (partition by department_name) as s
from hr_dim_employee where is_current = 1"""}),
    "salary_box": with_views("""select department_name, count(*) as employees,
 round(cast(min(c) as double) / 100, 4) as min_salary, round(quantile_cont(c, 0.25) / 100, 4) as q1_salary,
 round(quantile_cont(c, 0.5) / 100, 4) as median_salary, round(quantile_cont(c, 0.75) / 100, 4) as q3_salary,
 round(cast(max(c) as double) / 100, 4) as max_salary from r group by department_name""", {
        "r": "select department_name, cast(monthly_income * 100 as bigint) as c from hr_dim_employee where is_current = 1"}),
    "job_level_counts": with_views("select job_level, count(*) as count from hr_dim_employee group by job_level"),
}
ORACLES["history_of_employee"] = f"select * from ({ORACLES['employee_history']}) where employee_id = 7"

ORACLES["yoy_incremental"] = ORACLES["yoy_performance"]
ORACLES["kpis_incremental"] = ORACLES["department_kpis"]
