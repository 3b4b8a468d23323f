"""The workforce tables as views over the supplied tables, in SQL both Spark and DuckDB read.

One text serves both engines, so a query and its oracle start from the same rows. See FIXTURES.md.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

RAW = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]

VIEWS: dict[str, str] = {
    "hr_departments": """
select n_nationkey as department_id, n_name as department_name, r_name as location
from nation join region on n_regionkey = r_regionkey""",
    "hr_employees_raw": """
select cast(c_custkey as int) as employee_id,
 split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
 'emp' || cast(case when c_custkey % 50 = 49 then c_custkey - 1 else c_custkey end as varchar(20))
   || case when c_custkey % 97 = 5 then '' else '@corp.example' end as email,
 case c_custkey % 3 when 0 then 'Male' when 1 then 'Female' else 'Other' end as gender,
 cast(case when c_custkey % 89 = 3 then 15 else 18 + c_custkey % 47 end as int) as age,
 c_nationkey as department_id, c_mktsegment as job_role, cast(1 + c_custkey % 5 as int) as job_level,
 cast(cast(c_acctbal as decimal(10,2)) * 2 + 500 as decimal(10,2)) as monthly_income,
 case when c_custkey % 100 < 28 then 'Yes' else 'No' end as over_time,
 case when c_custkey % 25 < 4 then 'Yes' else 'No' end as attrition,
 cast(c_custkey % 41 as int) as years_at_company,
 cast(11 + c_custkey % 15 as int) as percent_salary_hike,
 cast(c_custkey % 7 as int) as training_times_last_year,
 c_custkey % 20 <> 7 as is_active
from customer""",
    "hr_employees_full": """
select r.*,
 date '1990-01-01' + cast(employee_id % 4000 as int) as hire_date,
 '+1-555-' || cast(1000000 + employee_id as varchar(20)) as phone,
 case when employee_id % 61 = 7 then 'Unknown' when employee_id % 3 = 0 then 'Single'
      when employee_id % 3 = 1 then 'Married' else 'Divorced' end as marital_status,
 case when employee_id % 67 = 8 then 'Remote' when employee_id % 4 = 0 then 'Non-Travel'
      when employee_id % 4 = 1 then 'Travel_Frequently' else 'Travel_Rarely' end as business_travel,
 cast(case when employee_id % 71 = 9 then 6 else 1 + employee_id % 5 end as int) as education,
 case when employee_id % 2 = 0 then 'Medical' else 'Marketing' end as education_field,
 cast(employee_id % 4 as int) as stock_option_level,
 cast(employee_id % 41 + employee_id % 6 as int) as total_working_years
from hr_employees_raw r""",
    "hr_employees": """
select employee_id, first_name, last_name, department_id, job_role, job_level,
 cast(least(greatest(monthly_income, 1000), 19999) as decimal(10,2)) as monthly_income
from hr_employees_raw""",
    # the next day's snapshot: some move department, raises run from 0 % through exactly 5 % to 12 %
    "hr_incoming": """
select employee_id,
 case when employee_id % 7 = 0 then (department_id + 1) % 25 else department_id end as department_id,
 cast(monthly_income * (1.00 + 0.01 * (employee_id % 13)) as decimal(10,2)) as monthly_income
from hr_employees""",
    "hr_snapshot": """
select f.employee_id, f.first_name, f.last_name, f.email, f.gender, f.age, f.education, f.education_field,
 f.marital_status, d.department_name, f.job_role, f.job_level, i.monthly_income, f.business_travel,
 f.over_time, f.attrition, f.stock_option_level, f.total_working_years, f.years_at_company,
 f.percent_salary_hike
from hr_employees_full f join hr_incoming i on f.employee_id = i.employee_id
join hr_departments d on i.department_id = d.department_id""",
    "hr_reviews": """
select cast(o_orderkey as int) as review_id, cast(o_custkey as int) as employee_id,
 cast(case when o_orderkey % 5 = 0 then null else o_orderkey % 100 end as int) as reviewer_id,
 cast(o_orderdate as date) as review_date, cast(year(o_orderdate) as int) as review_year,
 cast(quarter(o_orderdate) as int) as review_quarter,
 cast(1 + ((o_orderkey*31 + o_custkey*17) % 101) % 4 as int) as performance_rating,
 cast(1 + ((o_orderkey*37 + o_custkey*13) % 103) % 4 as int) as job_satisfaction,
 cast(1 + ((o_orderkey*41 + o_custkey*11) % 107) % 4 as int) as environment_satisfaction,
 cast(1 + ((o_orderkey*43 + o_custkey*7) % 109) % 4 as int) as relationship_satisfaction,
 cast(1 + ((o_orderkey*47 + o_custkey*5) % 113) % 4 as int) as work_life_balance,
 cast(case when o_orderkey % 211 = 7 then 5 else 1 + ((o_orderkey*53 + o_custkey*3) % 127) % 4 end as int)
   as job_involvement
from orders""",
    "hr_projects": """
select cast(p_partkey as int) as project_id, p_name as project_name,
 cast(case when p_partkey % 11 = 0 then null else p_partkey % 25 end as int) as department_id,
 date '1995-01-01' + cast(p_partkey % 1500 as int) as start_date,
 case when p_partkey % 9 = 0 then cast(null as date)
      when p_partkey % 97 = 3 then date '1994-06-01'
      else date '1999-02-10' + cast(p_partkey % 700 as int) end as end_date,
 case p_size % 6 when 0 then 'Planning' when 1 then 'Active' when 2 then 'On Hold' when 3 then 'Completed'
   when 4 then 'Cancelled' else 'Unknown' end as status,
 cast(cast(case when p_partkey % 83 = 4 then -p_retailprice else p_retailprice end as decimal(10,2)) * 500
   as decimal(15,2)) as budget
from part""",
    "hr_assignments": """
select cast(o_custkey as int) as employee_id, cast(l_partkey as int) as project_id,
 cast(l_shipdate as date) as assigned_date, cast(l_quantity as int) as hours_allocated,
 case l_linenumber % 5 when 0 then 'Lead' when 1 then 'Contributor' when 2 then 'Analyst'
   when 3 then 'Reviewer' else 'Coordinator' end as role_in_project,
 cast(case when l_returnflag = 'R' then cast(l_shipdate as date) + cast(l_linenumber * 30 - 45 as int)
   else null end as date) as released_date,
 l_orderkey, l_linenumber
from lineitem join orders on l_orderkey = o_orderkey""",
    "hr_salary_log": """
select event_id, cast(user_id as int) as employee_id, ts as change_ts,
 cast(1000 + cast(value as decimal(10,2)) * 30 as decimal(10,2)) as new_salary,
 event_type as change_reason
from events""",
    # small steps: separates comparing with the last value from comparing with the last version
    "hr_salary_drift": """
select event_id, cast(user_id as int) as employee_id, ts as change_ts,
 cast(5000 + 0.23 * ((day(ts) - 1) * 1440 + hour(ts) * 60 + minute(ts)) as decimal(10,2)) as new_salary
from events""",
    "hr_transfers": """
select event_id, ts as change_ts,
 cast(case when event_type = 'error' then -1 - user_id else user_id end as int) as employee_id,
 cast((user_id + event_id) % 26 as int) as department_id
from events""",
    "hr_leavers": """
select employee_id from hr_employees_raw where monthly_income <= 500""",
    "hr_status_changes": """
select cast(l_partkey as int) as project_id, l_shipdate as change_ts, l_orderkey, l_linenumber,
 case l_linenumber % 6 when 0 then 'Archived' when 1 then 'Active' when 2 then 'On Hold' when 3 then 'Completed'
   when 4 then 'Cancelled' else 'Planning' end as status
from lineitem""",
    "hr_dim_department": """
select cast(department_id + 1 as bigint) as dept_key, department_id, department_name, location
from hr_departments""",
    # every employee's current version, and a closed older one for those on overtime; with NULL names
    # and attrition (history rows not yet repaired), NULL departments and zero incomes
    "hr_dim_employee": """
select cast(employee_id as bigint) * 2 + 2 as surrogate_key, employee_id,
 case when employee_id % 17 = 2 then null else first_name end as first_name, last_name,
 case when employee_id % 103 = 1 then null else 'NATION_' || cast(department_id as varchar(10)) end
   as department_name,
 job_role, job_level,
 cast(case when employee_id % 101 = 1 then 0 else least(greatest(monthly_income, 1000), 19999) end
   as decimal(10,2)) as monthly_income,
 over_time, case when employee_id % 17 = 2 then null else attrition end as attrition, years_at_company,
 date '2000-01-01' as start_date, cast(null as date) as end_date, 1 as is_current
from hr_employees_raw
union all
select cast(employee_id as bigint) * 2 + 1, employee_id, first_name, last_name,
 'NATION_' || cast((department_id + 3) % 25 as varchar(10)), job_role, job_level,
 cast(least(greatest(monthly_income, 1000), 19999) * 0.80 as decimal(10,2)), over_time, attrition,
 years_at_company, date '1998-01-01', date '2000-01-01', 0
from hr_employees_raw where over_time = 'Yes'""",
    # the dimension as last night's run left it: this year's hires are not in it yet
    "hr_dim_employee_loaded": """
select * from hr_dim_employee where years_at_company >= 4""",
    "hr_fact_reviews": """
select r.review_id, de.surrogate_key, dd.dept_key, r.employee_id, r.review_date,
 r.performance_rating, r.job_satisfaction, r.environment_satisfaction, r.work_life_balance,
 r.review_year, r.review_quarter, case when e.attrition = 'Yes' then 1 else 0 end as attrition_flag
from hr_reviews r join hr_employees_raw e on r.employee_id = e.employee_id
join hr_dim_employee de on de.employee_id = r.employee_id and de.is_current = 1
join hr_dim_department dd on dd.department_id = e.department_id""",
    # facts loaded before the last period's reviews came in
    "hr_fact_loaded": """
select * from hr_fact_reviews where review_date < date '2001-01-01'""",
    # versions with every kind of fault the integrity check looks for
    "hr_dim_broken": """
select surrogate_key, employee_id, start_date,
 case when is_current = 1 then end_date when job_level = 1 then date '2000-06-01'
      when job_level = 2 then date '1999-01-01' when job_level = 3 then date '1997-01-01'
      else end_date end as end_date,
 case when is_current = 0 and job_level = 4 then 1 else is_current end as is_current
from hr_dim_employee""",
    "hr_assignments_held": """
select employee_id, project_id, max(role_in_project) as role_in_project, min(assigned_date) as assigned_date,
 max(released_date) as released_date, max(hours_allocated) as hours_allocated
from hr_assignments where assigned_date < date '1998-01-01' group by employee_id, project_id""",
    "hr_assignments_new": """
select * from hr_assignments where assigned_date >= date '1998-01-01'""",
    "hr_hires": """
select * from hr_employees_full where years_at_company < 4""",
    "hr_staff": """
select * from hr_employees_full where years_at_company >= 4""",
    "hr_feed": """
select cast(employee_id as varchar(20)) as "EmployeeID", first_name as "FirstName", last_name as "LastName",
 email as "Email", phone || '-extension-4711' as "Phone", gender as "Gender",
 cast(age as varchar(20)) as "Age",
 case when employee_id % 19 = 6 then 'soon' when employee_id % 37 = 5 then null
   else cast(hire_date as varchar(20)) end as "HireDate",
 case when employee_id % 23 = 4 then 'Skunkworks' else 'NATION_' || cast(department_id as varchar(10)) end
   as "Department",
 job_role as "JobRole", cast(job_level as varchar(20)) as "JobLevel",
 cast(monthly_income as varchar(20)) as "MonthlyIncome"
from hr_employees_full""",
}


def needs(sql: str) -> list[str]:
    """Views (in definition order) that ``sql`` reads, directly or through other views."""
    wanted: set[str] = set()
    stack = [sql]
    while stack:
        text = stack.pop()
        for name in re.findall(r"\bhr_\w+", text):
            if name in VIEWS and name not in wanted:
                wanted.add(name)
                stack.append(VIEWS[name])
    return [name for name in VIEWS if name in wanted]


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` preceded by a WITH list of the views it reads and of the ``extra`` steps."""
    extra = extra or {}
    steps = [(n, VIEWS[n]) for n in needs(" ".join([*extra.values(), sql]))] + list(extra.items())
    if not steps:
        return sql
    return "with recursive " + ",\n".join(f"{n} as ({s})" for n, s in steps) + "\n" + sql


# Views that ``store`` has written, by data folder and name.
STORED: dict[tuple[str, str], str] = {}


def store(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Writes every view once under ``folder``; queries over ``sf_dir`` then read those tables, as
    they would read a warehouse's, instead of working the views out each time."""
    for name in VIEWS:
        view(spark, sf_dir, name).write.parquet(f"{folder}/{name}")
    STORED.update({(sf_dir, name): f"{folder}/{name}" for name in VIEWS})
    view.cache_clear()


@lru_cache(maxsize=256)
def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view (or supplied table) as a DataFrame over ``sf_dir``; a plan, no data is kept."""
    if (sf_dir, name) in STORED:
        return spark.read.parquet(STORED[sf_dir, name])
    if name in RAW:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    used = {t for t in [*RAW, *VIEWS] if re.search(rf"\b{t}\b", VIEWS[name])}
    text = re.sub(rf"\b({'|'.join(used)})\b", r"{\1}", VIEWS[name]).replace('"', "`")
    return spark.sql(text, **{t: view(spark, sf_dir, t) for t in used})
