"""Browse and enrichment queries and their oracles."""

from __future__ import annotations

import uuid

from tenurelake.catalog.common import YEAR, avg2, plain
from tenurelake.catalog.fixtures import view, with_views
from tenurelake.plans import browse as B, search
from tenurelake.session import shared_dir


def _emp_dept(s, d):
    return view(s, d, "hr_employees_full"), view(s, d, "hr_departments")


def _assignments(s, d):
    return B.project_assignments(view(s, d, "hr_assignments"), *_emp_dept(s, d))


def _indexed(s, d, keyword):
    path = f"{shared_dir(s)}/search-{uuid.uuid4().hex}"
    search.build_index(view(s, d, "hr_employees_full"), path)
    return plain(search.search_indexed(*_emp_dept(s, d), keyword, path))


ONE = 7  # the id that the look-ups of one row or one employee ask for

QUERIES = {
    "search_indexed": lambda s, d: _indexed(s, d, "Mach"),
    "search_indexed_wildcards": lambda s, d: _indexed(s, d, "mp%3_@corp"),
    "search_indexed_short": lambda s, d: _indexed(s, d, "p1"),
    "department_by_id": lambda s, d: B.department_by_id(view(s, d, "hr_departments"), ONE),
    "employee_by_id": lambda s, d: plain(B.employee_detail(*_emp_dept(s, d), ONE)),
    "project_by_id": lambda s, d: plain(B.project_by_id(view(s, d, "hr_projects"), ONE)),
    "assignments_of_project": lambda s, d: B.project_assignments(view(s, d, "hr_assignments"), *_emp_dept(s, d), ONE),
    "reviews_of_employee": lambda s, d: B.reviews_by_employee(
        view(s, d, "hr_reviews"), view(s, d, "hr_employees_full"), ONE),
    "rating_trend_of_employee": lambda s, d: B.rating_trend(view(s, d, "hr_reviews"), ONE),
    "first_employees": lambda s, d: B.first_n(view(s, d, "hr_employees_raw"), "employee_id", 100).select("employee_id", "email"),
    "departments": lambda s, d: B.departments(view(s, d, "hr_departments")),
    "employee_directory": lambda s, d: plain(B.employee_directory(*_emp_dept(s, d))),
    "employee_directory_all": lambda s, d: plain(B.employee_directory(*_emp_dept(s, d), active_only=False)),
    "employee_detail": lambda s, d: plain(B.employee_detail(*_emp_dept(s, d))),
    "employee_search": lambda s, d: plain(B.employee_search(*_emp_dept(s, d), "mach")),
    "projects": lambda s, d: plain(B.projects(view(s, d, "hr_projects"), view(s, d, "hr_departments"))),
    "project_assignments": _assignments,
    "reviews_by_employee": lambda s, d: B.reviews_by_employee(
        view(s, d, "hr_reviews"), view(s, d, "hr_employees_full")),
    "reviews_by_year": lambda s, d: B.reviews_by_year(view(s, d, "hr_reviews"), YEAR),
    "rating_trend": lambda s, d: B.rating_trend(view(s, d, "hr_reviews")),
    "inventory": lambda s, d: B.inventory(*_emp_dept(s, d), view(s, d, "hr_dim_employee")),
    "enrich_reviews": lambda s, d: B.enrich_reviews(view(s, d, "hr_reviews")),
    "enrich_employees": lambda s, d: plain(B.enrich_employees(view(s, d, "hr_employees_full"))),
    "enrich_projects": lambda s, d: plain(B.enrich_projects(view(s, d, "hr_projects"))),
    "enrich_assignments": lambda s, d: B.enrich_assignments(view(s, d, "hr_assignments")),
    "sample_employees": lambda s, d: B.sample_exact(
        view(s, d, "hr_employees_raw"), "employee_id", 300).select("employee_id", "email"),
}

_DIRECTORY = """select e.employee_id, e.first_name, e.last_name, e.first_name || ' ' || e.last_name as full_name, e.email,
 e.gender, e.age, d.department_name, e.job_role, e.job_level, cast(e.monthly_income as double) as monthly_income,
 e.attrition, e.over_time, e.years_at_company, e.hire_date, e.is_active
from hr_employees_full e join hr_departments d on e.department_id = d.department_id"""
_SCORE_SUM = ("performance_rating + job_satisfaction + environment_satisfaction + relationship_satisfaction"
              " + work_life_balance + job_involvement")

def _search_sql(keyword):
    hit = " or ".join(f"e.{c} ilike '%{keyword}%'" for c in ("first_name", "last_name", "email", "job_role"))
    return with_views(f"""select e.employee_id, e.first_name || ' ' || e.last_name as full_name, e.email, e.job_role,
 d.department_name, cast(e.monthly_income as double) as monthly_income, e.attrition
from hr_employees_full e join hr_departments d on e.department_id = d.department_id where {hit}""")


ORACLES = {
    "search_indexed": _search_sql("Mach"),
    "search_indexed_wildcards": _search_sql("mp%3_@corp"),
    "search_indexed_short": _search_sql("p1"),
    "departments": with_views("select department_id, department_name, location from hr_departments"),
    "employee_directory": with_views(f"{_DIRECTORY} where e.is_active"),
    "employee_directory_all": with_views(_DIRECTORY),
    "employee_detail": with_views("""select e.* exclude (monthly_income), cast(e.monthly_income as double) as monthly_income, d.department_name
from hr_employees_full e join hr_departments d on e.department_id = d.department_id"""),
    "employee_search": with_views("""select e.employee_id, e.first_name || ' ' || e.last_name as full_name, e.email, e.job_role,
 d.department_name, cast(e.monthly_income as double) as monthly_income, e.attrition
from hr_employees_full e join hr_departments d on e.department_id = d.department_id
where e.first_name ilike '%mach%' or e.last_name ilike '%mach%' or e.email ilike '%mach%' or e.job_role ilike '%mach%'"""),
    "projects": with_views("""select p.* exclude (budget), cast(p.budget as double) as budget, d.department_name
from hr_projects p left join hr_departments d on p.department_id = d.department_id"""),
    "project_assignments": with_views("""select a.*, e.first_name || ' ' || e.last_name as employee_name, e.job_role, d.department_name
from hr_assignments a join hr_employees_full e on a.employee_id = e.employee_id
join hr_departments d on e.department_id = d.department_id"""),
    "reviews_by_employee": with_views("""select r.*, e.first_name || ' ' || e.last_name as reviewer_name
from hr_reviews r left join hr_employees_full e on r.reviewer_id = e.employee_id"""),
    "reviews_by_year": with_views(f"select * from hr_reviews where review_year = {YEAR}"),
    "rating_trend": with_views("select employee_id, review_year, review_id, performance_rating from hr_reviews"),
    "inventory": with_views("""select 'size' as section, 'snapshot rows' as item, count(*) as rows from hr_employees_full
union all select 'size', 'history rows', count(*) from hr_dim_employee
union all select 'size', 'employees with history', count(distinct employee_id) from hr_dim_employee
union all select 'size', 'current records', count(*) from hr_dim_employee where is_current = 1
union all select 'size', 'historical records', count(*) from hr_dim_employee where is_current = 0
union all select 'department', d.department_name, count(*) from hr_employees_full e join hr_departments d
 on e.department_id = d.department_id group by d.department_name
union all select 'job level', cast(job_level as varchar), count(*) from hr_employees_full group by job_level"""),
    "enrich_reviews": with_views(f"""select review_id, employee_id, reviewer_id, cast(review_date as varchar) as review_date, review_year,
 review_quarter, performance_rating, job_satisfaction, environment_satisfaction, relationship_satisfaction,
 work_life_balance, job_involvement, case performance_rating when 1 then 'Poor' when 2 then 'Below Average'
 when 3 then 'Good' when 4 then 'Outstanding' else 'Unknown' end as rating_label,
 {avg2(_SCORE_SUM, '6')} as overall_score from hr_reviews"""),
    "enrich_employees": with_views("""select * exclude (monthly_income, hire_date), cast(monthly_income as double) as monthly_income,
 cast(hire_date as varchar) as hire_date, first_name || ' ' || last_name as full_name,
 cast(monthly_income * 12 as double) as annual_income from hr_employees_full"""),
    "enrich_projects": with_views("""select * exclude (start_date, end_date, budget), cast(start_date as varchar) as start_date,
 cast(end_date as varchar) as end_date, cast(budget as double) as budget, status = 'Active' as is_active,
 cast(end_date - start_date as int) as duration_days from hr_projects"""),
    "enrich_assignments": with_views("""select * exclude (assigned_date, released_date), cast(assigned_date as varchar) as assigned_date,
 cast(released_date as varchar) as released_date from hr_assignments"""),
    "sample_employees": with_views("""select employee_id, email from hr_employees_raw
order by md5(cast(employee_id as varchar) || ':42'), employee_id limit 300"""),
}


def _of_one(name: str, where: str) -> str:
    return f"select * from ({ORACLES[name]}) where {where}"


ORACLES |= {
    "department_by_id": with_views(f"select * from hr_departments where department_id = {ONE}"),
    "employee_by_id": _of_one("employee_detail", f"employee_id = {ONE}"),
    "project_by_id": with_views(f"""select * exclude (budget), cast(budget as double) as budget
from hr_projects where project_id = {ONE}"""),
    "assignments_of_project": _of_one("project_assignments", f"project_id = {ONE}"),
    "reviews_of_employee": _of_one("reviews_by_employee", f"employee_id = {ONE}"),
    "rating_trend_of_employee": _of_one("rating_trend", f"employee_id = {ONE}"),
    "first_employees": with_views("select employee_id, email from hr_employees_raw order by employee_id limit 100"),
}
