"""Declared table schemas, enumerations and column defaults of the two schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# The allowed words of the enumerated columns.
GENDERS = ["Male", "Female", "Other"]
YES_NO = ["Yes", "No"]
MARITAL = ["Single", "Married", "Divorced"]
TRAVEL = ["Non-Travel", "Travel_Rarely", "Travel_Frequently"]
PROJECT_STATUS = ["Planning", "Active", "On Hold", "Completed", "Cancelled"]

# The departments every new warehouse starts with.
SEED_DEPARTMENTS = [
    (1, "Sales", "New York"),
    (2, "Research & Development", "San Francisco"),
    (3, "Human Resources", "Chicago"),
]

MONEY = "decimal(10,2)"

DEPARTMENTS = "department_id int, department_name string, location string, created_at timestamp"
EMPLOYEES = (
    "employee_id int, first_name string, last_name string, email string, phone string, gender string, "
    "age int, date_of_birth date, hire_date date, department_id int, job_role string, job_level int, "
    f"monthly_income {MONEY}, education int, education_field string, marital_status string, "
    "business_travel string, distance_from_home int, attrition string, over_time string, "
    "stock_option_level int, total_working_years int, num_companies_worked int, percent_salary_hike int, "
    "training_times_last_year int, years_at_company int, years_in_current_role int, "
    "years_since_last_promo int, years_with_curr_manager int, is_active boolean, "
    "created_at timestamp, updated_at timestamp"
)
PROJECTS = (
    "project_id int, project_name string, department_id int, start_date date, end_date date, "
    "status string, budget decimal(15,2), description string, created_at timestamp"
)
ASSIGNMENTS = (
    "assignment_id bigint, employee_id int, project_id int, role_in_project string, assigned_date date, "
    "released_date date, hours_allocated int"
)
REVIEWS = (
    "review_id bigint, employee_id int, reviewer_id int, review_date date, review_year int, "
    "review_quarter int, performance_rating int, job_satisfaction int, environment_satisfaction int, "
    "relationship_satisfaction int, work_life_balance int, job_involvement int, comments string, "
    "created_at timestamp"
)
SALARY_HISTORY = (
    f"history_id bigint, employee_id int, old_salary {MONEY}, new_salary {MONEY}, change_date date, "
    "change_reason string, changed_by int"
)
DIM_DATE = (
    "date_key int, full_date date, day_of_week int, day_name string, day_of_month int, day_of_year int, "
    "week_of_year int, month_number int, month_name string, quarter int, year int, is_weekend boolean, "
    "is_holiday boolean"
)
DIM_DEPARTMENT = "dept_key bigint, department_id int, department_name string, location string"
DIM_PROJECT = (
    "project_key bigint, project_id int, project_name string, status string, start_date date, "
    "end_date date, budget decimal(15,2), dept_key bigint"
)
DIM_EMPLOYEE = (
    "surrogate_key bigint, employee_id int, first_name string, last_name string, email string, "
    "gender string, age int, education int, education_field string, marital_status string, "
    f"department_name string, job_role string, job_level int, monthly_income {MONEY}, "
    "business_travel string, over_time string, attrition string, stock_option_level int, "
    "total_working_years int, years_at_company int, percent_salary_hike int, performance_rating int, "
    "environment_satisfaction int, job_satisfaction int, start_date date, end_date date, is_current int"
)
FACT_REVIEWS = (
    "fact_id bigint, surrogate_key bigint, dept_key bigint, project_key bigint, date_key int, "
    "employee_id int, review_id bigint, performance_rating int, job_satisfaction int, "
    "environment_satisfaction int, relationship_satisfaction int, work_life_balance int, "
    f"job_involvement int, monthly_income_at_review {MONEY}, percent_salary_hike int, "
    "years_at_company int, training_times_last_year int, review_year int, review_quarter int, "
    "attrition_flag int"
)
TABLES = {
    "departments": DEPARTMENTS,
    "employees": EMPLOYEES,
    "projects": PROJECTS,
    "project_assignments": ASSIGNMENTS,
    "performance_reviews": REVIEWS,
    "salary_history": SALARY_HISTORY,
    "dim_date": DIM_DATE,
    "dim_department": DIM_DEPARTMENT,
    "dim_project": DIM_PROJECT,
    "dim_employee": DIM_EMPLOYEE,
    "fact_performance_reviews": FACT_REVIEWS,
}

# Feed columns as the CSV files carry them. Every field is read as text and conformed later, so
# one bad value costs a field, not a row.
EMPLOYEE_FEED = {
    "EmployeeID": "employee_id", "FirstName": "first_name", "LastName": "last_name", "Email": "email",
    "Phone": "phone", "Gender": "gender", "Age": "age", "HireDate": "hire_date",
    "Department": "department_name", "JobRole": "job_role", "JobLevel": "job_level",
    "MonthlyIncome": "monthly_income", "Education": "education", "EducationField": "education_field",
    "MaritalStatus": "marital_status", "BusinessTravel": "business_travel",
    "DistanceFromHome": "distance_from_home", "Attrition": "attrition", "OverTime": "over_time",
    "StockOptionLevel": "stock_option_level", "TotalWorkingYears": "total_working_years",
    "NumCompaniesWorked": "num_companies_worked", "PercentSalaryHike": "percent_salary_hike",
    "TrainingTimesLastYear": "training_times_last_year", "YearsAtCompany": "years_at_company",
    "YearsInCurrentRole": "years_in_current_role", "YearsSinceLastPromotion": "years_since_last_promo",
    "YearsWithCurrManager": "years_with_curr_manager",
}
HISTORY_FEED = {
    "EmployeeID": "employee_id", "Department": "department_name", "JobRole": "job_role",
    "JobLevel": "job_level", "MonthlyIncome": "monthly_income", "PerformanceRating": "performance_rating",
    "EnvironmentSatisfaction": "environment_satisfaction", "JobSatisfaction": "job_satisfaction",
    "StartDate": "start_date", "EndDate": "end_date", "IsCurrent": "is_current",
}

# Column defaults of the operational tables.
DEFAULTS = {
    "departments": {"location": "HQ"},
    "employees": {
        "attrition": "No", "over_time": "No", "stock_option_level": 0, "total_working_years": 0,
        "num_companies_worked": 0, "percent_salary_hike": 0, "training_times_last_year": 0,
        "years_at_company": 0, "years_in_current_role": 0, "years_since_last_promo": 0,
        "years_with_curr_manager": 0, "is_active": True,
    },
    "projects": {"status": "Planning"},
    "project_assignments": {"role_in_project": "Contributor", "hours_allocated": 0},
}


def struct_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` with exactly the declared columns and types; columns it lacks become NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in struct_of(table)
        ]
    )
