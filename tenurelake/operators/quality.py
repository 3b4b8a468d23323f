"""Data-quality jobs: entity rules, constraint audits, duplicate and version checks.

Rules are Column expressions evaluated in one pass; a row's broken rules become an array of texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tenurelake import schemas
from tenurelake.functions import scalars as S
from tenurelake.operators import dims, scale
from tenurelake.session import checkpointed

Rules = list[tuple[str, Column]]


def _ok(condition: Column) -> Column:
    """A rule holds only where its condition is true; NULL breaks it."""
    return F.coalesce(condition, F.lit(False))


def _filled(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def _optional(name: str, condition: Column) -> Column:
    return F.col(name).isNull() | condition


# Fixed values below: the texts a broken rule reports.
def department_rules() -> Rules:
    return [
        ("Department name cannot be empty.", F.col("department_name").rlike(r"\S")),
        ("Department name too long (max 100 chars).",
         F.coalesce(F.length("department_name"), F.lit(0)) <= 100),
    ]


def employee_rules() -> Rules:
    return [
        ("First and last name are required.", _filled("first_name") & _filled("last_name")),
        ("Invalid email address.", F.col("email").contains("@") & F.col("email").contains(".")),
        ("Age must be between 18 and 100.", F.col("age").between(18, 100)),
        ("Job level must be 1–5.", F.col("job_level").between(1, 5)),
        ("Monthly income must be positive.", F.col("monthly_income") > 0),
        ("A valid department must be selected.", F.col("department_id") > 0),
        ("Gender must be Male, Female, or Other.", F.col("gender").isin(schemas.GENDERS)),
        ("Attrition must be Yes or No.", F.col("attrition").isin(schemas.YES_NO)),
        ("Invalid marital status.", F.col("marital_status").isin(schemas.MARITAL)),
        ("Invalid business travel value.", F.col("business_travel").isin(schemas.TRAVEL)),
    ]


def project_rules() -> Rules:
    return [
        ("Project name is required.", _filled("project_name")),
        ("Status must be one of: ('Planning', 'Active', 'On Hold', 'Completed', 'Cancelled')",
         F.col("status").isin(schemas.PROJECT_STATUS)),
        ("End date cannot be before start date.",
         _optional("end_date", F.col("end_date") >= F.col("start_date"))),
        ("Budget cannot be negative.", _optional("budget", F.col("budget") >= 0)),
    ]


def review_rules() -> Rules:
    scores = [(f"{c} must be between 1 and 4.", F.col(c).between(1, 4)) for c in S.SCORE_COLUMNS]
    return [
        *scores,
        ("Quarter must be 1–4.", F.col("review_quarter").between(1, 4)),
        ("Review year seems invalid.", F.col("review_year") >= 2000),
    ]


def assignment_rules() -> Rules:
    return [
        ("Hours allocated cannot be negative.", F.col("hours_allocated") >= 0),
        ("Release date cannot be before assignment date.",
         _optional("released_date", F.col("released_date") >= F.col("assigned_date"))),
    ]


def validate(df: DataFrame, rules: Rules) -> DataFrame:
    """``df`` plus ``errors``, the texts of the rules each row breaks (empty if none)."""
    texts = [F.when(~_ok(holds), F.lit(text)) for text, holds in rules]
    unbroken = F.array(F.lit(None).cast("string"))
    return df.withColumn("errors", F.array_except(F.array(*texts), unbroken))


def validate_departments(df: DataFrame) -> DataFrame:
    return validate(df, department_rules())


def validate_employees(df: DataFrame) -> DataFrame:
    return validate(df, employee_rules())


def validate_projects(df: DataFrame) -> DataFrame:
    return validate(df, project_rules())


def validate_reviews(df: DataFrame) -> DataFrame:
    return validate(df, review_rules())


def validate_assignments(df: DataFrame) -> DataFrame:
    return validate(df, assignment_rules())


def split_valid(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows in quarantine with their ``errors``)."""
    clean = reduce(lambda a, b: a & b, [_ok(holds) for _, holds in rules])
    return df.filter(clean), validate(df.filter(~clean), rules)


def append_valid(
    batch: DataFrame, target: DataFrame, rules: Rules, id_col: str, order: str
) -> tuple[DataFrame, DataFrame]:
    """(rows to append to ``target``, with ids after its largest one in the order of
    the whole number ``order``, their place in the feed; rows in quarantine)."""
    valid, broken = split_valid(batch, rules)
    kind, first = target.schema[id_col].dataType, dims.max_key(target, id_col)
    placed = checkpointed(valid.withColumn("_place", F.col(order)).drop(id_col))
    numbered = scale.dense_numbers(placed, "_place", "_n").withColumn(id_col, (F.col("_n") + first).cast(kind))
    return numbered.select(*valid.columns), broken


def quality_report(entities: dict[str, tuple[DataFrame, Rules]]) -> DataFrame:
    """Rows per entity and broken rule; one aggregate over each entity."""
    parts = []
    for entity, (df, rules) in entities.items():
        counts = df.agg(*[F.count_if(~_ok(holds)).alias(f"r{i}") for i, (_, holds) in enumerate(rules)])
        listed = F.explode(F.array(*[
            F.struct(F.lit(text).alias("rule"), F.col(f"r{i}").alias("rows"))
            for i, (text, _) in enumerate(rules)
        ])).alias("_r")
        parts.append(counts.select(F.lit(entity).alias("entity"), listed).select("entity", "_r.*"))
    return reduce(DataFrame.unionByName, parts).filter(F.col("rows") > 0).orderBy("entity", "rule")


# -- constraint audits: what the database would have refused ------------------------------------

CHECKS: dict[str, dict[str, tuple[int, int]]] = {
    "employees": {"age": (18, 100), "job_level": (1, 5), "education": (1, 5)},
    "performance_reviews": {"review_quarter": (1, 4)} | {c: (1, 4) for c in S.SCORE_COLUMNS},
}
REQUIRED: dict[str, list[str]] = {
    "departments": ["department_id", "department_name"],
    "employees": ["employee_id", "first_name", "last_name", "email", "hire_date", "department_id",
                  "job_role", "monthly_income"],
    "projects": ["project_id", "project_name", "start_date"],
    "project_assignments": ["employee_id", "project_id", "assigned_date"],
    "performance_reviews": ["review_id", "employee_id", "review_date", "review_year",
                            "performance_rating"],
    "salary_history": ["employee_id", "old_salary", "new_salary", "change_date"],
}
UNIQUE: dict[str, list[list[str]]] = {
    "departments": [["department_id"], ["department_name"]],
    "employees": [["employee_id"], ["email"]],
    "projects": [["project_id"]],
    "project_assignments": [["employee_id", "project_id"]],
    "performance_reviews": [["review_id"]],
    "dim_department": [["department_id"]],
}
# child table, column, parent table, parent column, what deleting the parent does
FOREIGN: list[tuple[str, str, str, str, str]] = [
    ("employees", "department_id", "departments", "department_id", "restrict"),
    ("projects", "department_id", "departments", "department_id", "nullify"),
    ("project_assignments", "employee_id", "employees", "employee_id", "cascade"),
    ("project_assignments", "project_id", "projects", "project_id", "cascade"),
    ("performance_reviews", "employee_id", "employees", "employee_id", "cascade"),
    ("performance_reviews", "reviewer_id", "employees", "employee_id", "nullify"),
    ("salary_history", "employee_id", "employees", "employee_id", "cascade"),
    ("dim_project", "dept_key", "dim_department", "dept_key", "nullify"),
    ("fact_performance_reviews", "surrogate_key", "dim_employee", "surrogate_key", "restrict"),
    ("fact_performance_reviews", "dept_key", "dim_department", "dept_key", "nullify"),
    ("fact_performance_reviews", "project_key", "dim_project", "project_key", "nullify"),
    ("fact_performance_reviews", "date_key", "dim_date", "date_key", "nullify"),
]


def _per_column(df: DataFrame, table: str, kind: str, counts: dict[str, Column]) -> DataFrame:
    """One scan that counts violations per column, as rows (table, rule, violations)."""
    one = df.agg(*[F.count_if(bad).alias(name) for name, bad in counts.items()])
    names = list(counts)
    rows = F.explode(F.array(*[
        F.struct(F.lit(f"{kind} {n}").alias("rule"), F.col(n).alias("violations")) for n in names
    ])).alias("_r")
    return one.select(F.lit(table).alias("table_name"), rows).select("table_name", "_r.*")


def check_audit(df: DataFrame, table: str) -> DataFrame:
    """Violations of the range checks; NULL passes a check."""
    return _per_column(df, table, "check", {
        c: ~F.col(c).between(lo, hi) for c, (lo, hi) in CHECKS[table].items() if c in df.columns
    })


def not_null_audit(df: DataFrame, table: str) -> DataFrame:
    return _per_column(df, table, "not null", {
        c: F.col(c).isNull() for c in REQUIRED[table] if c in df.columns
    })


def unique_audit(df: DataFrame, table: str) -> DataFrame:
    """Per unique key: how many key values occur more than once, and how many rows are in excess."""
    parts = []
    for key in UNIQUE[table]:
        # text keys are compared without case
        columns = [F.lower(c).alias(c) if dict(df.dtypes)[c] == "string" else F.col(c) for c in key]
        copies = df.select(*columns).dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(copies.filter(F.col("n") > 1).agg(
            F.lit(table).alias("table_name"), F.lit(", ".join(key)).alias("key_columns"),
            F.count(F.lit(1)).alias("repeated_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess_rows"),
        ))
    return reduce(DataFrame.unionByName, parts)


def fk_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphans per foreign key: child values are reduced to distinct ones before they meet the parent."""
    parts = []
    for child, column, parent, key, _ in FOREIGN:
        if child not in tables or parent not in tables or column not in tables[child].columns:
            continue
        values = tables[child].filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(
            F.count(F.lit(1)).alias("n")
        )
        known = tables[parent].select(F.col(key).alias("_v"))
        parts.append(values.join(known, "_v", "left_anti").agg(
            F.lit(child).alias("child"), F.lit(column).alias("column_name"), F.lit(parent).alias("parent"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"),
        ))
    return reduce(DataFrame.unionByName, parts)


def calendar_audit(df: DataFrame, day: str, dim_date: DataFrame) -> DataFrame:
    """Dates (with their row counts) that the calendar does not hold."""
    days = df.groupBy(S.date_key(F.col(day)).alias("date_key")).agg(F.count(F.lit(1)).alias("rows"))
    return days.join(dim_date.select("date_key"), "date_key", "left_anti")


def scd2_integrity(dim: DataFrame, hot_rows: int = scale.HOT_ROWS) -> DataFrame:
    """Employees that break the version contract, with the number of broken versions per kind.

    At most one current row; current exactly when open; no negative interval; no overlap and no gap
    between neighbouring versions.
    """
    lined = scale.over_sequence(
        dim.select("employee_id", "start_date", "end_date", "is_current", "surrogate_key"),
        ["employee_id"], ["start_date", "surrogate_key"], hot_rows, lead={"_next": F.col("start_date")},
    )
    ends = F.col("end_date")
    flags = {
        "flag_mismatches": (F.col("is_current") == 1) != ends.isNull(),
        "negative_intervals": ends < F.col("start_date"),
        "overlaps": F.col("_next").isNotNull() & (ends.isNull() | (ends > F.col("_next"))),
        "gaps": ends < F.col("_next"),
    }
    per_employee = lined.groupBy("employee_id").agg(
        F.greatest(F.sum("is_current") - 1, F.lit(0)).alias("extra_current"),
        *[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in flags.items()],
    )
    broken = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in ["extra_current", *flags]])
    return per_employee.filter(broken)


def volume_audit(counts: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """Row counts against the least number expected of each."""
    parts = [
        df.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("actual"))
        .withColumn("expected", F.lit(least).cast("bigint"))
        .withColumn("passed", F.col("actual") >= F.col("expected"))
        for name, (df, least) in counts.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def reject_duplicates(
    batch: DataFrame, target: DataFrame, key: str, order: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): the first row per ``key`` is accepted if the target lacks the key.

    ``order`` ends in the batch's primary key. Text keys are compared without case, as the
    database's unique key does.
    """
    text = dict(batch.dtypes)[key] == "string"
    match = F.lower(key) if text else F.col(key)
    marked = batch.withColumn("_key", match)
    taken = target.filter(F.col(key).isNotNull()).select(match.alias("_key"))
    # written once: what is rejected is told by what was accepted
    accepted = checkpointed(
        scale.first_per_key(marked, ["_key"], order).join(taken, "_key", "left_anti")
        .select(*batch.columns)
    )
    return accepted, batch.join(accepted.select(*order), order, "left_anti")
