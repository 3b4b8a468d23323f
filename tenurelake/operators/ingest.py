"""Feed conformance and the writes a workforce application makes, each as a set-based job."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tenurelake import schemas
from tenurelake.functions import scalars as S
from tenurelake.operators import dims, quality, scale, scd2
from tenurelake.session import checkpointed

# How a raw employee feed is conformed.
DEFAULT_DEPARTMENT = 1
DEFAULT_HIRE_DATE = dt.date(2020, 1, 1)
INCOME_RANGE = (1000, 19999)
LENGTHS = {"first_name": 100, "last_name": 100, "email": 150, "phone": 15, "job_role": 100}


def lookup_default(
    df: DataFrame, dim: DataFrame, on: str, value: str, default: int
) -> DataFrame:
    """``df`` with ``value`` looked up in ``dim`` by ``on``; ``default`` where nothing matches."""
    return df.join(dim.select(on, value), on, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def load_employee_feed(
    feed: DataFrame, emp: DataFrame, dept: DataFrame, key: list[str] | None = None, order: str = "employee_id"
) -> DataFrame:
    """The rows a feed adds to ``emp``: conformed, with the table's defaults, first per unique key."""
    rows = apply_defaults(conform_employee_feed(feed, dept), "employees")
    return insert_ignore(rows, emp, key or ["email"], [order])


def conform_employee_feed(feed: DataFrame, dept: DataFrame) -> DataFrame:
    """A text feed as typed employee rows.

    Department names become ids (unknown: the first department), unreadable hire dates a default,
    texts are cut to their column's length and income is clipped. Clipping hides impossible
    incomes, so validate the raw feed first.
    """
    named = feed.select(*[
        F.col(c).alias(n) for c, n in schemas.EMPLOYEE_FEED.items() if c in feed.columns
    ])
    ids = lookup_default(named, dept, "department_name", "department_id", DEFAULT_DEPARTMENT)
    types = {f.name: f.dataType for f in schemas.struct_of("employees")}
    out = []
    for c in [*[n for n in named.columns if n != "department_name"], "department_id"]:
        if c in LENGTHS:
            value = F.substring(c, 1, LENGTHS[c])
        elif c == "hire_date":
            value = S.parse_date(F.col(c), DEFAULT_HIRE_DATE)
        elif c == "monthly_income":
            value = S.clip(F.col(c).try_cast(types[c]), *INCOME_RANGE)
        elif c == "department_id":
            value = F.col(c)
        else:
            value = F.col(c).try_cast(types[c])
        out.append(value.cast(types[c]).alias(c))
    return ids.select(*out)


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """Adds the columns ``df`` lacks, filled with the table's defaults. An explicit NULL stays NULL."""
    types = {f.name: f.dataType for f in schemas.struct_of(table)}
    missing = {c: v for c, v in schemas.DEFAULTS[table].items() if c not in df.columns}
    return df.withColumns({c: F.lit(v).cast(types[c]) for c, v in missing.items()})


def insert_ignore(new: DataFrame, target: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Rows to append: the first per unique key, unless the target already holds the key.

    Text keys are compared without case, as the database's unique keys do. NULL keys never collide.
    """
    types = dict(new.dtypes)
    match = {f"_k{i}": F.lower(c) if types[c] == "string" else F.col(c) for i, c in enumerate(key)}
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    firsts = scale.first_per_key(new.filter(known).withColumns(match), list(match), order)
    held = target.select(*[m.alias(k) for k, m in match.items()])
    fresh = firsts.join(held, list(match), "left_anti").select(*new.columns)
    return fresh.unionByName(new.filter(~known))


def upsert(
    new: DataFrame, target: DataFrame, keys: list[str], update: list[str], order: list[str],
    insert: list[str] | None = None,
) -> DataFrame:
    """The target after inserting ``new`` in ``order``, where a repeated key only updates ``update``.

    A key's other columns keep the values of its first insert; ``update`` takes the last ones. Of a
    new key the columns ``insert`` and ``update`` are filled (all, if not given); the rest is NULL.
    """
    new = new if insert is None else new.select(*{c: 0 for c in [*keys, *insert, *update, *order] if c in new.columns})
    filled = [c for c in target.columns if c in new.columns and (insert is None or c in insert)]
    other = [c for c in target.columns if c not in keys and c not in update]
    place = [c for c in order if c not in keys]
    batch = new.groupBy(*keys).agg(
        F.min(F.struct(*place, *[c for c in other if c in filled and c not in place])).alias("_first"),
        F.max(F.struct(*place, *[c for c in update if c not in place])).alias("_last"),
    )
    held = target.withColumn("_held", F.lit(1))
    joined = held.join(batch, keys, "full_outer")
    types = {f.name: f.dataType for f in target.schema}
    out = [F.col(k) for k in keys]
    for c in other:
        first = F.col(f"_first.{c}") if c in filled else F.lit(None)
        out.append(F.when(F.col("_held").isNotNull(), F.col(c)).otherwise(first).cast(types[c]).alias(c))
    for c in update:
        last = F.when(F.col("_last").isNotNull(), F.col(f"_last.{c}")).otherwise(F.col(c))
        out.append(last.cast(types[c]).alias(c))
    return joined.select(*out).select(*target.columns)


def deactivate(emp: DataFrame, ids: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Soft delete. The dimension is not touched and keeps the old attrition until its next version."""
    gone = ids.select("employee_id").distinct().withColumn("_gone", F.lit(1))
    hit = F.col("_gone").isNotNull()
    changes = {
        "is_active": F.when(hit, F.lit(False)).otherwise(F.col("is_active")),
        "attrition": F.when(hit, F.lit("Yes")).otherwise(F.col("attrition")),
    }
    if as_of is not None and "updated_at" in emp.columns:
        changes["updated_at"] = F.when(hit, F.lit(as_of).cast("timestamp")).otherwise(F.col("updated_at"))
    return emp.join(gone, "employee_id", "left").withColumns(changes).select(*emp.columns)


def update_project_status(
    projects: DataFrame, changes: DataFrame, order: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(projects after the last valid change of each, changes with an invalid status)."""
    allowed = F.coalesce(F.col("status").isin(schemas.PROJECT_STATUS), F.lit(False))
    last = changes.filter(allowed).groupBy("project_id").agg(
        F.max(F.struct(*order, F.col("status").alias("_status"))).alias("_last")
    )
    after = projects.join(last, "project_id", "left").withColumn(
        "status", F.coalesce(F.col("_last._status"), F.col("status"))
    ).select(*projects.columns)
    return after, changes.filter(~allowed)


def onboard(
    feed: DataFrame, emp: DataFrame, dim: DataFrame, dept: DataFrame, as_of: dt.date, order: str
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Hires: (employees to append, their first versions, invalid rows, rows with a taken e-mail).

    Employee ids continue after the largest one, in feed order (``order``, a whole number).
    """
    valid, invalid = quality.split_valid(feed, quality.employee_rules())
    accepted, duplicates = quality.reject_duplicates(valid, emp, "email", [order])
    # written once: the employees and their versions must carry the same new ids
    hired = checkpointed(dims.assign_surrogate(
        accepted.withColumnRenamed(order, "_feed_order"), "_feed_order", "_new_id",
        dims.max_key(emp, "employee_id"),
    ).withColumn("employee_id", F.col("_new_id").cast("int")).drop("_new_id", "_feed_order"))
    named = hired.join(dept.select("department_id", "department_name"), "department_id", "left")
    named = named.withColumn("department_name", F.coalesce("department_name", F.lit("")))
    return hired, scd2.first_versions(named, dim, as_of), invalid, duplicates


# -- deletes with referential actions -----------------------------------------------------------


def restrict_check(deleted: DataFrame, key: str, children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per child table the rows that forbid the delete; all counts must be zero to go on."""
    parts = [
        child.groupBy(F.col(column).alias(key)).agg(F.count(F.lit(1)).alias("_n"))
        .join(deleted.select(key), key, "left_semi")
        .agg(F.lit(name).alias("child"), F.coalesce(F.sum("_n"), F.lit(0)).alias("blocking_rows"))
        for name, (child, column) in children.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def cascade_delete(child: DataFrame, column: str, deleted: DataFrame, key: str) -> DataFrame:
    """``child`` without the rows that point at a deleted parent."""
    gone = deleted.select(F.col(key).alias(column)).distinct()
    return child.join(gone, column, "left_anti").select(*child.columns)


def nullify_refs(child: DataFrame, column: str, deleted: DataFrame, key: str) -> DataFrame:
    """``child`` with its references to deleted parents set to NULL. Rows that refer to nothing skip
    the join, where their NULL keys would all meet in one task."""
    gone = deleted.select(F.col(key).alias(column)).distinct().withColumn("_gone", F.lit(1))
    kept = F.when(F.col("_gone").isNull(), F.col(column))
    referring = child.filter(F.col(column).isNotNull()).join(gone, column, "left")
    return referring.withColumn(column, kept).select(*child.columns).unionByName(
        child.filter(F.col(column).isNull())
    )


def blocking_rows(tables: dict[str, DataFrame], parent: str, deleted: DataFrame) -> DataFrame:
    """``restrict_check`` over the children whose foreign keys forbid deleting from ``parent``."""
    held = {c: (tables[c], column) for c, column, owner, _, action in quality.FOREIGN
            if owner == parent and action == "restrict" and c in tables}
    key = next(k for _, _, owner, k, _ in quality.FOREIGN if owner == parent)
    return restrict_check(deleted, key, held)


def apply_delete(
    tables: dict[str, DataFrame], parent: str, deleted: DataFrame
) -> dict[str, DataFrame]:
    """All given tables after deleting rows of ``parent``: each child loses the rows, or the
    references, that its foreign key says. Parents that a restricting child still refers to stay,
    with all that refers to them (``blocking_rows`` counts those children)."""
    after, refers = dict(tables), [
        f for f in quality.FOREIGN if f[2] == parent and f[0] in tables and f[1] in tables[f[0]].columns
    ]
    key = next(k for _, _, owner, k, _ in quality.FOREIGN if owner == parent)
    deleted = deleted.select(key).distinct()
    for child, column, _, _, action in refers:
        if action == "restrict":
            held = tables[child].select(F.col(column).alias(key)).distinct()
            deleted = deleted.join(held, key, "left_anti")
    for child, column, _, _, action in refers:
        if action == "cascade":
            after[child] = cascade_delete(after[child], column, deleted, key)
        elif action == "nullify":
            after[child] = nullify_refs(after[child], column, deleted, key)
    after[parent] = cascade_delete(tables[parent], key, deleted, key)
    return after
