"""The versioned (Type 2) employee dimension: half-open [start_date, end_date), one current row."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import partial

from pyspark.sql import DataFrame, functions as F

from tenurelake.functions import scalars as S
from tenurelake.operators import dims, scale
from tenurelake.operators.folds import compose_sorted, effects_sorted, fold_sorted, replay_sorted, states_sorted
from tenurelake.session import checkpointed

THRESHOLD = Decimal("0.05")
VERSION_COLUMNS = ["surrogate_key", "start_date", "end_date", "is_current"]
# Set to zero by the snapshot merge (reviews fill them elsewhere), left NULL by a transfer.
RATING_COLUMNS = ["performance_rating", "environment_satisfaction", "job_satisfaction"]


def snapshot_of(emp: DataFrame, dept: DataFrame) -> DataFrame:
    """The operational employees with their department's name, as the merge compares them."""
    return emp.join(dept.select("department_id", "department_name"), "department_id").drop("department_id")


def scd2_classify(snapshot: DataFrame, dim: DataFrame, threshold: Decimal = THRESHOLD) -> DataFrame:
    """``snapshot`` plus ``status``: NEW, CHANGED or UNCHANGED.

    Changed means another department, or an income off by strictly more than ``threshold`` of the
    dimension's current one. With several current versions one changed version is enough, which
    the smallest and largest of each attribute decide; so current rows are reduced to one per employee.
    """
    paid = F.when(F.col("monthly_income") > 0, F.col("monthly_income"))
    held = dim.filter(F.col("is_current") == 1).groupBy("employee_id").agg(
        F.min("department_name").alias("_d0"), F.max("department_name").alias("_d1"),
        F.min(paid).alias("_i0"), F.max(paid).alias("_i1"), F.lit(1).alias("_known"),
    )
    name, income = F.col("department_name"), F.col("monthly_income")
    moved = F.coalesce((F.col("_d0") != name) | (F.col("_d1") != name), F.lit(False))
    raised = S.changed_beyond(F.col("_i0"), income, threshold) | S.changed_beyond(
        F.col("_i1"), income, threshold
    )
    status = (
        F.when(F.col("_known").isNull(), "NEW").when(moved | raised, "CHANGED").otherwise("UNCHANGED")
    )
    return snapshot.join(held, "employee_id", "left").select(*snapshot.columns, status.alias("status"))


def _close(dim: DataFrame, ids: DataFrame, as_of: dt.date) -> DataFrame:
    """``dim`` with the current versions of ``ids`` ended at ``as_of``. Closed versions skip the join."""
    kept, ended = _split_current(dim, ids, as_of)
    past = dim.filter(~F.coalesce(F.col("is_current") == 1, F.lit(False)))
    return kept.unionByName(ended).unionByName(past)


def _split_current(dim: DataFrame, ids: DataFrame, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    """(current versions of all others, current versions of ``ids`` ended at ``as_of``)."""
    live, hit = dim.filter(F.col("is_current") == 1), ids.select("employee_id").distinct()
    ended = live.join(hit, "employee_id", "left_semi").withColumns(
        {"end_date": F.lit(as_of), "is_current": F.lit(0)}
    )
    kept = live.join(hit, "employee_id", "left_anti")
    return kept.select(*dim.columns), ended.select(*[F.col(f.name).cast(f.dataType) for f in dim.schema])


def _open(
    rows: DataFrame, dim: DataFrame, as_of: dt.date, blank: list[str], zero: list[str]
) -> DataFrame:
    """``rows`` as new current versions in the dimension's layout, keyed after its largest key."""
    layout = []
    for f in dim.schema:
        if f.name in VERSION_COLUMNS:
            continue
        if f.name in zero:
            value = F.lit(0)
        elif f.name in blank or f.name not in rows.columns:
            value = F.lit(None)
        else:
            value = F.col(f.name)
        layout.append(value.cast(f.dataType).alias(f.name))
    fresh = rows.select(
        *layout, F.lit(as_of).alias("start_date"), F.lit(None).cast("date").alias("end_date"),
        F.lit(1).alias("is_current"),
    )
    keyed = dims.assign_surrogate(
        fresh, "employee_id", "surrogate_key", dims.max_key(dim, "surrogate_key")
    )
    return keyed.select(*[F.col(f.name).cast(f.dataType) for f in dim.schema])


def _due(snapshot: DataFrame, dim: DataFrame, threshold: Decimal) -> DataFrame:
    """The snapshot's new and changed employees. Written once, so that closing and opening versions
    act on one decision and neither repeats the comparison."""
    judged = scd2_classify(snapshot, dim, threshold)
    return checkpointed(judged.filter(F.col("status") != "UNCHANGED"))


def scd2_merge(
    snapshot: DataFrame, dim: DataFrame, as_of: dt.date, threshold: Decimal = THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """(current versions after merging a full snapshot, versions it closed).

    New employees get a first version, changed ones have theirs closed at ``as_of`` and a new one
    opened; employees missing from the snapshot are left alone. Older closed versions take no part,
    so a nightly merge reads and writes current rows only.
    """
    due = _due(snapshot, dim, threshold)
    kept, ended = _split_current(dim, due.filter(F.col("status") == "CHANGED"), as_of)
    return kept.unionByName(_open(due, dim, as_of, [], RATING_COLUMNS)), ended


def scd2_apply_snapshot(
    snapshot: DataFrame, dim: DataFrame, as_of: dt.date, threshold: Decimal = THRESHOLD
) -> DataFrame:
    """The whole dimension after ``scd2_merge``. Running it again changes nothing."""
    due = _due(snapshot, dim, threshold)
    closed = _close(dim, due.filter(F.col("status") == "CHANGED"), as_of)
    return closed.unionByName(_open(due, dim, as_of, [], RATING_COLUMNS))


def first_versions(rows: DataFrame, dim: DataFrame, as_of: dt.date) -> DataFrame:
    """First versions of employees just hired; hike and ratings are not known yet."""
    return _open(rows, dim, as_of, ["percent_salary_hike", *RATING_COLUMNS], [])


def scd2_from_versions(
    versions: DataFrame, key: str, order: list[str], start: str, hot_rows: int = scale.HOT_ROWS
) -> DataFrame:
    """Chains a time-ordered list of versions: each ends where the next starts, the last is current."""
    chained = scale.over_sequence(versions, [key], order, hot_rows, lead={"_next": F.col(start)})
    return chained.withColumns({
        "end_date": F.col("_next"),
        "is_current": F.when(F.col("_next").isNull(), 1).otherwise(0),
    }).drop("_next")


def conform_history(feed: DataFrame) -> DataFrame:
    """A history feed (text columns, feed names) as dimension rows without keys."""
    from tenurelake import schemas

    named = feed.select(*[F.col(c).alias(n) for c, n in schemas.HISTORY_FEED.items()])
    types = {f.name: f.dataType for f in schemas.struct_of("dim_employee")}
    return named.select(*[F.col(c).try_cast(types[c]).alias(c) for c in named.columns])


# -- salary changes ---------------------------------------------------------------------------


def salary_history(
    log: DataFrame, emp: DataFrame, hot_rows: int = scale.HOT_ROWS, keep: list[str] | None = None
) -> DataFrame:
    """Every salary change with the salary before it, and whether it alone opens a version.

    The salary before an employee's first change is the one on record in ``emp``; changes of unknown
    employees are rejected (``unknown_employees``). A previous salary of zero has no relative change.
    """
    known = log.join(
        emp.select("employee_id", F.col("monthly_income").alias("_recorded")), "employee_id"
    )
    order = ["change_ts", "event_id"]
    told = scale.over_sequence(known, ["employee_id"], order, hot_rows, lag={"_prev": F.col("new_salary")})
    old = F.coalesce("_prev", "_recorded")
    return told.select(
        "event_id", "employee_id", old.alias("old_salary"), "new_salary",
        F.to_date("change_ts").alias("change_date"),
        *[c for c in ["change_reason"] if c in log.columns], *(keep or []),
        S.changed_beyond(old, F.col("new_salary")).alias("opens_version"),
    )


def unknown_employees(changes: DataFrame, emp: DataFrame) -> DataFrame:
    return changes.join(emp.select("employee_id"), "employee_id", "left_anti")


def latest_salaries(emp: DataFrame, log: DataFrame) -> DataFrame:
    """``emp`` with each employee's last logged salary, whether or not it opened a version."""
    last = log.groupBy("employee_id").agg(
        F.max(F.struct("change_ts", "event_id", "new_salary")).alias("_last")
    )
    return emp.join(last, "employee_id", "left").withColumn(
        "monthly_income", F.coalesce(F.col("_last.new_salary"), F.col("monthly_income"))
    ).select(*emp.columns)


def _fold_hot(part: DataFrame, run: int = 64) -> DataFrame:
    """The same fold for oversized employees, whose events lie in numbered segments.

    1. Each segment is summed up as its effect on an unknown version, and each ``run`` of segments as
    one effect. 2. The effects of an employee's runs are applied one after the other, then those of the
    segments of each run, giving the version each segment starts with. 3. Each segment is folded from
    that version. Only step 2 looks at all runs of an employee, a few numbers each. Tasks go through
    sorted rows, so a short segment costs its rows and no call of its own between Spark and Python.
    """
    at, runs, order = ["employee_id", "_seg"], ["employee_id", "_run"], ["change_ts", "event_id"]
    key = f"employee_id {part.schema['employee_id'].dataType.simpleString()}"
    effect = "lo array<bigint>, hi array<bigint>, result array<bigint>"

    def dealt(df: DataFrame, by: list[str], *then: str) -> DataFrame:
        return df.repartition(*by).sortWithinPartitions(*by, *then)

    slim = part.select(*at, *order, "_c")
    # no shuffle: the partitions of ``ordered_segments`` are sorted and hold whole segments
    summed = checkpointed(
        slim.mapInArrow(effects_sorted, f"{key}, _seg bigint, {effect}")
        .withColumn("_run", F.call_function("div", F.col("_seg"), F.lit(run)))
    )
    joined = dealt(summed, runs, "_seg").mapInArrow(compose_sorted, f"{key}, _run bigint, {effect}")
    starts = dealt(joined, ["employee_id"], "_run").mapInArrow(
        partial(states_sorted, by=["employee_id"], number="_run"), f"{key}, _run bigint, _state bigint"
    )
    states = dealt(scale.null_safe_join(summed, starts, runs), runs, "_seg").mapInArrow(
        partial(states_sorted, by=runs, number="_seg"), f"{key}, _seg bigint, _state bigint"
    )
    # events without an employee are one sequence here as in the fold of ordinary employees
    known = scale.null_safe_join(slim, states, at)
    return dealt(known, at, *order).mapInArrow(replay_sorted, known.drop("_state", "_seg").schema)


def versions_from_log(
    log: DataFrame, mode: str = "last_version", hot_rows: int = scale.HOT_ROWS
) -> DataFrame:
    """Events of a salary-change log that open a version; the first of each employee always does.

    ``previous`` compares with the salary just before, so many small steps never add up;
    ``last_version`` compares with the last version opened, so they do.
    """
    if mode not in ("previous", "last_version"):
        raise ValueError(f"unknown mode: {mode}")
    events = log.select(
        "employee_id", "change_ts", "event_id", S.cents(F.col("new_salary")).alias("_c")
    )
    order = ["change_ts", "event_id"]
    if mode == "previous":
        told = scale.over_sequence(events, ["employee_id"], order, hot_rows, lag={"_prev": F.col("_c")})
        moved = (F.col("_prev") > 0) & (F.abs(F.col("_c") - F.col("_prev")) * 20 > F.col("_prev"))
        kept = told.filter(F.col("_prev").isNull() | moved).drop("_prev")
    else:
        def cold(part: DataFrame) -> DataFrame:
            ordered = part.repartition("employee_id").sortWithinPartitions("employee_id", *order)
            return ordered.mapInPandas(fold_sorted, part.schema)

        kept = scale.split_by_heat(events, ["employee_id"], order, hot_rows, cold, _fold_hot)
    return kept.withColumn("monthly_income", (F.col("_c") / 100).cast("decimal(10,2)")).drop("_c")


def scd2_from_change_log(
    log: DataFrame, mode: str = "last_version", hot_rows: int = scale.HOT_ROWS
) -> DataFrame:
    """Salary versions with their validity, from a change log."""
    # written once: chaining counts its keys before it chains, and the fold must not run for both
    opened = checkpointed(versions_from_log(log, mode, hot_rows))
    return scd2_from_versions(
        opened.withColumn("start_date", F.to_date("change_ts")),
        "employee_id", ["change_ts", "event_id"], "start_date", hot_rows,
    )


def apply_salary_changes(
    emp: DataFrame, dim: DataFrame, dept: DataFrame, log: DataFrame, as_of: dt.date,
    hot_rows: int = scale.HOT_ROWS,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(employees, current versions, versions closed, salary history, rejected) after a day's changes.

    Every change is logged and the last one becomes the salary on record. An employee with a change
    of more than 5 % against the salary just before it has the current version closed at ``as_of``
    and a new one opened, with the last salary that opened one; hike and ratings stay NULL. Several such
    changes of one day would leave empty versions of that day; only the last is kept.
    """
    rejected = unknown_employees(log, emp)
    told = checkpointed(salary_history(log, emp, hot_rows, ["change_ts"]))
    last = checkpointed(told.groupBy("employee_id").agg(
        F.max(F.when(F.col("opens_version"), F.struct("change_ts", "event_id", "new_salary"))).alias("_v"),
        F.max(F.struct("change_ts", "event_id", "new_salary")).alias("_last"),
    ))
    after = emp.join(last, "employee_id", "left").withColumn(
        "monthly_income", F.coalesce(F.col("_last.new_salary"), F.col("monthly_income"))
    )
    if "updated_at" in emp.columns:
        touched = F.when(F.col("_last").isNotNull(), F.lit(as_of).cast("timestamp"))
        after = after.withColumn("updated_at", F.coalesce(touched, F.col("updated_at")))
    due = last.filter(F.col("_v").isNotNull()).select("employee_id", F.col("_v.new_salary").alias("_to"))
    kept, ended = _split_current(dim, due, as_of)
    paid = emp.join(due, "employee_id").withColumn("monthly_income", F.col("_to")).drop("_to", "department_name")
    named = paid.join(dept.select("department_id", "department_name"), "department_id", "left").withColumn(
        "department_name", F.coalesce("department_name", F.lit(""))
    )
    opened = _open(named, dim, as_of, ["percent_salary_hike", *RATING_COLUMNS], [])
    return after.select(*emp.columns), kept.unionByName(opened), ended, told.drop("change_ts"), rejected


# -- other changes ----------------------------------------------------------------------------


def check_transfers(
    transfers: DataFrame, emp: DataFrame, dept: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Transfers of known employees to known departments, and the rest with a reason."""
    judged = (
        transfers.join(emp.select("employee_id", F.lit(1).alias("_e")), "employee_id", "left")
        .join(dept.select("department_id", F.lit(1).alias("_d")), "department_id", "left")
    )
    reason = F.when(F.col("_e").isNull(), "unknown employee").when(
        F.col("_d").isNull(), "unknown department"
    )
    judged = judged.withColumn("reason", reason).select(*transfers.columns, "reason")
    return judged.filter(F.col("reason").isNull()).drop("reason"), judged.filter(
        F.col("reason").isNotNull()
    )


def apply_transfers(
    emp: DataFrame, dim: DataFrame, dept: DataFrame, transfers: DataFrame, as_of: dt.date
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(employees, current versions, versions closed, rejected transfers) after a batch of department
    changes.

    The last transfer of an employee counts. It always opens a version, also into the same
    department; hike and ratings of that version stay NULL. Versions closed earlier are not touched.
    """
    valid, rejected = check_transfers(transfers, emp, dept)
    # written once: employees, closed and opened versions follow one decision
    last = checkpointed(valid.groupBy("employee_id").agg(
        F.max(F.struct("change_ts", "event_id", "department_id")).alias("_last")
    ).select("employee_id", F.col("_last.department_id").alias("_to")))
    moved = emp.join(last, "employee_id")
    emp_after = emp.join(last, "employee_id", "left").withColumn(
        "department_id", F.coalesce(F.col("_to"), F.col("department_id"))
    )
    if "updated_at" in emp.columns:
        touched = F.when(F.col("_to").isNotNull(), F.lit(as_of).cast("timestamp"))
        emp_after = emp_after.withColumn("updated_at", F.coalesce(touched, F.col("updated_at")))
    emp_after = emp_after.select(*emp.columns)
    named = moved.withColumn("department_id", F.col("_to")).drop("_to", "department_name").join(
        dept.select("department_id", "department_name"), "department_id"
    )
    opened = _open(named, dim, as_of, ["percent_salary_hike", *RATING_COLUMNS], [])
    kept, ended = _split_current(dim, last, as_of)
    return emp_after, kept.unionByName(opened), ended, rejected


def backfill_nulls(dim: DataFrame, src: DataFrame) -> DataFrame:
    """Repairs history rows from the operational table, all versions alike.

    A NULL first name replaces both names; a NULL attrition replaces attrition, overtime and
    years at company, even where the latter two are set.
    """
    guards = {
        "first_name": ["first_name", "last_name"],
        "attrition": ["attrition", "over_time", "years_at_company"],
    }
    wanted = [c for columns in guards.values() for c in columns]
    source = src.select("employee_id", F.lit(1).alias("_src"), *[F.col(c).alias(f"_{c}") for c in wanted])
    joined = dim.join(source, "employee_id", "left")
    repaired = {
        c: F.when(F.col("_src").isNotNull() & F.col(guard).isNull(), F.col(f"_{c}")).otherwise(F.col(c))
        for guard, columns in guards.items() for c in columns
    }
    return joined.withColumns(repaired).select(*dim.columns)


def asof_version_join(
    events: DataFrame, dim: DataFrame, event_date: str, order: list[str],
    carry: list[str], hot_rows: int = scale.HOT_ROWS,
) -> DataFrame:
    """Each event with the ``carry`` columns of the version valid on its date (NULL if none was).

    Events and versions are merged into one time line per employee and the latest version is filled
    forward, so work grows with events plus versions, never with their product. Versions of an
    employee must not overlap (``scd2_integrity``; else see ``asof_all_versions``); empty ones are ignored.
    """
    valid = dim.filter(F.col("end_date").isNull() | (F.col("start_date") < F.col("end_date")))
    version = F.struct(F.col("end_date").alias("_until"), *carry)
    blanks = [F.lit(None).cast(events.schema[c].dataType).alias(c) for c in events.columns
              if c not in ("employee_id", event_date)]
    starts = valid.select(
        F.col("employee_id").cast(events.schema["employee_id"].dataType).alias("employee_id"),
        F.col("start_date").alias("_at"), F.lit(0).alias("_kind"), version.alias("_version"),
        F.col("start_date").alias(event_date), *blanks,
    )
    rows = events.withColumns({
        "_at": F.col(event_date), "_kind": F.lit(1),
        "_version": F.lit(None).cast(starts.schema["_version"].dataType),
    })
    line = starts.unionByName(rows)
    filled = scale.over_sequence(
        line, ["employee_id"], ["_at", "_kind", *order], hot_rows, fill={"_held": F.col("_version")}
    ).filter(F.col("_kind") == 1)
    live = F.col("_held._until").isNull() | (F.col("_at") < F.col("_held._until"))
    return filled.select(
        *events.columns, *[F.when(live, F.col(f"_held.{c}")).alias(c) for c in carry]
    )


def asof_all_versions(
    events: DataFrame, dim: DataFrame, event_date: str, carry: list[str], bin_days: int = 64
) -> DataFrame:
    """Each event once per version valid on its date, with that version's ``carry`` columns (one row of
    NULLs if there is none). Versions may overlap.

    Events and versions meet in bins of ``bin_days``: a version stands in every bin that it covers between
    the first and the last event, and is compared only with the events of that bin. Bins of a hot employee
    are keys of their own, and a bin too large for a task is split by adaptive execution on the events' side.
    """
    day = lambda c: F.unix_date(c)
    bin_of = lambda d: F.floor(d / bin_days).cast("int")
    span = events.agg(F.min(day(event_date)).alias("lo"), F.max(day(event_date)).alias("hi")).first()
    lo, hi = (0, -1) if span["lo"] is None else (span["lo"], span["hi"])
    # the last day of a version is the one before its end; an open one lasts as long as there are events
    first, last = F.greatest(day("start_date"), F.lit(lo)), F.least(F.coalesce(day("end_date") - 1, F.lit(hi)), F.lit(hi))
    covering = dim.filter(F.col("start_date").isNotNull()).withColumns({"_first": first, "_last": last}).filter("_first <= _last")
    key = F.col("employee_id").cast(events.schema["employee_id"].dataType)
    binned = covering.select(
        key.alias("_e"), F.col("start_date").alias("_from"), F.col("end_date").alias("_to"),
        *[F.col(c).alias(f"_c_{c}") for c in carry], F.explode(F.sequence(bin_of(F.col("_first")), bin_of(F.col("_last")))).alias("_b"),
    )
    placed = events.withColumn("_bin", bin_of(day(event_date)))
    at = F.col(event_date)
    valid = (at >= F.col("_from")) & (F.col("_to").isNull() | (at < F.col("_to")))
    met = placed.join(binned, (F.col("employee_id") == F.col("_e")) & (F.col("_bin") == F.col("_b")) & valid, "left")
    return met.select(*events.columns, *[F.col(f"_c_{c}").alias(c) for c in carry])
