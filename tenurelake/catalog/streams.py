"""Streaming queries and their oracles, which state the batch result on the same input."""

from __future__ import annotations

import re
import uuid
from functools import partial

from pyspark.sql import functions as F

from tenurelake.catalog.common import avg2, plain
from tenurelake.catalog.fixtures import VIEWS, view, with_views
from tenurelake.catalog.warehouse import FACT_STEPS, fact_sql
from tenurelake.operators import scd2
from tenurelake.session import shared_dir
from tenurelake.streaming import feeds, stateful


FILES, FILES_PER_BATCH = 12, 5


def stream_view(spark, sf_dir, name, table):
    """A fixture view over ``table`` read as a stream of several micro-batches: the table is rewritten
    as files whose rows, and so their times, are shuffled."""
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    folder = _out(spark, f"{table}-files")
    rows.repartition(FILES, F.xxhash64(*rows.columns)).write.parquet(folder)
    source = f"stream_{table}_{uuid.uuid4().hex}"
    feeds.read_stream(spark, folder, rows.schema, max_files=FILES_PER_BATCH).createOrReplaceTempView(source)
    return spark.sql(re.sub(rf"\b{table}\b", source, VIEWS[name]))


def deliveries(spark, sf_dir, name, parts, load):
    """Runs a stream once per part: the rows of a view that the part's condition selects are delivered to
    its folder, and ``load`` is given the stream over that folder, as a job that runs once a day would be."""
    rows = view(spark, sf_dir, name)
    folder = _out(spark, name)
    for number, condition in enumerate(parts):
        rows.filter(condition).write.parquet(f"{folder}/part={number}")
        stream = feeds.read_stream(spark, f"{folder}/*", rows.schema)
        load(stream.select(*rows.columns), number)


def _out(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _reviews(s, d, part):
    out, v = _out(s, "reviews"), partial(view, s, d)
    feeds.stream_reviews(
        stream_view(s, d, "hr_reviews", "orders"), v("hr_employees_raw"), v("hr_departments"),
        v("hr_dim_employee"), v("hr_dim_department"), out,
    )
    return s.read.parquet(f"{out}/{part}").drop("batch")


def _salaries(s, d):
    out = _out(s, "salaries")
    feeds.stream_salary_versions(stream_view(s, d, "hr_salary_drift", "events"), out)
    opened = feeds.salary_versions(s, out).withColumn("start_date", F.to_date("change_ts"))
    chained = scd2.scd2_from_versions(opened, "employee_id", ["change_ts", "event_id"], "start_date")
    return plain(chained.drop("change_ts"))


def _trend(s, d):
    out = _out(s, "trend")
    feeds.stream_rating_trend(
        stream_view(s, d, "hr_reviews", "orders"), view(s, d, "hr_employees_raw"), view(s, d, "hr_departments"), out
    )
    return feeds.rating_trend(s, out)


DAYS = ["2024-01-08", "2024-01-15", "2024-01-22"]  # cut the salary log into four deliveries
WEEKS = [f"change_ts >= '{a}' and change_ts < '{z}'" for a, z in zip(["1900-01-01", *DAYS], [*DAYS, "9999-01-01"])]


def _kept_salaries(s, d, order):
    """The folder of a stream given the deliveries of the salary log in ``order``."""
    out = _out(s, "salary-state")
    deliveries(s, d, "hr_salary_drift", [WEEKS[k] for k in order], lambda log, _: stateful.stream_salary_state(log, out))
    return out


def _salary_state(s, d):
    opened = stateful.salary_changes(s, _kept_salaries(s, d, [0, 1, 2, 3]), stateful.VERSION)
    chained = scd2.scd2_from_versions(
        opened.withColumn("start_date", F.to_date("change_ts")), "employee_id", ["change_ts", "event_id"], "start_date"
    )
    return plain(chained.drop("change_ts"))


def _salary_late(s, d):
    """The third delivery comes before the second, whose changes are then too late for many."""
    late = stateful.salary_changes(s, _kept_salaries(s, d, [0, 2, 1, 3]), stateful.LATE)
    return late.select("event_id", "employee_id")


def _fates(s, out, kinds):
    """Where every review went: its fate, id and employee."""
    rows = None
    for kind in kinds:
        held = feeds.pending_reviews(s, out) if kind == "pending" else s.read.parquet(f"{out}/{kind}")
        fate = F.col("reason") if kind == "held" else F.lit(kind)
        told = held.select(fate.alias("fate"), F.col("review_id").cast("int"), F.col("employee_id").cast("int"))
        rows = told if rows is None else rows.unionByName(told)
    return rows


def _pending(s, d):
    """Reviews of which some have no id, some come before their employee and some have none."""
    out, v = _out(s, "reviews"), partial(view, s, d)
    hired = ["employee_id % 10 not in (3, 7)", "employee_id % 10 <> 7"]

    def load(stream, number):
        lost = F.when(F.col("review_id") % 400 != 3, F.col("review_id"))
        feeds.stream_reviews(
            stream.withColumn("review_id", lost), v("hr_employees_raw").filter(hired[number]), v("hr_departments"),
            v("hr_dim_employee"), v("hr_dim_department"), out,
        )

    deliveries(s, d, "hr_reviews", ["review_id % 3 < 2", "review_id % 3 = 2"], load)
    return _fates(s, out, ["fact", "quarantine", "pending"])


EARLY, LAST, WAIT = "1998-01-01", "2000-01-01", 90


def _window_fates(s, d):
    """The oldest reviews, then the newest, then those between, which come too late, with repetitions
    of the newest."""
    out, v = _out(s, "reviews-window"), partial(view, s, d)

    def load(stream, number):
        stateful.stream_reviews_window(
            stream, v("hr_employees_raw"), v("hr_departments"), v("hr_dim_employee"), v("hr_dim_department"), out, WAIT
        )

    again = "(review_date > date '2001-06-01' and review_id % 5 = 1)"
    parts = [f"review_date < '{EARLY}'", f"review_date >= '{LAST}'", f"(review_date >= '{EARLY}' and review_date < '{LAST}') or {again}"]
    deliveries(s, d, "hr_reviews", parts, load)
    return _fates(s, out, ["fact", "quarantine", "pending", "held"])


def _trend_window(s, d):
    out = _out(s, "trend-window")
    parts = [f"review_date < '{EARLY}'", f"review_date >= '{EARLY}' and review_date < '{LAST}'", f"review_date >= '{LAST}'"]
    deliveries(s, d, "hr_reviews", parts, lambda stream, _: stateful.stream_trend_window(
        stream, view(s, d, "hr_employees_raw"), view(s, d, "hr_departments"), out, delay_days=WAIT))
    return stateful.windowed_trend(s, out, WAIT)


def _reviews_merged(s, d):
    """Three deliveries, each with the reviews of the ones before once more; ids are merged after each."""
    out, v = _out(s, "reviews-merged"), partial(view, s, d)

    def load(stream, number):
        feeds.stream_reviews(
            stream, v("hr_employees_raw"), v("hr_departments"), v("hr_dim_employee"), v("hr_dim_department"), out
        )
        feeds.merge_reviews(s, out)

    deliveries(s, d, "hr_reviews", [f"review_id % 3 <= {k}" for k in range(3)], load)
    return plain(s.read.parquet(f"{out}/fact").drop("batch", "project_key"))


def _salaries_merged(s, d):
    """The weeks of the log in another order, log and versions merged after each."""
    out = _out(s, "salaries-merged")

    def load(log, number):
        feeds.stream_salary_versions(log, out)
        feeds.merge_salaries(s, out)

    deliveries(s, d, "hr_salary_drift", [WEEKS[k] for k in [0, 2, 1, 3]], load)
    opened = feeds.salary_versions(s, out).withColumn("start_date", F.to_date("change_ts"))
    chained = scd2.scd2_from_versions(opened, "employee_id", ["change_ts", "event_id"], "start_date")
    return plain(chained.drop("change_ts"))


def _trend_merged(s, d):
    """Sums merged after two of three deliveries."""
    out, emp, dept = _out(s, "trend-merged"), view(s, d, "hr_employees_raw"), view(s, d, "hr_departments")

    def load(stream, number):
        feeds.stream_rating_trend(stream, emp, dept, out)
        if number < 2:
            feeds.merge_trend(s, out)

    deliveries(s, d, "hr_reviews", [f"review_id % 3 = {k}" for k in range(3)], load)
    return feeds.rating_trend(s, out)


QUERIES = {
    "stream_reviews_merged": _reviews_merged,
    "stream_salary_merged": _salaries_merged,
    "stream_trend_merged": _trend_merged,
    "stream_salary_state": _salary_state,
    "stream_salary_late": _salary_late,
    "stream_reviews_pending": _pending,
    "stream_reviews_window": _window_fates,
    "stream_trend_window": _trend_window,
    "stream_reviews": lambda s, d: plain(_reviews(s, d, "fact").drop("project_key")),
    "stream_reviews_quarantine": lambda s, d: _reviews(s, d, "quarantine").select("review_id", "review_year"),
    "stream_salary_scd2": _salaries,
    "stream_rating_trend": _trend,
}

_VALID = " and ".join(f"r.{c} between 1 and 4" for c in [
    "performance_rating", "job_satisfaction", "environment_satisfaction", "relationship_satisfaction",
    "work_life_balance", "job_involvement", "review_quarter"]) + " and r.review_year >= 2000"


def _oracles():
    from tenurelake.catalog.warehouse import ORACLES as batch

    week = "case " + " ".join(f"when change_ts < '{x}' then {k}" for k, x in enumerate(DAYS)) + f" else {len(DAYS)} end"
    fate = lambda late: f"case {late} when not ({_VALID}) then 'quarantine'"
    trend = {"t": """select date '1970-01-01' + cast(((r.review_date - date '1970-01-01') // 28) * 28 as int) as window_start,
 d.department_name, r.performance_rating from hr_reviews r join hr_employees_raw e on r.employee_id = e.employee_id
join hr_departments d on e.department_id = d.department_id"""}
    oracles = {
        "stream_salary_state": batch["scd2_change_log_last_version"],
        # the third delivery holds only later changes than the second, so any of them makes those late
        "stream_salary_late": with_views("""select event_id, employee_id from w
where week = 1 and employee_id in (select employee_id from w where week = 2)""", {
            "w": f"select event_id, employee_id, {week} as week from hr_salary_drift"}),
        "stream_reviews_pending": with_views(f"""select {fate("when r.review_id % 400 = 3 then 'quarantine'")}
 when employee_id % 10 = 7 then 'pending' else 'fact' end as fate,
 case when r.review_id % 400 <> 3 then review_id end as review_id, employee_id from hr_reviews r"""),
        "stream_reviews_window": with_views(f"""select {fate(f"when review_date >= '{EARLY}' and review_date < '{LAST}' then 'late'")}
 else 'fact' end as fate, review_id, employee_id from hr_reviews r
union all select 'repeated', review_id, employee_id from hr_reviews where review_date > date '2001-06-01' and review_id % 5 = 1"""),
        "stream_trend_window": with_views(f"""select window_start, department_name,
 {avg2('sum(performance_rating)', 'count(*)')} as avg_rating, count(*) as reviews,
 window_start + 28 > (select max(review_date) - {WAIT} from hr_reviews) as is_open from t group by window_start, department_name""", trend),
        "stream_reviews": with_views(fact_sql(f"where {_VALID}", None), FACT_STEPS),
        "stream_reviews_quarantine": with_views(
            f"select r.review_id, r.review_year from hr_reviews r where not ({_VALID})"),
        "stream_salary_scd2": batch["scd2_change_log_last_version"],
        "stream_rating_trend": with_views(f"""select window_start, department_name,
 {avg2('sum(performance_rating)', 'count(*)')} as avg_rating, count(*) as reviews from t group by window_start, department_name""", {
            "t": """select date '1970-01-01' + cast(((r.review_date - date '1970-01-01') // 28) * 28 as int) as window_start,
 d.department_name, r.performance_rating from hr_reviews r join hr_employees_raw e on r.employee_id = e.employee_id
join hr_departments d on e.department_id = d.department_id"""}),
    }
    # merging what batches left changes no result
    again = {"reviews": "reviews", "salary": "salary_scd2", "trend": "rating_trend"}
    return oracles | {f"stream_{k}_merged": oracles[f"stream_{same}"] for k, same in again.items()}


ORACLES = _oracles()
