"""The same streams with state that Spark keeps and bounds, for feeds that come nearly in time order.

``feeds`` never finds a row too late and pays for it by keeping what late rows may need. Here the state
store holds one salary version an employee, the review ids of a bounded time and the open windows. What
comes too late for that is not lost: it is written beside the result, to be counted or loaded by the
operators that read everything.

On a cluster set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider, so that
state of any size stays out of the executors' heap. Batches are bounded by the limits of ``read_stream``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tenurelake.functions import scalars as S
from tenurelake.operators import folds
from tenurelake.streaming import feeds

VERSION, LATE = "version", "late"


# -- salary versions ----------------------------------------------------------------------------


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Folds an employee's new changes onto the version in the state.

    The state is (salary of the last version, time and id of the last change). Changes before the
    latter come too late; they are handed on as such and leave the state alone.
    """
    events = pd.concat(list(batches)).sort_values(["at", "event_id"], kind="stable")
    salary, at, event_id = state.get if state.exists else (folds.NO_VERSION, -(2**63), -(2**63))
    late = (events["at"] < at) | ((events["at"] == at) & (events["event_id"] < event_id))
    behind, ahead = events[late], events[~late]
    if len(ahead):
        cents = ahead["cents"].to_numpy(dtype=np.int64)
        opened = ahead.iloc[folds.emitted(cents, salary)]
        last = ahead.iloc[-1]
        state.update((int(opened["cents"].iloc[-1]) if len(opened) else salary, int(last["at"]), int(last["event_id"])))
        yield opened.assign(kind=VERSION)
    if len(behind):
        yield behind.assign(kind=LATE)


def stream_salary_state(log: DataFrame, out: str) -> None:
    """Salary changes → under ``out``/changes the changes that open a version, and those that came too
    late, by kind.

    The state holds one version an employee. Where an employee's changes come in time order, however
    they are cut into batches, the versions are those of the batch operator over the whole log. A
    change without a salary opens nothing and is left out, as there is nothing to compare.
    """
    employee = log.schema["employee_id"].dataType.simpleString()
    event = log.schema["event_id"].dataType.simpleString()
    rows = log.filter(F.col("new_salary").isNotNull()).select(
        "employee_id", F.unix_micros(F.col("change_ts").cast("timestamp")).alias("at"), "event_id",
        S.cents(F.col("new_salary")).cast("bigint").alias("cents"),
    )
    folded = rows.groupBy("employee_id").applyInPandasWithState(
        _fold, f"employee_id {employee}, at bigint, event_id {event}, cents bigint, kind string",
        "salary bigint, at bigint, event_id bigint", "append", GroupStateTimeout.NoTimeout,
    )
    told = folded.select(
        F.col("employee_id").cast("int"), F.timestamp_micros("at").alias("change_ts"), F.col("event_id").cast("bigint"),
        (F.col("cents") / 100).cast("decimal(10,2)").alias("monthly_income"), "kind",
    )

    def load(batch: DataFrame, number: int) -> None:
        # one action a batch: a second one would run the fold, and update the state, again
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{out}/changes/batch={number}")

    feeds._run(told, out, load)


def salary_changes(spark: SparkSession, out: str, kind: str) -> DataFrame:
    """The changes of one kind, ``VERSION`` or ``LATE``, that the stream has told apart so far."""
    schema = "employee_id int, change_ts timestamp, event_id bigint, monthly_income decimal(10,2), batch bigint, kind string"
    return spark.read.schema(schema).parquet(f"{out}/changes").filter(F.col("kind") == kind).drop("batch", "kind")


# -- reviews ------------------------------------------------------------------------------------


def _watermark(spark: SparkSession, out: str, number: int, delay_days: int) -> Column:
    """The latest time that is too late for batch ``number``: the newest one before it, less the delay."""
    seen = feeds._earlier(spark, f"{out}/seen", "at timestamp", number)
    newest = seen.agg(F.max("at")).first()[0]
    return F.lit(newest).cast("timestamp") - F.expr(f"interval {delay_days} days")


def stream_reviews_window(
    reviews: DataFrame, emp: DataFrame, dept: DataFrame, dim_emp: DataFrame, dim_dept: DataFrame, out: str,
    delay_days: int = 30,
) -> None:
    """Reviews → facts, quarantine and pending as ``feeds.stream_reviews`` writes them, with bounded state.

    An id is remembered until the watermark, the newest review date less ``delay_days``, has passed its
    date by as many days again. Rows that are older than the watermark, which Spark enforces from the
    batch after the one that moved it, and repeated ones are held back under ``out``/held with the reason. Facts, quarantine, pending and held rows together
    are the rows that came in.
    """
    spark = reviews.sparkSession
    timed = reviews.withColumn("_at", F.col("review_date").cast("timestamp")).withWatermark("_at", f"{delay_days} days")
    # Rows of one batch twice: as they came, and as the state lets them through. A review without a date
    # or an id cannot be remembered; the first is new whenever it comes, the second goes to quarantine.
    known = F.col("review_id").isNotNull() & F.col("_at").isNotNull()
    once = timed.filter(known).dropDuplicatesWithinWatermark(["review_id"])
    both = once.withColumn("_new", F.lit(True)).unionByName(timed.withColumn("_new", F.lit(False)))

    def load(batch: DataFrame, number: int) -> None:
        here, columns = f"batch={number}", reviews.columns
        batch = batch.persist()  # the state is asked once
        came, new = batch.filter(~F.col("_new")).drop("_new"), batch.filter("_new").drop("_new")
        nameless, undated = came.filter(F.col("review_id").isNull()), came.filter("review_id is not null and _at is null")
        feeds.place_reviews(
            new.unionByName(undated).select(*columns), nameless.select(*columns), emp, dept, dim_emp, dim_dept, out, number
        )
        late = F.coalesce(F.col("_at") <= _watermark(spark, out, number, delay_days), F.lit(False))
        held = came.filter(known).exceptAll(new)
        held.select(*columns, F.when(late, "late").otherwise("repeated").alias("reason")).write.mode("overwrite").parquet(f"{out}/held/{here}")
        came.agg(F.max("_at").alias("at")).write.mode("overwrite").parquet(f"{out}/seen/{here}")
        batch.unpersist()

    feeds._run(both, out, load)


# -- rating trend -------------------------------------------------------------------------------


def stream_trend_window(
    reviews: DataFrame, emp: DataFrame, dept: DataFrame, out: str, width_days: int = 28, delay_days: int = 30
) -> None:
    """Ratings per department and event-time window, kept in the state store until the watermark passes.

    Every batch writes the windows it changed under ``out``/windows. A review older than the watermark
    whose window is closed is not counted. Employees that are not known have a NULL department.
    """
    timed = reviews.withColumn("_at", F.col("review_date").cast("timestamp")).withWatermark("_at", f"{delay_days} days")
    named = timed.join(feeds.department_names(emp, dept), "employee_id", "left")
    windows = named.groupBy(F.window("_at", f"{width_days} days").alias("w"), "department_name").agg(
        F.sum("performance_rating").alias("s"), F.count("performance_rating").alias("n"), F.max("_at").alias("newest")
    )
    changed = windows.select(
        F.to_date("w.start").alias("window_start"), F.to_date("w.end").alias("window_end"), "department_name", "s", "n", "newest"
    )

    def load(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/windows/batch={number}")

    feeds._run(changed, out, load, "update")


def windowed_trend(spark: SparkSession, out: str, delay_days: int = 30) -> DataFrame:
    """Average rating per department and window as last changed, and whether the window is still open."""
    told = spark.read.parquet(f"{out}/windows")
    last = told.groupBy("window_start", "window_end", "department_name").agg(F.max_by(F.struct("s", "n"), "batch").alias("l"))
    newest = told.agg(F.max("newest")).first()[0]
    passed = F.date_sub(F.lit(newest).cast("date"), delay_days)
    return last.select(
        "window_start", "department_name", S.exact_avg(F.col("l.s"), F.col("l.n")).alias("avg_rating"),
        F.col("l.n").alias("reviews"), (F.col("window_end") > passed).alias("is_open"),
    )
