"""The same loads fed by Structured Streaming.

Each stream runs with ``availableNow``: it takes what is there and ends. What it leaves does not
depend on how files fall into micro-batches or in which order they come: no row is ever too late.
Every micro-batch overwrites folders of its own number, so one repeated after a failure leaves one copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tenurelake.functions import scalars as S
from tenurelake.operators import facts, quality, scale, scd2
from tenurelake.streaming import merged
from tenurelake.streaming import merged

ID_BLOCK_BITS = 20  # ids seen are laid out in folders of 2^20 ids, so a batch reads those it needs
LOG_BUCKETS = 64  # and the salary log in this many folders of employees


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files: str = "*.parquet",
    max_files: int | None = None, max_bytes: str | None = None,
) -> DataFrame:
    """Files of ``folder`` as a stream; the two limits bound one micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(folder)


def _run(df: DataFrame, out: str, load: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    query = (
        df.writeStream.foreachBatch(load).outputMode(mode).trigger(availableNow=True)
        .option("checkpointLocation", f"{out}/_checkpoint").start()
    )
    query.awaitTermination()


def _earlier(spark: SparkSession, folder: str, schema: str, number: int) -> DataFrame:
    """Rows that batches before ``number`` left under ``folder``; a repeated batch does not see its own."""
    if not number:
        return spark.createDataFrame([], f"{schema}, batch bigint")
    return merged.read(spark, folder, f"{schema}, batch bigint").filter(F.col("batch") < number)


def no_id(reviews: DataFrame) -> DataFrame:
    """Reviews without an id, in quarantine row by row: nothing tells one from a copy of another."""
    nameless = reviews.filter(F.col("review_id").isNull())
    return nameless.withColumn("errors", F.array(F.lit("Review id is missing.")))


def place_reviews(
    fresh: DataFrame, nameless: DataFrame, emp: DataFrame, dept: DataFrame, dim_emp: DataFrame, dim_dept: DataFrame,
    out: str, number: int,
) -> DataFrame:
    """Writes a batch's new reviews, each id once, to the fact, the quarantine or the pending rows;
    returns the ids that reached one of the first two.

    Pending are valid reviews of employees who are not known yet, or have no current version. They
    are tried again with every batch, whose pending folder holds all that are left after it; another
    row with the id of a pending one is a repetition.
    """
    spark, here = fresh.sparkSession, f"batch={number}"
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fresh.schema)
    waiting = _earlier(spark, f"{out}/pending", types, number).filter(F.col("batch") == number - 1).drop("batch")
    fresh = fresh.join(scale.shuffled(waiting.select("review_id")), "review_id", "left_anti").select(*fresh.columns)
    valid, broken = quality.split_valid(fresh, quality.review_rules())
    bound = facts.bind_employees(emp, dept, dim_emp, dim_dept).select("employee_id").distinct()
    known = scale.shuffled(bound.withColumn("_known", F.lit(True)))
    pool = waiting.unionByName(valid).join(known, "employee_id", "left").persist()
    facts.load_fact_reviews(
        pool.filter("_known").drop("_known"), emp, dept, dim_emp, dim_dept, number=False
    ).write.mode("overwrite").parquet(f"{out}/fact/{here}")
    pool.filter("_known is null").select(*fresh.columns).write.mode("overwrite").parquet(f"{out}/pending/{here}")
    broken.unionByName(no_id(nameless)).write.mode("overwrite").parquet(f"{out}/quarantine/{here}")
    pool.unpersist()
    spark.range(1).write.mode("overwrite").parquet(f"{out}/batches/{here}")  # the last one may have left nothing pending
    ids = [spark.read.parquet(f"{out}/{to}/{here}").select("review_id") for to in ("fact", "quarantine")]
    return ids[0].unionByName(ids[1]).filter(F.col("review_id").isNotNull()).distinct()


def pending_reviews(spark: SparkSession, out: str) -> DataFrame:
    """The reviews that wait for their employee after the last batch."""
    last = spark.read.parquet(f"{out}/batches").agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{out}/pending/batch={last}")


def stream_reviews(
    reviews: DataFrame, emp: DataFrame, dept: DataFrame, dim_emp: DataFrame, dim_dept: DataFrame, out: str,
) -> None:
    """Reviews → validated facts under ``out``/fact, broken rows under ``out``/quarantine, reviews of
    employees not known yet under ``out``/pending.

    A review counts once: of equal ids in one batch the least row, and none whose id came before. All
    others are in one of the three, rows without an id in quarantine one by one. Ids that reached fact
    or quarantine are kept in folders by their upper bits, of which a batch reads only its own.
    """
    spark = reviews.sparkSession
    id_type = reviews.schema["review_id"].dataType.simpleString()
    schema = f"review_id {id_type}, block bigint"

    def load(batch: DataFrame, number: int) -> None:
        here = f"batch={number}"
        block = F.shiftright(F.col("review_id").cast("bigint"), ID_BLOCK_BITS)
        named = batch.filter(F.col("review_id").isNotNull())
        firsts = scale.first_per_key(named, ["review_id"], [c for c in batch.columns if c != "review_id"])
        known = _earlier(spark, f"{out}/ids", schema, number).select("review_id", "block")
        fresh = firsts.withColumn("block", block).join(known, ["block", "review_id"], "left_anti").persist()
        settled = place_reviews(
            fresh.select(*batch.columns), batch.filter(F.col("review_id").isNull()), emp, dept, dim_emp, dim_dept, out, number
        )
        settled.withColumn("block", block).write.mode("overwrite").partitionBy("block").parquet(f"{out}/ids/{here}")
        fresh.unpersist()

    _run(reviews, out, load)


def stream_salary_versions(log: DataFrame, out: str, hot_rows: int = scale.HOT_ROWS) -> None:
    """Salary changes → the changes that open a version, as the batch operator finds them in the
    whole log (see ``salary_versions``).

    The log is kept. A batch folds all events of the employees it touches anew, in time order, so a
    late change moves the versions after it; oversized employees are split as in the batch operator.
    """
    spark = log.sparkSession
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in log.schema)

    def load(batch: DataFrame, number: int) -> None:
        here = f"batch={number}"
        bucket = F.pmod(F.hash("employee_id"), F.lit(LOG_BUCKETS))
        batch.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/log/{here}")
        held = merged.read(spark, f"{out}/log", f"{schema}, bucket int, batch bigint").filter(F.col("batch") <= number)
        touched = batch.select("employee_id").distinct().withColumn("bucket", bucket)
        again = held.join(touched, ["bucket", "employee_id"], "left_semi").select(*log.columns)
        opened = scd2.versions_from_log(again, "last_version", hot_rows)
        opened.write.mode("overwrite").parquet(f"{out}/versions/{here}")

    _run(log, out, load)


def salary_versions(spark: SparkSession, out: str) -> DataFrame:
    """The versions of every employee as the last batch that touched the employee left them."""
    return _last_versions(merged.read(spark, f"{out}/versions")).drop("batch")


def _last_versions(held: DataFrame) -> DataFrame:
    last = held.groupBy("employee_id").agg(F.max("batch").alias("batch"))
    return held.join(last, ["employee_id", "batch"], "left_semi")


def stream_rating_trend(
    reviews: DataFrame, emp: DataFrame, dept: DataFrame, out: str, width_days: int = 28
) -> None:
    """Sums and counts of ratings per department and tumbling window, added up by ``rating_trend``.

    Reviews of employees not known yet are summed up per employee, for ``rating_trend`` to place.
    """
    names = department_names(emp, dept)
    day = F.unix_date("review_date")
    start = F.date_from_unix_date((F.floor(day / width_days) * width_days).cast("int"))

    def load(batch: DataFrame, number: int) -> None:
        rows = batch.select("employee_id", "performance_rating", start.alias("window_start")).join(names, "employee_id", "left")
        unknown = F.when(F.col("department_name").isNull(), F.col("employee_id"))
        rows.groupBy("window_start", "department_name", unknown.alias("employee_id")).agg(
            F.sum("performance_rating").alias("s"), F.count("performance_rating").alias("n")
        ).write.mode("overwrite").parquet(f"{out}/sums/batch={number}")

    _run(reviews, out, load)


def department_names(emp: DataFrame, dept: DataFrame) -> DataFrame:
    return emp.select("employee_id", "department_id").join(
        dept.select("department_id", "department_name"), "department_id"
    ).drop("department_id")


def rating_trend(spark: SparkSession, out: str, emp: DataFrame | None = None, dept: DataFrame | None = None) -> DataFrame:
    """Average rating per department and window, open windows included; late rows are in their window.

    Reviews whose employee was unknown when they came have a NULL department, unless ``emp`` and
    ``dept`` know the employee by now.
    """
    sums = merged.read(spark, f"{out}/sums")
    if emp is not None:
        now = department_names(emp, dept).withColumnRenamed("department_name", "_now")
        placed = sums.filter(F.col("employee_id").isNotNull()).join(now, "employee_id", "left")
        placed = placed.withColumn("department_name", F.col("_now")).select(*sums.columns)
        sums = sums.filter(F.col("employee_id").isNull()).unionByName(placed)
    total = sums.groupBy("window_start", "department_name").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return total.select(
        "window_start", "department_name", S.exact_avg(F.col("s"), F.col("n")).alias("avg_rating"), F.col("n").alias("reviews")
    )


# -- merging what many batches left -----------------------------------------------------------
# Between runs of the stream; results stay the same, folders and files become few again.


def merge_reviews(spark: SparkSession, out: str) -> None:
    """Merges the ids that ``stream_reviews`` has seen; facts and quarantine are results and stay."""
    merged.merge(spark, out, "ids", lambda ids: ids, by="block", order=["review_id"])
    merged.forget(spark, out, ["pending", "batches"])  # each holds all that the ones before held


def merge_salaries(spark: SparkSession, out: str) -> None:
    """Merges the salary log, and drops the versions that a later batch worked out anew."""
    merged.merge(spark, out, "log", lambda log: log, by="bucket", order=["employee_id", "change_ts"])
    merged.merge(spark, out, "versions", _last_versions, order=["employee_id"])


def merge_trend(spark: SparkSession, out: str) -> None:
    """Adds up the partial sums of ``stream_rating_trend``."""
    keys = ["window_start", "department_name", "employee_id"]
    merged.merge(spark, out, "sums", lambda sums: sums.groupBy(*keys).agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("batch").alias("batch")), order=keys)
