"""Times the headline queries on one machine and prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores. The workforce tables are
written once before anything is timed. Each query is planned and fully computed (every output column)
``BENCH_RUNS`` times (three, if not given), of which the median counts; the session is warmed by one
untimed query first. With ``BENCH_COPIES`` = n the tables are
blown up n times under new keys first, with a third of all orders and events on one key.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from tenurelake.catalog import QUERIES, fixtures
from tenurelake.session import local_session

HEADLINE = [
    "yoy_performance", "top_performers_year", "top_performers_all", "attrition_risk",
    "department_kpis_total", "employee_history", "salary_distribution", "salary_box",
    "fact_reviews_load", "fact_reviews_incremental", "fact_reviews_asof", "scd2_snapshot_apply",
    "scd2_change_log_last_version", "scd2_from_versions", "transfers_apply", "assignments_upsert",
    "project_assignments", "quality_report", "fk_audit", "scd2_integrity",
]

# Key columns that each copy shifts; tables without any are copied as they are.
KEYS = {
    "customer": ["c_custkey"], "orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_partkey"],
    "part": ["p_partkey"], "events": ["event_id", "user_id"], "region": [], "nation": [], "supplier": [],
}
OWNER = {"o_custkey": "c_custkey", "user_id": "c_custkey", "l_orderkey": "o_orderkey", "l_partkey": "p_partkey"}
HOT = {"orders": "o_custkey", "events": "user_id"}


def compute(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def blow_up(spark, sf_dir: str, copies: int, folder: str) -> str:
    """A copy of the tables, ``copies`` times as large, with a third of the rows of ``HOT`` on one key."""
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in KEYS}
    width = {}
    for t, keys in KEYS.items():
        for k in keys:
            width.setdefault(OWNER.get(k, k), 0)
            width[OWNER.get(k, k)] = max(width[OWNER.get(k, k)], read[t].agg(F.max(k)).first()[0] + 1)
    for t, keys in KEYS.items():
        df = read[t]
        if keys:
            df = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
            for k in keys:
                kind = read[t].schema[k].dataType
                df = df.withColumn(k, (F.col(k) + F.col("_copy") * width[OWNER.get(k, k)]).cast(kind))
            if t in HOT:
                other = next(k for k in keys if k != HOT[t])
                df = df.withColumn(HOT[t], F.when(F.xxhash64(other) % 3 == 0, F.lit(1)).otherwise(F.col(HOT[t])).cast(read[t].schema[HOT[t]].dataType))
            df = df.drop("_copy")
        df.write.parquet(f"{folder}/{t}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    folder = tempfile.mkdtemp(prefix="bench-")
    name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    if copies > 1:
        sf_dir = blow_up(spark, sf_dir, copies, f"{folder}/tables")
    start = time.perf_counter()
    fixtures.store(spark, sf_dir, f"{folder}/views")
    stored = time.perf_counter() - start
    compute(QUERIES["employee_directory"](spark, sf_dir))
    times = {}
    for query in names:
        taken = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            start = time.perf_counter()
            compute(QUERIES[query](spark, sf_dir))
            taken.append(time.perf_counter() - start)
        times[query] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": name, "copies": copies, "store_sec": round(stored, 1), "cpus": cpus,
        "memory": spark.conf.get("spark.driver.memory"), "spark": spark.version,
        "reviews": spark.read.parquet(f"{sf_dir}/orders.parquet").count(),
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
