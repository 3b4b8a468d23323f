"""Plans: what reaches the scan, and what must not appear."""

import re

import pytest
from pyspark.sql import functions as F

from bench import HEADLINE
from tenurelake import schemas
from tenurelake.catalog import QUERIES
from tenurelake.catalog.fixtures import view
from tenurelake.operators import scale
from tenurelake.plans import browse, marts
from tenurelake.sources.buckets import KeyBuckets
from tenurelake.sources.tables import Warehouse


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def house(spark, sf_dir, tmp_path_factory):
    house = Warehouse(spark, str(tmp_path_factory.mktemp("plans")))
    for table, source in {"fact_performance_reviews": "hr_fact_reviews", "dim_employee": "hr_dim_employee",
                          "performance_reviews": "hr_reviews", "employees": "hr_employees_full"}.items():
        house.append(schemas.conform(view(spark, sf_dir, source), table), table)
    return house


def scans(plan: str, column: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan" in line and column in line]


@pytest.fixture
def lazy(monkeypatch):
    """Leaves out the writing of intermediate results, so that one plan shows everything."""
    monkeypatch.setattr(scale, "checkpointed", lambda df: df)


def test_year_prunes_partitions_and_columns(house, lazy):
    top = marts.top_performers(house.read("fact_performance_reviews"), house.read("dim_employee"), 2000)
    facts = scans(plan_of(top), "performance_rating")
    assert facts and all(re.search(r"PartitionFilters: \[isnotnull\(review_year", s) for s in facts)
    assert all("ReadSchema: struct<surrogate_key:bigint,performance_rating:int>" in s for s in facts)
    by_year = scans(plan_of(browse.reviews_by_year(house.read("performance_reviews"), 2000)), "review_id")
    assert all("(review_year" in s.split("PartitionFilters")[1].split("]")[0] for s in by_year)


def test_filters_reach_the_files(house):
    distribution = plan_of(marts.salary_distribution(house.read("dim_employee")))
    assert all("EqualTo(is_current,1)" in s for s in scans(distribution, "monthly_income"))
    assert all("over_time" not in s for s in scans(distribution, "monthly_income"))
    one = scans(plan_of(marts.employee_history(house.read("dim_employee"), marts.dt.date(2020, 1, 1), 7)), "job_role")
    assert all("EqualTo(employee_id,7)" in s for s in one)


def test_top_n_reads_the_facts_once(house):
    calls, write = [], scale.checkpointed
    try:
        scale.checkpointed = lambda df: calls.append(plan_of(df)) or write(df)
        top = marts.top_performers(house.read("fact_performance_reviews"), house.read("dim_employee"), None)
    finally:
        scale.checkpointed = write
    assert len(calls) == 1 and len(scans(calls[0], "performance_rating")) == 1 and not scans(plan_of(top), "performance_rating")


def test_top_n_is_cut_before_the_shuffle(house):
    plan = plan_of(marts.top_performers(house.read("fact_performance_reviews"), house.read("dim_employee"), None))
    assert plan.count("WindowGroupLimit") >= 2  # partial and final


def test_no_products_and_no_unhinted_broadcasts(spark, sf_dir):
    """With automatic broadcasts off only the counted, hinted ones are left, and nothing is a product."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    try:
        for query in HEADLINE:
            plan = plan_of(QUERIES[query](spark, sf_dir))
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan, query
            if query not in ("yoy_performance", "department_kpis_total", "top_performers_year", "top_performers_all"):
                assert "BroadcastExchange" not in plan, query
    finally:
        for name in names:
            spark.conf.unset(name)


def test_new_rows_are_found_without_shuffling_the_keys_loaded(spark, tmp_path):
    """The batch is shuffled to the buckets, the history is not; and of the history only the row groups
    within the batch's range of keys are read."""
    keys = KeyBuckets(spark, f"{tmp_path}/keys", "id", buckets=16)
    for load in range(4):
        keys.add(spark.range(load * 50_000, load * 50_000 + 50_000))
    batch = spark.range(190_000, 210_000).withColumn("v", F.lit("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = keys.new(batch)
        plan = plan_of(new)
        rows = {r["id"] for r in new.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == set(range(200_000, 210_000))
    history = plan[: plan.index("FileScan")] if plan.index("FileScan") > plan.index("Range") else plan[plan.index("Range"):]
    assert "Exchange" not in history.split("Range")[-1] and "SelectedBucketsCount: 16 out of 16" in plan
    assert "GreaterThanOrEqual(id,190000)" in plan
    # the same keys in a table that another session would register
    again = KeyBuckets(spark, f"{tmp_path}/keys", "id", buckets=16)
    assert again.read().count() == 200_000 and again.new(spark.createDataFrame([(None,), (5,), (-1,)], "id int")).count() == 2
    assert again.new(batch.limit(0)).count() == 0
