"""Writes: defaults, feeds, upserts, deletes; reading and writing tables and files."""

import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tenurelake import schemas
from tenurelake.operators import dims, facts, ingest
from tenurelake.plans import browse
from tenurelake.sources import tables
from tenurelake.sources.partitions import BlockTable


def test_defaults_fill_missing_columns_only(spark):
    df = spark.createDataFrame([(1, None)], "employee_id int, attrition string")
    row = ingest.apply_defaults(df, "employees").first()
    assert row["attrition"] is None and row["over_time"] == "No" and row["percent_salary_hike"] == 0 and row["is_active"]


def test_feed_round_trip(spark, tmp_path):
    header = list(schemas.EMPLOYEE_FEED)
    def line(**over):
        base = {c: "1" for c in header} | {"FirstName": "a", "LastName": "b", "Email": "a@b.c", "Department": "Sales",
                                           "HireDate": "2024-02-29", "MonthlyIncome": "5000"}
        return tuple((base | over)[c] for c in header)
    feed = spark.createDataFrame([
        line(EmployeeID="1"), line(EmployeeID="2", Department="Nowhere", HireDate="31/12/2020", MonthlyIncome="99999.5"),
        line(EmployeeID="3", Phone="12345678901234567890", HireDate=None, MonthlyIncome="-4", Age="old"),
    ], ", ".join(f"{c} string" for c in header))
    tables.write_feed_csv(feed, f"{tmp_path}/csv")
    back, malformed = tables.read_feed_csv(spark, f"{tmp_path}/csv", schemas.EMPLOYEE_FEED)
    assert malformed.count() == 0
    dept = tables.seed_departments(spark).withColumn("department_id", F.col("department_id") + 4)
    got = {r["employee_id"]: r for r in ingest.conform_employee_feed(back, dept).collect()}
    assert (got[1]["department_id"], got[1]["hire_date"], got[1]["monthly_income"]) == (5, dt.date(2024, 2, 29), D("5000.00"))
    assert (got[2]["department_id"], got[2]["hire_date"], got[2]["monthly_income"]) == (1, dt.date(2020, 1, 1), D("19999.00"))
    assert (got[3]["phone"], got[3]["monthly_income"], got[3]["age"]) == ("123456789012345", D("1000.00"), None)


def test_malformed_line_is_kept_aside(spark, tmp_path):
    (tmp_path / "f.csv").write_text("A,B\n1,2\n1,2,3,4\n")
    rows, malformed = tables.read_feed_csv(spark, str(tmp_path / "f.csv"), {"B": "b", "A": "a", "C": "c"})
    assert [tuple(r) for r in rows.collect()] == [("2", "1", None)]
    assert [r["_corrupt_record"] for r in malformed.collect()] == ["1,2,3,4"]


def test_upsert_keeps_first_and_takes_last(spark):
    columns = "employee_id int, project_id int, role string, day int, released int"
    target = spark.createDataFrame([(1, 1, "Lead", 5, 9), (2, 2, "Lead", 5, 9)], columns)
    new = spark.createDataFrame([(1, 1, "Analyst", 7, 1), (3, 3, "A", 1, 1), (3, 3, "B", 2, 2)],
                                "employee_id int, project_id int, role string, day int, seq int")
    got = ingest.upsert(new, target, ["employee_id", "project_id"], ["role"], ["seq"])
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, "Analyst", 5, 9), (2, 2, "Lead", 5, 9), (3, 3, "B", 1, None)]


def test_upsert_may_set_null(spark):
    target = spark.createDataFrame([(1, "Lead")], "k int, role string")
    new = spark.createDataFrame([(1, None, 1)], "k int, role string, seq int")
    assert ingest.upsert(new, target, ["k"], ["role"], ["seq"]).first()["role"] is None


def test_facts_bind_to_current_versions(spark):
    reviews = spark.createDataFrame(
        [(r, e, dt.date(2020, 5, 1), 2020, 2, 4, 4, 4, 4, 4, 4) for r, e in [(1, 1), (2, 2), (3, 3), (4, 1)]],
        "review_id int, employee_id int, review_date date, review_year int, review_quarter int, " +
        ", ".join(f"{c} int" for c in facts.MEASURES))
    emp = spark.createDataFrame([(e, 10, D("9.00"), 1, 2, 3, "Yes") for e in (1, 2, 3)],
                                "employee_id int, department_id int, monthly_income decimal(10,2), percent_salary_hike int,"
                                " years_at_company int, training_times_last_year int, attrition string")
    dept = spark.createDataFrame([(10, "A")], "department_id int, department_name string")
    dim_dept = spark.createDataFrame([(7, 10)], "dept_key bigint, department_id int")
    dim = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 2, 1), (4, 2, 1), (5, 3, 0)],
                                "surrogate_key bigint, employee_id int, is_current int")
    held = spark.createDataFrame([(50, 4), (51, None)], "fact_id bigint, review_id int")
    rows = facts.load_fact_reviews(reviews, emp, dept, dim, dim_dept, held).orderBy("fact_id").collect()
    # review 2 fans out over two current versions, employee 3 has none, review 4 is loaded already
    assert [(r["fact_id"], r["review_id"], r["surrogate_key"]) for r in rows] == [(52, 1, 2), (53, 2, 3), (54, 2, 4)]
    assert {(r["project_key"], r["date_key"], r["attrition_flag"]) for r in rows} == {(None, 20200501, 1)}


def test_dimensions_load_once(spark):
    src = tables.seed_departments(spark)
    first = dims.load_dim_department(src, spark.createDataFrame([], schemas.struct_of("dim_department")))
    assert [r["dept_key"] for r in first.orderBy("department_id").collect()] == [1, 2, 3]
    renamed = src.withColumn("department_name", F.lit("x"))
    assert dims.load_dim_department(renamed, first).count() == 0


def test_sample_ignores_partitioning(spark):
    df = spark.range(1000)
    a = browse.sample_exact(df, "id", 50).collect()
    assert a == browse.sample_exact(df.repartition(13), "id", 50).collect() and len(set(a)) == 50
    assert a != browse.sample_exact(df, "id", 50, seed=1).collect()
    assert [r["id"] for r in browse.first_n(df, "id", 3).collect()] == [0, 1, 2]


def test_lookups_by_one_id(spark):
    dept = tables.seed_departments(spark)
    assert browse.department_by_id(dept, 2).first()["location"] == "San Francisco"
    assert browse.department_by_id(dept, 9).first() is None


def test_replacement_is_whole_or_absent(spark, tmp_path):
    house = tables.Warehouse(spark, str(tmp_path))
    assert house.read("dim_department").count() == 0 and not house.exists("dim_department")
    rows = dims.load_dim_department(tables.seed_departments(spark), house.read("dim_department"))
    house.append(rows, "dim_department")
    house.replace(house.read("dim_department").withColumn("location", F.lit("X")), "dim_department")
    assert {r["location"] for r in house.read("dim_department").collect()} == {"X"}

    broken = house.read("dim_department").withColumn("location", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        house.replace(broken, "dim_department")
    assert {r["location"] for r in house.read("dim_department").collect()} == {"X"}
    house.replace(house.read("dim_department").limit(2), "dim_department")
    assert house.read("dim_department").count() == 2


def test_archive_appears_with_its_version(spark, tmp_path):
    house = tables.Warehouse(spark, str(tmp_path))
    rows = spark.range(3).selectExpr("id as surrogate_key", "1 as is_current")
    rows = schemas.conform(rows, "dim_employee")
    house.replace(rows, "dim_employee")
    # an archive whose version never came to be is not seen, and is overwritten by the next run
    rows.limit(1).write.parquet(f"{tmp_path}/dim_employee/archive/v00000002")
    assert house.read("dim_employee").count() == 3
    house.replace(rows.filter("surrogate_key > 1"), "dim_employee", archive=rows.filter("surrogate_key <= 1"))
    assert house.read("dim_employee").count() == 3 and house.read_live("dim_employee").count() == 1


def test_delete_follows_each_foreign_key(spark):
    tables_before = {
        "employees": spark.createDataFrame([(1,), (2,)], "employee_id int"),
        "performance_reviews": spark.createDataFrame(
            [(1, 1, 2), (2, 2, 1), (3, 2, None)], "review_id int, employee_id int, reviewer_id int"),
        "project_assignments": spark.createDataFrame([(1, 5), (2, 5)], "employee_id int, project_id int"),
        "departments": spark.createDataFrame([(9,)], "department_id int"),
    }
    gone = spark.createDataFrame([(1,)], "employee_id int")
    after = ingest.apply_delete(tables_before, "employees", gone)
    assert [r["employee_id"] for r in after["employees"].collect()] == [2]
    assert sorted(tuple(r) for r in after["performance_reviews"].collect()) == [(2, 2, None), (3, 2, None)]
    assert [tuple(r) for r in after["project_assignments"].collect()] == [(2, 5)]
    assert after["departments"] is tables_before["departments"]

    fact = spark.createDataFrame([(7, None), (7, 3), (8, 3)], "surrogate_key bigint, dept_key bigint")
    star = {"fact_performance_reviews": fact, "dim_employee": spark.createDataFrame([(7,), (8,)], "surrogate_key bigint"),
            "dim_department": spark.createDataFrame([(3,)], "dept_key bigint")}
    blocked = ingest.blocking_rows(star, "dim_employee", spark.createDataFrame([(7,)], "surrogate_key bigint"))
    assert [tuple(r) for r in blocked.collect()] == [("fact_performance_reviews", 2)]
    left = ingest.apply_delete(star, "dim_department", star["dim_department"])
    assert {r["dept_key"] for r in left["fact_performance_reviews"].collect()} == {None}
    assert left["dim_department"].count() == 0


def test_a_delete_leaves_restricted_parents_and_needs_no_children(spark):
    emp = spark.createDataFrame([(1, 5), (2, 6)], "employee_id int, department_id int")
    dept = spark.createDataFrame([(5,), (6,), (7,)], "department_id int")
    proj = spark.createDataFrame([(1, 5), (2, 7)], "project_id int, department_id int")
    gone = spark.createDataFrame([(5,), (7,)], "department_id int")
    after = ingest.apply_delete({"departments": dept, "employees": emp, "projects": proj}, "departments", gone)
    assert sorted(r[0] for r in after["departments"].collect()) == [5, 6]
    assert sorted(tuple(r) for r in after["projects"].collect()) == [(1, 5), (2, None)]
    alone = ingest.apply_delete({"employees": emp}, "employees", emp.filter("employee_id = 1"))
    assert [r[0] for r in alone["employees"].collect()] == [2]


def test_insert_ignore_compares_text_without_case(spark):
    new = spark.createDataFrame([(1, "A@x.y"), (2, "a@x.y"), (3, "b@x.y"), (4, None), (5, None)], "id int, email string")
    held = spark.createDataFrame([("B@X.y",)], "email string")
    assert sorted(r["id"] for r in ingest.insert_ignore(new, held, ["email"], ["id"]).collect()) == [1, 4, 5]
    held = spark.createDataFrame([("a@X.y",)], "email string")
    assert sorted(r["id"] for r in ingest.insert_ignore(new, held, ["email"], ["id"]).collect()) == [3, 4, 5]


def test_upsert_fills_named_columns_of_new_keys_only(spark):
    columns = "k int, role string, day int, released int"
    new = spark.createDataFrame([(3, "A", 1, 8)], columns)
    target = spark.createDataFrame([(1, "Lead", 5, 9)], columns)
    got = ingest.upsert(new, target, ["k"], ["role"], ["day"], insert=["day"])
    assert sorted(tuple(r) for r in got.collect()) == [(1, "Lead", 5, 9), (3, "A", 1, None)]


def test_a_whole_replacement_retires_the_archive_and_scans_stay_few(spark, tmp_path):
    house = tables.Warehouse(spark, str(tmp_path))
    frame = lambda keys, live: schemas.conform(spark.createDataFrame(
        [(k, k, live) for k in keys], "surrogate_key bigint, employee_id int, is_current int"), "dim_employee")
    for night in range(10):
        house.replace(frame([100 + night], 1), "dim_employee", archive=frame([night], 0))
    df = house.read("dim_employee")
    assert df.count() == 11
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    house.replace_whole(house.read("dim_employee"), "dim_employee")
    assert house.read("dim_employee").count() == 11
    house.replace(frame([200], 1), "dim_employee", archive=frame([50], 0))
    assert sorted(r["surrogate_key"] for r in house.read("dim_employee").collect()) == [50, 200]


def test_an_empty_partitioned_table_can_be_read(spark, tmp_path):
    house = tables.Warehouse(spark, str(tmp_path))
    house.append(spark.createDataFrame([], schemas.struct_of("performance_reviews")), "performance_reviews")
    assert house.read("performance_reviews").count() == 0


def files_of(folder):
    import glob

    return {f: os.path.getmtime(f) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


def test_changes_touch_only_the_blocks_of_their_keys(spark, tmp_path):
    table = BlockTable(spark, f"{tmp_path}/t", "id", bits=3)
    rows = spark.range(100).selectExpr("cast(id as int) as id", "id % 7 as v").unionByName(
        spark.createDataFrame([(None, 1)], "id int, v long"))
    table.create(rows)
    before = files_of(f"{tmp_path}/t")
    new = spark.createDataFrame([(3, 50, 1), (97, 51, 1), (97, 52, 2), (200, 53, 1)], "id int, v long, o int")
    table.upsert(new, ["id"], ["v"], ["o"])
    after = files_of(f"{tmp_path}/t")
    changed = {os.path.basename(os.path.dirname(f)) for f in before if f not in after}
    assert changed == {"_block=0", "_block=12"} and all(after[f] == m for f, m in before.items() if f in after)
    want = {i: i % 7 for i in range(100)} | {3: 50, 97: 52, 200: 53, None: 1}
    assert {r["id"]: r["v"] for r in table.read().collect()} == want
    # a block whose rows all go, one of which some go, and the rows without a key
    table.delete(spark.createDataFrame([(i,) for i in [*range(8, 16), 40, 999]], "k int"), "k")
    want = {i: v for i, v in want.items() if i is None or not (8 <= i < 16 or i == 40)}
    assert {r["id"]: r["v"] for r in table.read().collect()} == want
    table.change(spark.createDataFrame([(None,)], "id int"), lambda held: held.limit(0))
    assert {r["id"] for r in table.read().collect()} == set(want) - {None}


def test_large_tables_get_wider_blocks(spark, tmp_path):
    """However many blocks the keys would fill, the table has few folders, and changes keep to them."""
    table = BlockTable(spark, f"{tmp_path}/t", "id", bits=2)
    table.create(spark.range(-4000, 16000).withColumn("v", F.lit(0)).unionByName(
        spark.createDataFrame([(None, 0), (2**60, 0)], "id long, v int")))
    folders = {os.path.dirname(f) for f in files_of(f"{tmp_path}/t")}
    assert 100 < len(folders) < 700
    before = files_of(f"{tmp_path}/t")
    BlockTable(spark, f"{tmp_path}/t", "id", bits=2).upsert(
        spark.createDataFrame([(5, 1, 1), (-4000, 2, 1), (16050, 3, 1)], "id long, v int, o int"), ["id"], ["v"], ["o"])
    after = files_of(f"{tmp_path}/t")
    assert 0 < len({f for f in before if f not in after}) <= 3
    table.delete(spark.createDataFrame([(2**60,), (7,)], "id long"))
    want = {i: 0 for i in range(-4000, 16000)} | {5: 1, -4000: 2, 16050: 3, None: 0}
    del want[7]
    assert {r["id"]: r["v"] for r in table.read().collect()} == want


def test_failed_change_leaves_the_table(spark, tmp_path):
    table = BlockTable(spark, f"{tmp_path}/t", "id", bits=3)
    table.create(spark.range(20))
    before = files_of(f"{tmp_path}/t")
    with pytest.raises(Exception):
        table.change(spark.range(3), lambda held: held.select(F.raise_error(F.lit("no")).cast("bigint").alias("id")))
    assert files_of(f"{tmp_path}/t") == before


def reviews_of(spark, n, shift=0):
    rows = spark.range(n).select(
        F.col("id").cast("int").alias("review_id"), (F.col("id") * 7919 % 1000).cast("int").alias("employee_id"),
        F.lit(None).cast("int").alias("reviewer_id"), F.lit(None).cast("date").alias("review_date"),
        (F.lit(2000 + shift) + F.col("id") % 3).cast("int").alias("review_year"),
    )
    return schemas.conform(rows, "performance_reviews")


def test_append_is_all_or_nothing(spark, tmp_path):
    house = tables.Warehouse(spark, str(tmp_path))
    house.append(reviews_of(spark, 30), "performance_reviews")
    house.append(reviews_of(spark, 20, 5), "performance_reviews")
    failing = reviews_of(spark, 1000).withColumn("review_id", F.when(
        F.col("review_id") < 990, F.col("review_id")).otherwise(F.raise_error(F.lit("no")).cast("int")))
    with pytest.raises(Exception):
        house.append(failing, "performance_reviews")
    assert house.read("performance_reviews").count() == 50
    house.append(reviews_of(spark, 1), "performance_reviews")
    assert house.read("performance_reviews").count() == 51
    house.replace(house.read("performance_reviews").limit(4), "performance_reviews")
    assert house.read("performance_reviews").count() == 4


def test_files_do_not_multiply_by_tasks(spark, tmp_path):
    house = tables.Warehouse(spark, str(tmp_path))
    house.append(reviews_of(spark, 3000).repartition(16), "performance_reviews")
    assert len(files_of(tmp_path)) <= 6  # three years


def test_a_look_up_in_a_compacted_table_opens_few_files(spark, tmp_path):
    import pyarrow.parquet as pq

    house = tables.Warehouse(spark, str(tmp_path))
    for _ in range(3):
        house.append(reviews_of(spark, 6000), "performance_reviews")
    house.compact("performance_reviews", files=24)
    newest = max(p for p in os.listdir(f"{tmp_path}/performance_reviews"))
    spans = []
    for f in files_of(f"{tmp_path}/performance_reviews/{newest}"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("employee_id")
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        spans.append((min(x.min for x in stats), max(x.max for x in stats)))
    assert len(spans) >= 20 and sum(lo <= 500 <= hi for lo, hi in spans) <= 6
    assert house.read("performance_reviews").count() == 18_000


def test_each_feed_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n1,x\n2,y,z\n")
    (tmp_path / "b.csv").write_text("B,A\nq,3\n")
    (tmp_path / "c.csv").write_text("B\nonly\n")
    (tmp_path / "d.csv").write_text("")
    rows, malformed = tables.read_feed_csv(spark, str(tmp_path), {"A": "a", "B": "b"})
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([("1", "x"), ("3", "q"), (None, "only")], key=str)
    assert [r["_corrupt_record"] for r in malformed.collect()] == ["2,y,z"]


def named(spark, *ids):
    return schemas.conform(spark.createDataFrame([(i,) for i in ids], "employee_id int"), "dim_employee")


def test_vacuum_keeps_the_table_and_its_archives(spark, tmp_path):
    house, home = tables.Warehouse(spark, str(tmp_path)), f"{tmp_path}/dim_employee"
    ids = lambda: sorted(r["employee_id"] for r in house.read("dim_employee").collect())
    assert house.vacuum("dim_employee") == []  # never written
    house.replace(named(spark, 1, 2), "dim_employee", archive=named(spark, 100))
    house.replace(named(spark, 1, 3), "dim_employee", archive=named(spark, 101))
    house.append(named(spark, 4), "dim_employee")
    house.replace(named(spark, 1, 4), "dim_employee")
    running = house.read("dim_employee")  # began before the vacuum
    house.replace(named(spark, 5), "dim_employee", archive=named(spark, 102))
    assert ids() == [5, 100, 101, 102]
    removed = house.vacuum("dim_employee", keep=2)
    assert ids() == [5, 100, 101, 102] and sorted(r["employee_id"] for r in running.collect()) == [1, 4, 100, 101]
    assert [os.path.basename(f) for f in removed] == ["v00000002.added"]
    assert not [f for v in (1, 2) for f in os.listdir(f"{home}/v{v:08d}") if f.endswith(".parquet")]
    house.replace_whole(named(spark, 6, 7), "dim_employee")
    house.vacuum("dim_employee", keep=2)  # a reader of the version before may still need the archives
    assert ids() == [6, 7] and len(os.listdir(f"{home}/archive")) == 3
    house.vacuum("dim_employee", keep=1)
    assert ids() == [6, 7] and os.listdir(f"{home}/archive") == []
    house.replace(named(spark, 8), "dim_employee", archive=named(spark, 103))
    for _ in range(2):
        house.vacuum("dim_employee", keep=1)
        assert ids() == [8, 103]
    assert sorted(f for f in os.listdir(home) if f.startswith("v")) == ["v00000006"]
    with pytest.raises(ValueError):
        house.vacuum("dim_employee", keep=0)


def test_an_archive_whose_version_failed_is_not_read(spark, tmp_path):
    house, home = tables.Warehouse(spark, str(tmp_path)), f"{tmp_path}/dim_employee"
    house.replace(named(spark, 1, 2), "dim_employee")
    # archived, then ended while the version was being written
    house._write(named(spark, 2), "dim_employee", f"{home}/archive/v00000002", "errorifexists")
    os.makedirs(f"{home}/v00000002/_temporary")
    assert house.read("dim_employee").count() == 2
    house.replace(named(spark, 1), "dim_employee", archive=named(spark, 2))
    ids = lambda: sorted(r["employee_id"] for r in house.read("dim_employee").collect())
    assert ids() == [1, 2]
    assert {os.path.relpath(f, home) for f in house.vacuum("dim_employee", keep=1)} == {"archive/v00000002", "v00000002", "v00000001"}
    assert ids() == [1, 2] and os.path.exists(f"{home}/v00000003")


def test_rows_are_noted_until_the_table_changes(spark, tmp_path, monkeypatch):
    house = tables.Warehouse(spark, str(tmp_path))
    assert house.rows("dim_employee") == 0
    house.append(named(spark, 1, 2), "dim_employee")
    assert house.rows("dim_employee") == 2
    house.note_rows("dim_employee", 2)
    with monkeypatch.context() as patch:
        patch.setattr(tables.Warehouse, "read", lambda *a: 1 / 0)
        assert house.rows("dim_employee") == 2
    house.append(named(spark, 3), "dim_employee")
    assert house.rows("dim_employee") == 3
    house.note_rows("dim_employee", 3)
    house.replace(named(spark, 1), "dim_employee", archive=named(spark, 7, 8, 9))
    assert house.rows("dim_employee") == 4
    house.note_rows("dim_employee", 4)
    house.vacuum("dim_employee", keep=1)
    with monkeypatch.context() as patch:
        patch.setattr(tables.Warehouse, "read", lambda *a: 1 / 0)
        assert house.rows("dim_employee") == 4
