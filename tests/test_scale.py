"""Piecewise operators against Spark's own single-task windows and against numpy."""

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from tenurelake.operators import scale


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def sample(spark):
    """Few groups, one with a third of all rows; NULLs; many ties; ids over the whole int range."""
    rng = np.random.default_rng(3)
    n = 3000
    dept = np.where(rng.random(n) < 0.34, "hot", rng.choice(["a", "b", "c"], n))
    data = [
        (int(i), None if k % 41 == 0 else str(d), int(v), int(s))
        for k, (i, d, v, s) in enumerate(zip(
            rng.choice(2**31 - 1, n, replace=False), dept,
            rng.integers(-300000, 900000, n) // 1000 * 1000, rng.integers(3, 9, n)))
    ]
    return spark.createDataFrame(data, "id int, dept string, cents bigint, score bigint").cache()


@pytest.mark.parametrize("tiles", [1, 4, 7, 5000])
def test_ntile_equals_native(sample, tiles):
    got = scale.distributed_ntile(sample, "score", "id", tiles, "q")
    want = sample.withColumn("q", F.ntile(tiles).over(W.orderBy(F.desc("score"), "id")))
    assert rows(got) == rows(want)


def test_numbers_equal_native(sample):
    for kind in ("int", "bigint"):
        df = sample.select(F.col("id").cast(kind))
        want = df.select("id", F.row_number().over(W.orderBy("id")).alias("rn"))
        assert rows(scale.dense_numbers(df, "id", "rn")) == rows(want)


def test_numbers_of_wide_and_negative_ids(spark):
    ids = [-(2**62), -5, -1, 0, 3, 2**17, 2**40, 2**40 + 1, 2**62]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = dict(scale.dense_numbers(df, "id", "rn").collect())
    assert got == {i: k + 1 for k, i in enumerate(ids)}


def test_percent_rank_equals_native(sample):
    ranks = scale.value_ranks(sample, ["dept"], "cents")
    got = scale.null_safe_join(sample, ranks, ["dept", "cents"]).select(
        "id", F.when(F.col("total") == 1, 0.0).otherwise(F.col("before") / (F.col("total") - 1)).alias("p"),
        F.col("value_sum") / F.col("value_n"),
    )
    want = sample.select(
        "id", F.percent_rank().over(W.partitionBy("dept").orderBy("cents")).alias("p"),
        F.avg("cents").over(W.partitionBy("dept")),
    )
    for a, b in zip(rows(got), rows(want)):
        assert a == pytest.approx(b)


def test_percentiles_equal_numpy(sample):
    points = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "odd": 0.37, "hi": 1.0}
    got = {r["dept"]: r for r in scale.percentiles(sample, ["dept"], "cents", points).collect()}
    data = sample.toPandas()
    for dept, part in data.groupby("dept", dropna=False):
        r = got[dept if isinstance(dept, str) else None]
        for name, q in points.items():
            assert r[name] == pytest.approx(np.quantile(part["cents"], q))
        assert r["total"] == len(part)


def test_top_n_equals_dense_rank(sample):
    got = scale.top_n_per_group(sample, ["dept"], ["score", "cents"], 3, "r")
    w = W.partitionBy("dept").orderBy(F.desc("score"), F.desc("cents"))
    want = sample.withColumn("r", F.dense_rank().over(w)).filter("r <= 3")
    assert rows(got) == rows(want)
    # everything ties: all rows keep rank one
    tied = sample.withColumn("score", F.lit(1))
    assert scale.top_n_per_group(tied, ["dept"], ["score"], 1, "r").count() == sample.count()


@pytest.mark.parametrize("hot_rows", [10, 200, 10**9])
def test_sequences_do_not_depend_on_cutting(spark, sample, hot_rows):
    df = sample.withColumn("note", F.when(F.col("score") > 6, F.col("cents")))
    looks = dict(
        lag={"prev": F.col("cents"), "prev_note": F.col("note")}, lead={"next": F.col("cents")},
        fill={"held": F.col("note")},
    )
    got = scale.over_sequence(df, ["dept"], ["score", "id"], hot_rows, **looks)
    w = W.partitionBy("dept").orderBy("score", "id")
    want = df.withColumns({
        "prev": F.lag("cents").over(w), "prev_note": F.lag("note").over(w), "next": F.lead("cents").over(w),
        "held": F.last("note", True).over(w.rowsBetween(W.unboundedPreceding, 0)),
    })
    assert rows(got.select(*want.columns)) == rows(want)


def test_same_timestamps_are_cut_too(spark):
    """One key, one instant: only the id tells the rows apart."""
    df = spark.range(1000).select(F.lit(1).alias("k"), F.lit(5).alias("ts"), F.col("id"))
    got = scale.over_sequence(df, ["k"], ["ts", "id"], 100, lead={"next": F.col("id")})
    assert {(r["id"], r["next"]) for r in got.collect()} == {
        (i, i + 1 if i < 999 else None) for i in range(1000)
    }
    cut = scale.ordered_segments(df, ["k"], ["ts", "id"], 100, 1000)
    sizes = [r["count"] for r in cut.groupBy("_seg").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 400


def test_short_segments_share_a_task(spark):
    """Tasks follow the rows: 1000 segments need no 1000 partitions."""
    df = spark.range(10000).select((F.col("id") % 20).cast("int").alias("k"), F.col("id"))
    cut = scale.ordered_segments(df, ["k"], ["id"], 10, 10000)
    assert cut.rdd.getNumPartitions() <= 4
    assert cut.groupBy("_seg").count().agg(F.max("count")).first()[0] <= 10
    first = cut.groupBy("k", "_seg").agg(F.min("id").alias("id")).orderBy("k", "_seg").collect()
    assert [(r["k"], r["id"]) for r in first] == sorted((r["k"], r["id"]) for r in first)


def test_first_and_last_per_key(sample):
    keyed = sample.withColumn("k", F.coalesce("dept", F.lit("none")))
    for last in (False, True):
        order = F.desc if last else F.asc
        w = W.partitionBy("k").orderBy(order("cents"), order("id"))
        want = keyed.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
        assert rows(scale.first_per_key(keyed, ["k"], ["cents", "id"], last)) == rows(want)


def test_small_is_checked(spark):
    big = spark.range(100)
    assert scale.small(big, 10) is big
    assert "broadcast" in scale.small(big, 100)._jdf.queryExecution().logical().toString().lower()
