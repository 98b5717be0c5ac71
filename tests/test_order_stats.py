"""Every path of the exact order statistics against sorting in Python."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from curbline.operators import order_stats
from curbline.operators.order_stats import MEDIAN_POSITIONS, median_of, order_statistics


def sample(seed):
    rng = random.Random(seed)
    hot = [(1, rng.gauss(0, 1e3)) for _ in range(3001)]  # one group holds most rows
    repeated = [(2, float(rng.randint(1, 5))) for _ in range(900)]
    tied = [(3, 7.25)] * 500
    null_key = [(None, rng.random() * 10 ** rng.randint(-6, 9)) for _ in range(700)]
    return hot + repeated + tied + null_key + [(4, 1.0), (5, 2.0), (5, 4.0)]


def test_medians(spark):
    rows = sample(3)
    df = spark.createDataFrame(rows, "k INT, v DOUBLE").repartition(7)
    out = order_statistics(df, ["k"], "v", MEDIAN_POSITIONS)
    got = {r["k"]: (r["n"], r["m"]) for r in out.withColumn("m", median_of(F.col("p0"), F.col("p1"))).collect()}
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    assert got.keys() == groups.keys()
    for k, values in groups.items():
        assert got[k][0] == len(values)
        assert got[k][1] == pytest.approx(median(values), rel=1e-12)


def test_arbitrary_ranks(spark):
    rows = sample(5)
    sixths = [lambda n, i=i: F.floor(i * n / 6).cast("bigint") for i in range(1, 6)]
    df = spark.createDataFrame(rows, "k INT, v DOUBLE")
    out = order_statistics(df, ["k"], "v", sixths).collect()
    for r in out:
        values = sorted(v for k, v in rows if k == r["k"])
        assert [r[f"p{i}"] for i in range(5)] == [values[i * len(values) // 6] for i in range(1, 6)]


def test_values_that_are_no_numbers_sort_last(spark):
    rng = random.Random(9)
    inf, nan = float("inf"), float("nan")
    # nine tenths of all rows are one group
    rows = [(1, rng.uniform(-1e3, 1e3)) for _ in range(1800)] + [(1, inf), (1, -inf), (1, nan), (1, 1e308)]
    rows += [(2, nan)] * 3 + [(3, -inf), (3, inf)] + [(4, float(i)) for i in range(150)]
    df = spark.createDataFrame(rows, "k INT, v DOUBLE").repartition(5)
    ends = [lambda n: F.lit(0).cast("bigint"), MEDIAN_POSITIONS[1], lambda n: (n - 1).cast("bigint")]
    out = {r["k"]: r for r in order_statistics(df, ["k"], "v", ends).collect()}
    for k in (1, 2, 3, 4):
        values = sorted((v for g, v in rows if g == k), key=lambda v: (v != v, v))
        want = [values[0], values[len(values) // 2], values[-1]]
        assert [str(out[k][f"p{i}"]) for i in range(3)] == list(map(str, want))


def test_buckets_grow_with_the_value(spark):
    values = sorted([0.0, -0.0, 1e-300, -1e-300, 1e308, -1e308, 3.2, 3.25, -3.2, 7.0, 1e9, float("inf"), -float("inf")])
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE").select("v", order_stats.interval_of("v").alias("b"))
    found = [r["b"] for r in sorted(df.collect(), key=lambda r: r["v"])]
    assert found == sorted(found)


def test_no_action_while_the_plan_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    order_statistics(spark.range(100).selectExpr("id % 3 AS k", "id * 1D AS v"), ["k"], "v", MEDIAN_POSITIONS)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_many_values_in_a_narrow_interval(spark):
    """A million different values between 1.000 and 1.001: no walk holds more than a few thousand."""
    df = spark.range(1_000_000).selectExpr("1 AS k", "1 + id / 1e9D AS v")
    fine = df.select(order_stats.interval_of("v").alias("f")).groupBy("f").count()
    assert fine.agg(F.max("count")).first()[0] < 2000
    (row,) = order_statistics(df, ["k"], "v", MEDIAN_POSITIONS).collect()
    assert (row["n"], row["p0"], row["p1"]) == (1_000_000, 1 + 499_999 / 1e9, 1 + 500_000 / 1e9)


def test_the_counted_values_are_shuffled_once(spark, tmp_path):
    """Every narrower step reads the exchange of the counts again."""
    spark.range(1000).selectExpr("id % 3 AS k", "id * 1D AS v").write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = order_statistics(df, ["k"], "v", MEDIAN_POSITIONS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") >= 1
