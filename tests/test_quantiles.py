"""Exact quantiles against Spark's own, and on one hot group."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.operators import quantiles, rollup


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and (a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-12)))


@pytest.mark.parametrize("share", [0.0, 0.5, 0.95, 0.99, 1.0])
def test_equal_to_percentile(spark, share):
    rng = np.random.default_rng(3)
    rows = [("hot", float(x)) for x in rng.lognormal(3, 2, 3000)] + [("ties", float(x)) for x in rng.integers(-3, 4, 500)] + [(None, float(x)) for x in rng.normal(0, 1e-9, 200)]
    rows += [("one", 5.0), ("null", None), ("some", None), ("some", 2.0), ("odd", math.inf), ("odd", -math.inf), ("odd", 1.0), ("odd", math.nan), ("wide", 1e300), ("wide", -1e300), ("wide", 1e-300), ("same", 0.1), ("same", 0.1), ("zero", -0.0), ("zero", 0.0)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(7)
    got = {r.k: (r.n, r.a, r.b) for r in quantiles.aggregate(df, ["k"], [F.count("*").alias("n")], {"a": ("x", share), "b": (F.col("x") * 2, 0.3)}).collect()}
    want = {r.k: (r.n, r.a, r.b) for r in df.groupBy("k").agg(F.count("*").alias("n"), F.percentile("x", share).alias("a"), F.percentile(F.col("x") * 2, 0.3).alias("b")).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and close(got[k][1], want[k][1]) and close(got[k][2], want[k][2]) for k in want)


@pytest.mark.parametrize("share", [0.0, 0.5, 0.95, 1.0])
def test_small_groups_equal_to_percentile_from_one_shuffle(spark, share):
    rng = np.random.default_rng(4)
    rows = [("many", float(x)) for x in rng.lognormal(3, 2, 500)] + [("ties", float(x)) for x in rng.integers(-3, 4, 200)] + [(None, 1.5), (None, 2.5)]
    rows += [("one", 5.0), ("null", None), ("some", None), ("some", 2.0), ("odd", math.inf), ("odd", -math.inf), ("odd", 1.0), ("odd", math.nan)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(3)
    found = quantiles.aggregate_small(df, ["k"], [F.count("*").alias("n"), F.count_distinct("x").alias("d")], {"a": ("x", share), "b": (F.col("x") * 2, 0.3)})
    plan = found._jdf.queryExecution().executedPlan().toString()
    got = {r.k: (r.n, r.d, r.a, r.b) for r in found.collect()}
    want = {r.k: (r.n, r.d, r.a, r.b) for r in df.groupBy("k").agg(F.count("*").alias("n"), F.count_distinct("x").alias("d"), F.percentile("x", share).alias("a"), F.percentile(F.col("x") * 2, 0.3).alias("b")).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][:2] == want[k][:2] and close(got[k][2], want[k][2]) and close(got[k][3], want[k][3]) for k in want)
    assert plan.count("Exchange hashpartitioning") == 1


def test_without_keys_and_without_rows(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert tuple(quantiles.aggregate(df, [], [F.count("*").alias("n")], {"q": ("x", 0.99)}).first()) == (1001, 990.0)
    assert tuple(quantiles.aggregate(df.limit(0), [], [F.count("*").alias("n")], {"q": ("x", 0.99)}).first()) == (0, None)
    assert quantiles.aggregate(df.limit(0), ["x"], [F.count("*").alias("n")], {"q": ("x", 0.99)}).count() == 0


def test_one_hot_group_is_spread(spark):
    """Half a million values of one group: what is counted, and what is left to rank, is a small part in each task."""
    df = spark.range(500_000).select(F.struct(F.lit(1).alias("k")).alias("g"), (F.rand(5) * 10_000).alias("x"))
    found = quantiles.exact_quantiles(df, "g", {"q": ("x", 0.95)})
    assert found.first()["q"] == df.agg(F.percentile("x", 0.95)).first()[0]
    cells = df.groupBy(quantiles.cell_of(F.col("x")).alias("cell")).agg(F.count("*").alias("n"))
    most = cells.agg(F.max("n"), F.count("*")).first()
    assert most[0] < 1000 and most[1] < 12_000


def test_delays_without_keys(spark):
    rows = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as event_time, timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, 3 * id) as created_at, timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, 7 * id) as updated_at from range(201)")
    got = rollup.delay_metrics(rows, "event_time").first()
    assert (got.p99_propagation_s, got.p99_offset_s, got.max_propagation_s, got.late_rows, got.updated_rows) == (792.0, 396.0, 800.0, 80, 200)
