"""Mergeable states: any split into periods merges to the same profile, within the stated bounds."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftline.operators import sketches as SK
from driftline.session import work_dir


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(8)
    n = 6000
    x = np.concatenate([rng.lognormal(0, 3, n // 3), -rng.lognormal(0, 2, n // 3), np.zeros(n // 6), np.full(n - 2 * (n // 3) - n // 6, 7.5)])
    rng.shuffle(x)
    return pd.DataFrame({"p": rng.integers(0, 6, n), "x": x, "y": np.where(rng.random(n) < 0.1, np.nan, rng.normal(size=n))})


def _check(got, part):
    for r in got:
        v = np.sort(part[r["feature"]].dropna().to_numpy())
        assert r["n"] == len(v) and r["n_null"] == len(part) - len(v)
        np.testing.assert_allclose([r["min"], r["max"], r["mean"]], [v[0], v[-1], v.mean()], rtol=1e-9)
        assert abs(r["n_distinct"] - len(np.unique(v))) <= 4 * 1.04 / math.sqrt(2 ** SK.HLL_LG_K) * len(np.unique(v)) + 1
        for p, name in ((0.01, "a"), (0.25, "b"), (0.5, "c"), (0.9, "d"), (0.99, "e")):
            want = v[math.floor((len(v) - 1) * p)]
            assert abs(r[name] - want) <= SK.ACCURACY * 1.000001 * abs(want), (r["feature"], p, r[name], want)


def test_any_window_merges_within_the_bounds(spark, values):
    states = SK.write_states(spark.createDataFrame(values), "p", ["x", "y"])
    probs, names = [0.01, 0.25, 0.5, 0.9, 0.99], list("abcde")
    for lo, hi in ((0, 5), (2, 3), (4, 4)):
        got = SK.merged_profile(states.between(lo, hi), probs, names).collect()
        assert len(got) == 2
        _check(got, values[values["p"].between(lo, hi)])


def test_appended_states_add_up(spark, values):
    path = work_dir(spark, "states-test")
    half = spark.createDataFrame(values.iloc[:3000])
    SK.write_states(half, "p", ["x", "y"], path)
    states = SK.write_states(spark.createDataFrame(values.iloc[3000:]), "p", ["x", "y"], path)
    _check(SK.merged_profile(states, [0.01, 0.25, 0.5, 0.9, 0.99], list("abcde")).collect(), values)


def test_windows_are_partition_filters(spark, values):
    states = SK.write_states(spark.createDataFrame(values), "p", ["x"]).between(2, 3)
    plan = states.bins._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "DataFilters: []" in plan


def test_grid_orders_extremes(spark):
    xs = [-math.inf, -1.7e308, -1.0, -5e-324, 0.0, 5e-324, 1e-9, 1.0, 1.0000001, 1.7e308, math.inf]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").select("i", SK.grid_bin(F.col("x")).alias("b"))
    bins = [r["b"] for r in rows.orderBy("i").collect()]
    assert bins == sorted(bins) and bins[4] == 0 and len(set(bins)) == 11


def test_equal_periods_have_no_distance(spark):
    df = spark.range(4000).select((F.col("id") % 4).alias("p"), (F.floor(F.col("id") / 4) * 0.5).alias("x"))
    out = SK.trailing_js(SK.write_states(df, "p", ["x"]), 2).collect()
    assert {r["pair"] for r in out} == {1, 2, 3} and all(abs(r["js_distance"]) < 1e-9 for r in out)
    assert {r["pair"]: r["n1"] for r in out} == {1: 1000, 2: 2000, 3: 2000}
