"""Drift tests: metamorphic properties and a scenario with known answers."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from driftline.functions.stats import _gamma_q, chi2_sf_values
from driftline.operators import drift

SF001 = "/root/testdata/sf0.001"


def _frame(spark, cols: dict):
    return spark.createDataFrame(pd.DataFrame(cols))


def _grid(n, lo, hi):
    """Deterministic uniform sample: midpoints of a quantile grid."""
    return lo + (np.arange(n) + 0.5) / n * (hi - lo)


def test_js_zero_on_self_and_symmetric(spark):
    a = _frame(spark, {"x": _grid(500, 0, 10)})
    b = _frame(spark, {"x": _grid(300, 2, 14)})
    same = drift.js_distance(drift.to_long(drift.stack(a, a), ["x"]), ["feature"]).first()["js_distance"]
    ab = drift.js_distance(drift.to_long(drift.stack(a, b), ["x"]), ["feature"]).first()["js_distance"]
    ba = drift.js_distance(drift.to_long(drift.stack(b, a), ["x"]), ["feature"]).first()["js_distance"]
    assert same == 0.0
    assert abs(ab - ba) < 1e-12 and 0 < ab <= 1


def test_ks_bounds_and_identity(spark):
    xa, xb = _grid(400, 0, 1), _grid(300, 0.5, 1.5)
    a, b = _frame(spark, {"x": xa}), _frame(spark, {"x": xb})
    r = drift.ks_test(drift.to_long(drift.stack(a, b), ["x"]), ["feature"], n_tests=1).first()
    allv = np.concatenate([xa, xb])
    brute = np.max(np.abs(np.searchsorted(np.sort(xa), allv, "right") / 400
                          - np.searchsorted(np.sort(xb), allv, "right") / 300))
    assert abs(r["ks_stat"] - brute) < 1e-12 and r["p_value"] < 1e-6 and r["drift"]
    r0 = drift.ks_test(drift.to_long(drift.stack(a, a), ["x"]), ["feature"], n_tests=1).first()
    assert r0["ks_stat"] == 0 and r0["p_value"] == 1.0 and not r0["drift"]


def test_chi2_tail_closed_forms():
    # dof 2: Q(1, x/2) = exp(-x/2); dof 1 at x = 3.841458820694124 -> 0.05
    for x in (0.1, 1.0, 5.0, 20.0):
        assert abs(chi2_sf_values(np.array([x]), np.array([2.0]))[0] - math.exp(-x / 2)) < 1e-12
    assert abs(chi2_sf_values(np.array([3.841458820694124]), np.array([1.0]))[0] - 0.05) < 1e-9
    assert abs(_gamma_q(2.5, 100.0)) < 1e-30


def test_order_windows_scenario(spark):
    """Orders of odd against even customers are alike; moving the prices of one window, swapping
    statuses or dropping some must be flagged, each in its own row."""
    o = spark.read.parquet(f"{SF001}/orders.parquet").select(
        "o_totalprice", F.sqrt("o_totalprice").alias("root"), "o_orderstatus", "o_orderpriority", (F.col("o_custkey") % 2).alias("half"))
    a, b = o.filter("half = 0").drop("half"), o.filter("half = 1").drop("half")
    cats, nums = ["o_orderstatus", "o_orderpriority"], ["o_totalprice", "root"]

    def report(cur):
        return {(r["feature"], r["test"]): r for r in drift.drift_report(a, cur, cats, nums, with_ks=True).collect()}

    assert not any(r["drift"] for r in report(b).values())
    flags = F.when(F.col("o_orderstatus") == "F", "O").otherwise(F.col("o_orderstatus"))
    gone = F.when(F.col("o_orderpriority") < "4", F.col("o_orderpriority"))
    rep = report(b.withColumns({"o_totalprice": F.col("o_totalprice") + 250000, "o_orderstatus": flags, "o_orderpriority": gone}))
    assert rep["o_totalprice", "js_distance"]["drift"] and rep["o_totalprice", "ks"]["drift"] and not rep["root", "js_distance"]["drift"]
    assert rep["o_orderstatus", "chi2"]["drift"]
    missing = b.filter(gone.isNull()).count()
    assert rep["*", "total_nulls_2"]["statistic"] == missing > 0 and rep["*", "total_nulls_1"]["statistic"] == 0


def test_nan_is_missing(spark):
    """A NaN is no value: it moves no bin, rank or quantile and counts as a null."""
    nan = float("nan")
    a = _frame(spark, {"x": _grid(200, 0, 1)})
    far = _frame(spark, {"x": _grid(200, 5, 6)})
    bad = far.unionByName(spark.range(2).select(F.lit(nan).alias("x")))

    def long(cur):
        return drift.to_long(drift.stack(a, cur), ["x"])

    for test in (drift.js_distance, drift.ks_test, drift.wasserstein1, drift.mann_whitney, drift.kl_divergence):
        assert test(long(far), ["feature"]).first() == test(long(bad), ["feature"]).first()
    assert drift.null_rates(a, bad, ["x"]).first()["nulls_2"] == 2
    rep = drift.drift_report(a, bad, [], ["x"]).collect()
    assert {r["test"]: r["statistic"] for r in rep}["js_distance"] == 1.0 and {r["test"]: r["statistic"] for r in rep}["total_nulls_2"] == 2


def test_report_is_partition_invariant(spark):
    a = _frame(spark, {"x": _grid(300, 0, 5), "c": ["u", "v", "w"] * 100})
    b = _frame(spark, {"x": _grid(300, 1, 6), "c": ["u", "u", "w"] * 100})
    r1 = sorted(map(tuple, drift.drift_report(a, b, ["c"], ["x"], with_ks=True).collect()))
    r2 = sorted(map(tuple, drift.drift_report(a.repartition(5), b.repartition(3), ["c"], ["x"], with_ks=True).collect()))
    assert r1 == r2


def test_rolling_pairs(spark):
    df = spark.range(0, 400).select((F.col("id") % 4).alias("period"), (F.col("id") * 1.0).alias("x"))
    out = drift.rolling_js(df, "period", ["x"]).collect()
    assert sorted(r["pair"] for r in out) == [1, 2, 3]


def test_degenerate_windows_do_not_fail(spark):
    """Empty current window, constant columns, single category: nulls/zeros, no errors."""
    a = _frame(spark, {"x": [1.0, 1.0, 1.0], "c": ["u", "u", "u"]})
    b = a.limit(0)
    rep = drift.drift_report(a, b, ["c"], ["x"], with_ks=True).collect()
    assert {r["test"] for r in rep} >= {"js_distance", "ks", "chi2"}
    const = drift.js_distance(drift.to_long(drift.stack(a, a), ["x"]), ["feature"]).first()
    assert const["js_distance"] == 0.0
    mw = drift.mann_whitney(drift.to_long(drift.stack(a, a), ["x"]), ["feature"]).first()
    assert mw["z_score"] is None or mw["z_score"] == mw["z_score"]


def test_job_count_does_not_grow_with_columns(spark):
    """The report answers every column in the same jobs: 2 or 6 numeric columns, same count."""
    sc = spark.sparkContext

    def jobs(ncols, tag):
        cols = {f"x{i}": _grid(200, i, i + 3) for i in range(ncols)}
        cols["c"] = ["u", "v"] * 100
        a = _frame(spark, cols)
        b = _frame(spark, {k: (v[::-1] if k == "c" else v + 0.5) for k, v in cols.items()})
        st = drift.stack(a, b).cache()
        st.count()
        sc.setJobGroup(tag, tag)
        drift.drift_report_stacked(st, ["c"], [f"x{i}" for i in range(ncols)]).collect()
        n = len(sc.statusTracker().getJobIdsForGroup(tag))
        sc.setJobGroup("", "")
        st.unpersist()
        return n

    assert jobs(2, "two") == jobs(6, "six")


def test_hot_value_ks_and_mann_whitney_match_brute_force(spark):
    """One value holds a third of all rows of both windows: the statistics still equal the
    brute-force ECDF / rank computation (the hot value is one row of the distinct table)."""
    rng = np.random.default_rng(11)
    xa = rng.normal(0, 1, 900).round(2)
    xb = rng.normal(0.3, 1, 600).round(2)
    xa[:300], xb[:200] = 1.25, 1.25
    a, b = _frame(spark, {"x": xa}).repartition(6), _frame(spark, {"x": xb}).repartition(6)
    long = drift.to_long(drift.stack(a, b), ["x"])
    r = drift.ks_test(long, ["feature"], n_tests=1).first()
    allv = np.concatenate([xa, xb])
    brute = np.max(np.abs(np.searchsorted(np.sort(xa), allv, "right") / len(xa)
                          - np.searchsorted(np.sort(xb), allv, "right") / len(xb)))
    assert abs(r["ks_stat"] - brute) < 1e-12
    u = drift.mann_whitney(long, ["feature"], n_tests=1).first()["u_stat"]
    ranks = pd.Series(allv).rank(method="average").to_numpy()
    u_brute = ranks[: len(xa)].sum() - len(xa) * (len(xa) + 1) / 2
    assert abs(u - u_brute) < 1e-6
