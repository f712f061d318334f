"""Monitoring loop and domain classifier against plain numpy."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from driftline.operators import monitor as M


def _brute_loop(pdf, margin=0.0):
    periods = sorted(pdf["p"].unique())
    fit = lambda d: np.linalg.lstsq(np.column_stack([np.ones(len(d)), d[["x", "z"]]]), d["y"], rcond=None)[0]
    rmse = lambda m, d: np.sqrt(np.mean((d["y"] - np.column_stack([np.ones(len(d)), d[["x", "z"]]]) @ m) ** 2))
    current, to, out = fit(pdf[pdf["p"] == periods[0]]), periods[0], []
    for i, p in enumerate(periods[1:], 1):
        candidate, d = fit(pdf[pdf["p"] < p]), pdf[pdf["p"] == p]
        old, new = rmse(current, d), rmse(candidate, d)
        better, before = new < old * (1 - margin), to
        if better and i > 1:
            current, to = candidate, periods[i - 1]
        out.append((p, len(d), before, old, new, bool(better and i > 1), *current))
    return out


def _frame(seed, shift_at):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"p": rng.integers(0, 9, 3000), "x": rng.normal(size=3000), "z": rng.normal(5, 2, 3000)})
    slope = np.where(pdf["p"] >= shift_at, -2.0, 1.0)
    pdf["y"] = slope * pdf["x"] + 0.5 * pdf["z"] + rng.normal(0, 0.3, 3000)
    return pdf


def test_loop_equals_refitting_from_rows(spark):
    pdf = _frame(0, 4)
    got = M.monitor_loop(spark.createDataFrame(pdf).repartition(6), "p", ["x", "z"], "y", margin=1e-9).orderBy("p").collect()
    want = _brute_loop(pdf, 1e-9)
    assert [(r["p"], r["n"], r["trained_to"], r["replaced"]) for r in got] == [(w[0], w[1], w[2], w[5]) for w in want]
    np.testing.assert_allclose([[r["rmse_current"], r["rmse_candidate"], r["intercept"], r["coef_x"], r["coef_z"]] for r in got],
                               [[w[3], w[4], *w[6:]] for w in want], rtol=1e-6)
    assert any(r["replaced"] for r in got if r["p"] > 4)  # after the change only a retrained model fits


def test_loop_per_group_and_missing_rows(spark):
    pdf = pd.concat([_frame(1, 3).assign(g="a"), _frame(2, 99).assign(g="b")])
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([(None, 1.0, 1.0, 1.0, "a"), (3, None, 1.0, 1.0, "b")], "p long, x double, z double, y double, g string"))
    got = M.monitor_loop(df, "p", ["x", "z"], "y", group="g", margin=1e-9).collect()
    for g in "ab":
        want = _brute_loop(pdf[pdf["g"] == g], 1e-9)
        assert [r["replaced"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["p"])] == [w[5] for w in want]
    assert M.monitor_loop(df.filter("p = 0"), "p", ["x"], "y").count() == 0  # one period: nothing to test on
    assert M.monitor_loop(df.limit(0), "p", ["x"], "y").count() == 0


def _two_windows(spark, n, shift):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"k": np.arange(n), "a": rng.normal(size=n), "b": rng.exponential(size=n)})
    pdf["w"] = (rng.random(n) < 0.3).astype(int)
    pdf["a"] += shift * pdf["w"]
    pdf.loc[pdf["k"] % 11 == 0, "b"] = np.nan
    return spark.createDataFrame(pdf)


def test_equal_windows_stay_near_one_half(spark):
    r = M.domain_drift(_two_windows(spark, 20_000, 0.0), "w", ["a", "b"], ["k"]).first()
    assert r["n_rows"] == 20_000 and abs(r["domain_auc"] - 0.5) < 0.02 and abs(r["null_auc"] - 0.5) < 0.03


def test_few_rows_do_not_look_like_drift(spark):
    """Scored on its own training rows, a model of 12 columns separates 120 rows of noise."""
    rng = np.random.default_rng(3)
    cols = [f"c{i}" for i in range(12)]
    pdf = pd.DataFrame(rng.normal(size=(120, 12)), columns=cols).assign(k=np.arange(120), w=rng.integers(0, 2, 120))
    out = M.cross_fitted_auc(spark.createDataFrame(pdf), "w", cols, ["k"]).collect()
    observed = next(r["auc"] for r in out if r["test"] == 0)
    assert observed < 0.65 and len(out) == 10 and all(r["n"] == 120 for r in out)


def test_shifted_window_is_found(spark):
    df = _two_windows(spark, 6000, 0.8)
    r = M.domain_drift(df, "w", ["a", "b"], ["k"]).first()
    assert r["drift"] and 0.68 < r["domain_auc"] < 0.76  # a shift of 0.8 sd: AUC = Phi(0.8 / sqrt(2)) = 0.714
    assert M.domain_drift(df, "w", ["a", "b"], ["k"]).first() == r
    flat = df.withColumn("a", F.lit(1.0)).withColumn("b", F.lit(None).cast("double"))
    assert M.domain_drift(flat, "w", ["a", "b"], ["k"]).first()["domain_auc"] == 0.5
    assert M.domain_drift(df.limit(0), "w", ["a", "b"], ["k"]).first()["n_rows"] is None
