"""Rank refinement against numpy: ties, hot values, extreme spreads, infinities, windows; no values are shuffled."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftline.operators import quantiles as Q
from driftline.operators import profile as P

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def frames():
    rng = np.random.default_rng(4)
    n = 3000
    hot = rng.normal(size=n)
    hot[: n // 3] = 0.25
    ties = rng.integers(0, 4, n).astype(float)
    return {"normal": rng.normal(size=n), "hot": hot, "ties": ties, "constant": np.full(n, 7.0),
            "magnitudes": rng.choice([-1, 1], n) * 10.0 ** rng.uniform(-300, 300, n),
            "powers": 2.0 ** rng.integers(-1000, 1000, n), "zeros": np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n)),
            "neighbours": 1.0 + rng.integers(0, 50, n) * np.finfo(float).eps,
            "outlier": np.concatenate([rng.normal(size=n - 1), [1e300]]), "wide": rng.choice([-1.7e308, 1.7e308, 3.0], n),
            "tiny": rng.integers(-5, 6, n) * 5e-324, "bits": rng.integers(-2**62, 2**62, n).astype(np.int64).view(np.float64)}


@pytest.mark.parametrize("name", sorted(frames()))
def test_quantiles_equal_sorted_ranks(spark, name):
    x = frames()[name]
    x = x[~np.isnan(x)]
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(5)
    t = Q.column_statistics(df, ["x"], PROBS)[0]
    s = np.sort(x)
    for rank, value in t.found.items():
        assert value == s[rank], (rank, value, s[rank])
    assert t.quantile(0.5) is not None


def test_all_columns_and_windows_at_once(spark):
    cols = {k: v for k, v in frames().items() if k in ("normal", "hot", "ties", "zeros")}
    pdf = pd.DataFrame(cols)
    pdf["w"] = np.arange(len(pdf)) % 3
    pdf.loc[pdf.index % 7 == 0, "hot"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("w", F.when(F.col("w") > 0, F.col("w")))
    out = Q.statistics_frame(df, list(cols), [0.1, 0.5], ["p10", "p50"], by="w").toPandas()
    assert len(out) == 12
    for r in out.itertuples():
        w = 0 if pd.isna(r.w) else r.w
        v = pdf.loc[pdf["w"] == w, r.feature]
        assert (r.n, r.n_null) == (v.notna().sum(), v.isna().sum())
        np.testing.assert_allclose([r.min, r.max, r.mean, r.std, r.p10, r.p50],
                                   [v.min(), v.max(), v.mean(), v.std(), v.quantile(0.1), v.quantile(0.5)], rtol=1e-12)


def test_infinities_and_no_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x, None) for x in [inf, -inf, 1.0, 2.0, 3.0, -inf, inf]] + [(None, float("nan"))], "x double, y double")
    t, y = Q.column_statistics(df, ["x", "y"], [0.25, 0.5, 0.75])
    assert t.found[3] == 2.0 and t.found[2] == 1.0 and t.stats["n_null"] == 1
    assert y.quantile(0.5) is None
    assert P.quantiles(df.filter("x = 1"), ["y"], [0.5], ["m"]).count() == 0
    assert P.column_profile(df.select("y"), ["y"]).first()["n_missing"] == 8


def test_passes_do_not_grow_with_the_rows(spark, monkeypatch):
    runs = []
    monkeypatch.setattr(Q, "_refine", lambda *a, f=Q._refine: (runs.append(1), f(*a)))
    for n in (1000, 200_000):
        runs.clear()
        Q.column_statistics(spark.range(n).select((F.col("id") * 0.37).alias("x")), ["x"], [0.25, 0.5, 0.75])
        assert len(runs) <= 2


def test_only_bin_counts_are_shuffled(spark):
    """One exchange, by bin, below a partial aggregate: its rows are bounded by bins, not by values."""
    df = spark.range(100_000).select((F.col("id") * 0.5).alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    targets = [Q.Target(None, c, {}, [Q.Bracket(0.0, hi, 0, [10])]) for c, hi in (("x", 5e4), ("y", 6.0))]
    plan = Q.bin_counts(df, targets, None)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "bin" in exchanges[0]
    below = plan.split("Exchange", 1)[1]
    assert "partial_count" in below
    assert Q.bin_counts(df, targets, None).count() <= 2 * (Q.BINS + 2)


def test_too_many_groups_are_refused(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.col("id").cast("double").alias("x"))
    with pytest.raises(ValueError, match="groups"):
        Q.column_statistics(df, ["x"], [0.5], by="k")
