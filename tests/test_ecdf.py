"""Two-level prefix sums and exact quantiles against brute force on small fixtures."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from driftline.operators.ecdf import exact_quantiles, prefix_min, prefix_sums
from driftline.operators import profile as P


def test_prefix_sums_match_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 500), "v": rng.normal(size=500).round(2), "c": rng.integers(1, 5, 500)})
    pdf = pdf.groupby(["k", "v"], as_index=False)["c"].sum()
    df = spark.createDataFrame(pdf).repartition(7)
    out = prefix_sums(df, ["k"], "v", ["c"], with_next=True, segments=5).toPandas().sort_values(["k", "v"])
    exp = pdf.sort_values(["k", "v"]).copy()
    exp["cum_c"] = exp.groupby("k")["c"].cumsum()
    exp["total_c"] = exp.groupby("k")["c"].transform("sum")
    exp["next_v"] = exp.groupby("k")["v"].shift(-1)
    assert out["cum_c"].tolist() == exp["cum_c"].tolist()
    assert out["total_c"].tolist() == exp["total_c"].tolist()
    np.testing.assert_allclose(out["next_v"].fillna(1e9), exp["next_v"].fillna(1e9))


def test_prefix_sums_single_key_many_segments(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("one"), F.lit("a").alias("k"))
    out = prefix_sums(df, ["k"], "v", ["one"], segments=13).orderBy("v").toPandas()
    assert out["cum_one"].tolist() == list(range(1, 1001))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=301).round(3), [5.0] * 40])
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    q = P.quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.75, 0.99], ["a", "b", "c", "d", "e"]).first()
    exp = np.percentile(vals, [10, 25, 50, 75, 99])
    np.testing.assert_allclose([q["a"], q["b"], q["c"], q["d"], q["e"]], exp, rtol=1e-12)


def test_prefix_min_struct(spark):
    pdf = pd.DataFrame({"k": [1] * 8, "o": range(8), "m": [5.0, 3.0, None, 4.0, 1.0, 2.0, None, 0.5]})
    df = spark.createDataFrame(pdf).withColumn("s", F.when(F.col("m").isNotNull(), F.struct("m")))
    out = prefix_min(df, ["k"], "o", "s", "run", segments=3).orderBy("o").toPandas()
    got = [r["m"] if r is not None else None for r in out["run"]]
    assert got == [5.0, 3.0, 3.0, 3.0, 1.0, 1.0, 1.0, 0.5]


def test_value_statistics_match_pandas(spark):
    """All statistics from one scan vs pandas: nulls, a hot value holding a third of the rows,
    a constant feature and an all-null feature."""
    from driftline.operators.ecdf import value_statistics
    rng = np.random.default_rng(3)
    n = 900
    a = rng.normal(10, 3, n).round(1)
    a[: n // 3] = 7.0  # hot value
    a[rng.random(n) < 0.1] = np.nan
    frames = [pd.DataFrame({"feature": "a", "value": a}),
              pd.DataFrame({"feature": "const", "value": np.full(50, 2.5)}),
              pd.DataFrame({"feature": "empty", "value": np.full(20, np.nan)})]
    pdf = pd.concat(frames, ignore_index=True)
    df = spark.createDataFrame(pdf).select("feature", F.when(~F.isnan("value"), F.col("value")).alias("value"))
    out = value_statistics(df.repartition(5), ["feature"], n_keys=3).toPandas().set_index("feature")
    for f, g in pdf.groupby("feature"):
        v = g["value"].dropna()
        row = out.loc[f]
        assert row["n"] == len(v) and row["n_null"] == g["value"].isna().sum()
        assert row["n_distinct"] == v.nunique()
        if len(v) == 0:
            assert pd.isna(row["mean"]) and pd.isna(row["p50"]) and pd.isna(row["mode"])
            continue
        np.testing.assert_allclose([row["min"], row["max"], row["mean"]], [v.min(), v.max(), v.mean()])
        np.testing.assert_allclose([row["p25"], row["p50"], row["p75"]], v.quantile([0.25, 0.5, 0.75]).to_numpy())
        if len(v) > 1:
            np.testing.assert_allclose(row["std"], v.std(ddof=1), atol=1e-12)
        counts = v.value_counts()
        assert row["mode"] == min(counts[counts == counts.max()].index)


def test_prefix_sums_cut_segments_match_pandas(spark):
    """Bounded keys take the quantile-cut path (segment = cuts below the value, one hash
    shuffle); a value holding a third of the counts and many segments per key."""
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 900), "v": rng.normal(size=900).round(2), "c": rng.integers(1, 5, 900)})
    pdf.loc[:300, "v"] = 0.5
    pdf = pdf.groupby(["k", "v"], as_index=False)["c"].sum()
    df = spark.createDataFrame(pdf).repartition(4)
    out = prefix_sums(df, ["k"], "v", ["c"], with_next=True, segments=9, n_keys=3).toPandas().sort_values(["k", "v"])
    exp = pdf.sort_values(["k", "v"]).copy()
    exp["cum_c"] = exp.groupby("k")["c"].cumsum()
    exp["total_c"] = exp.groupby("k")["c"].transform("sum")
    exp["next_v"] = exp.groupby("k")["v"].shift(-1)
    assert out["cum_c"].tolist() == exp["cum_c"].tolist()
    assert out["total_c"].tolist() == exp["total_c"].tolist()
    np.testing.assert_allclose(out["next_v"].fillna(1e9), exp["next_v"].fillna(1e9))
