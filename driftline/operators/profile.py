"""Typed describe / summary / column profile / value counts.

All statistics come back as typed long tables (one row per column), never as the strings
``DataFrame.describe`` returns. Counts and moments are one map-side combined aggregate; exact
quantiles are found by rank refinement (:mod:`driftline.operators.quantiles`), which shuffles bin
counts instead of values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.columns import present
from driftline.operators.quantiles import statistics_frame


def long_values(df: DataFrame, cols: list[str], cast: str = "double", keep_nulls: bool = False) -> DataFrame:
    src = df.select([present(F.col(c).cast(cast), cast).alias(c) for c in cols])  # NaN is missing
    long = src.unpivot([], cols, "feature", "value")
    return long if keep_nulls else long.filter(F.col("value").isNotNull())


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, stddev (sample), min, max per numeric column."""
    long = long_values(df, cols)
    return long.groupBy("feature").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                       F.stddev_samp("value").alias("stddev"),
                                       F.min("value").alias("min"), F.max("value").alias("max"))


QUARTILES = [0.25, 0.5, 0.75], ["p25", "p50", "p75"]


def quantiles(df: DataFrame, cols: list[str], probs: list[float], names: list[str]) -> DataFrame:
    """Exact linear-interpolated quantiles per column; columns without values give no row."""
    return statistics_frame(df, cols, probs, names).filter("n > 0").select("feature", *names)


def summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """describe + exact quartiles; columns without values give no row."""
    st = statistics_frame(df, cols, *QUARTILES).filter("n > 0")
    return st.select("feature", F.col("n").alias("count"), "mean", F.col("std").alias("stddev"), "min", "max",
                     "p25", "p50", "p75")


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float], accuracy: int = 10000) -> DataFrame:
    """percentile_approx per column (bounded sketch memory, one pass)."""
    long = long_values(df, cols)
    return long.groupBy("feature").agg(
        F.percentile_approx("value", probs, accuracy).alias("quantiles"))


def column_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per numeric column: rows, missing, distinct, min/max/mean/std, quartiles, mode (ties -> smallest).

    Counts, moments and quartiles move no values. The exact distinct count and mode need each
    distinct value once: one grouped count, combined map-side.
    """
    st = statistics_frame(df, cols, *QUARTILES)
    per_value = long_values(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))
    own = per_value.groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"),
                                           F.min(F.struct((-F.col("c")).alias("neg"), F.col("value").alias("v"))).alias("_m"))
    out = st.join(own, "feature", "left")
    return out.select("feature", (F.col("n") + F.col("n_null")).alias("n_rows"), F.col("n_null").alias("n_missing"),
                      F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "min", "max", "mean", "std", "p25", "p50", "p75",
                      F.col("_m.v").alias("mode"))


def category_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per categorical column: rows, missing, unique values, mode (ties -> smallest)."""
    allv = long_values(df, cols, cast="string", keep_nulls=True)
    # one scan: value counts with the null group included, then one row per column
    vc = allv.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))
    v = F.col("value")
    per = vc.groupBy("feature").agg(
        F.sum("c").alias("n_rows"), F.coalesce(F.sum(F.when(v.isNull(), F.col("c"))), F.lit(0)).alias("n_missing"),
        F.count(v).alias("n_unique"),
        F.min(F.when(v.isNotNull(), F.struct((-F.col("c")).alias("neg"), v.alias("v")))).alias("_m"))
    return per.select("feature", "n_rows", "n_missing", "n_unique",
                      F.col("_m.v").alias("mode"), (-F.col("_m.neg")).alias("mode_count"))


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """Counts per value with nulls dropped (pandas ``value_counts`` semantics)."""
    return df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("count"))
