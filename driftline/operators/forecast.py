"""Daily-series forecasting by per-weekday linear trend (closed form, one aggregate).

Re-aims the automated forecaster: for each day of week, y ~ a + b * t (t = days since
epoch) by ``regr_slope`` / ``regr_intercept``; future dates come from ``sequence`` over the
last training day, so no row ever leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.session import materialize_small

EPOCH = "1970-01-01"


def daily_series(df: DataFrame, time_col: str, value_col: str) -> DataFrame:
    """Daily sums, materialised once (one row per calendar day): the holdout split, the
    weekday fits and the horizon all read it, so the source is scanned once."""
    return materialize_small(df.groupBy(F.to_date(time_col).alias("day")).agg(F.sum(value_col).alias("y")))


def holdout_last(daily: DataFrame, days: int) -> tuple[DataFrame, DataFrame]:
    """Split off the last ``days`` calendar days (relative to the newest day) as the backtest."""
    last = daily.agg(F.max("day")).first()[0]  # one scalar
    cut = F.date_sub(F.lit(last), days)
    return daily.filter(F.col("day") <= cut), daily.filter(F.col("day") > cut)


def _t(c: str = "day"):
    return F.datediff(F.col(c), F.lit(EPOCH).cast("date")).cast("double")


def dow_trend_forecast(train: DataFrame, horizon: int = 10) -> DataFrame:
    """(day, dow, forecast) for the ``horizon`` days after the last training day."""
    coefs = (train.groupBy(F.dayofweek("day").alias("dow"))
             .agg(F.regr_slope("y", _t()).alias("b"), F.regr_intercept("y", _t()).alias("a")))
    future = train.agg(F.max("day").alias("_last")).select(
        F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))).alias("day"))
    fut = future.withColumn("dow", F.dayofweek("day"))
    return fut.join(coefs, "dow").select("day", "dow", (F.col("a") + F.col("b") * _t()).alias("forecast"))
