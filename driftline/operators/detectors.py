"""Drift detectors over ordered streams of model errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.ecdf import scan_segments, segmented


def ddm(df: DataFrame, key: str, order_col: str, error_col: str, min_instances: int = 30,
        warning_level: float = 2.0, drift_level: float = 3.0) -> DataFrame:
    """Drift Detection Method per stream key.

    At instant i: p = errors so far / i, s = sqrt(p (1 - p) / i). (pmin, smin) are taken
    where p + s was smallest so far (latest instant on ties), counting only i >= min_instances.
    State is ``drift`` if p + s >= pmin + 3 smin, ``warning`` if >= pmin + 2 smin, else
    ``in_control``. No reset after a detection: the output marks every instant.

    The rows are cut into segments and written once; counts and the running minimum are scanned
    over that table, so one very long stream (a hot key) is still split across many tasks.
    """
    base = df.select(key, order_col, F.col(error_col).cast("long").alias("_err"), F.lit(1).alias("_one"))
    i = F.col("cum__one").cast("double")
    p = F.col("cum__err") / i
    s = F.sqrt(p * (1 - p) / i)
    lift = F.when(i >= min_instances, F.struct((p + s).alias("ps"), (-i).alias("ni"), p.alias("pm"), s.alias("sm")))

    def smaller(prev, run):
        return F.when(prev.isNull(), run).when(run.isNull(), prev).otherwise(F.least(run, prev))

    m = scan_segments(segmented(base, [key], order_col), [key], order_col, ["_one", "_err"], lift, smaller, "_min")
    m = m.withColumns({"p": p, "s": s}).withColumn("i", F.col("cum__one"))
    ps = F.col("p") + F.col("s")
    pmin, smin = F.col("_min.pm"), F.col("_min.sm")
    state = (F.when(F.col("i") < min_instances, F.lit("in_control"))
             .when(ps >= pmin + drift_level * smin, F.lit("drift"))
             .when(ps >= pmin + warning_level * smin, F.lit("warning"))
             .otherwise(F.lit("in_control")))
    return m.select(key, order_col, "i", "p", "s", state.alias("state"))


def ddm_summary(states: DataFrame, key: str) -> DataFrame:
    return states.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("state") != "in_control", F.col("i"))).alias("first_warning"),
        F.min(F.when(F.col("state") == "drift", F.col("i"))).alias("first_drift"),
        F.count_if(F.col("state") == "warning").alias("n_warning"),
        F.count_if(F.col("state") == "drift").alias("n_drift"))
