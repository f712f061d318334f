"""Profile states that are stored once per period and merged for any window.

A state holds, per period and column, the counts, range and moments, a HyperLogLog sketch of the
distinct values, and a histogram on a fixed logarithmic grid. The grid does not depend on the data,
so states of different periods, or appended later, add up bin by bin: comparing or profiling any
set of periods reads states, never rows again.

Error bounds: a quantile read from the grid differs from the value at that rank by a relative
``ACCURACY`` at most (bins grow by the factor (1 + a) / (1 - a), the answer is the point of a bin
that is equally far, relatively, from both ends); a distinct count has a relative standard error of
1.04 / sqrt(2 ** HLL_LG_K). Counts, range and mean are exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.functions.columns import present
from driftline.functions.stats import xlogy_ratio
from driftline.session import work_dir

ACCURACY = 0.01
HLL_LG_K = 12
_LOG_GAMMA = math.log((1 + ACCURACY) / (1 - ACCURACY))
_SHIFT = math.ceil(745 / _LOG_GAMMA) + 1  # makes the exponent of the smallest double positive
_TOP = math.ceil(710 / _LOG_GAMMA) + _SHIFT + 1  # infinity


def grid_bin(x: Column) -> Column:
    """Bin of a value in value order: 0 for zero, the mirrored positive bin for negative values."""
    size = F.when(F.abs(x) == math.inf, F.lit(_TOP)).otherwise(F.ceil(F.log(F.abs(x)) / _LOG_GAMMA) + _SHIFT)
    return F.when(x > 0, size).when(x < 0, -size).otherwise(0).cast("int")


def bin_value(b: Column) -> Column:
    """The value that stands for a bin."""
    size = F.exp((F.abs(b) - _SHIFT) * F.lit(_LOG_GAMMA)) * (1 - ACCURACY)
    size = F.when(F.abs(b) == _TOP, F.lit(math.inf)).otherwise(size)
    return F.when(b > 0, size).when(b < 0, -size).otherwise(0.0)


@dataclass
class States:
    """``heads``: a row per (period, feature); ``bins``: a row per (period, feature, bin)."""
    heads: DataFrame
    bins: DataFrame

    def between(self, first, last) -> States:
        """The states of a window of periods (both ends included), by partition."""
        inside = F.col("period").between(F.lit(first), F.lit(last))
        return States(self.heads.filter(inside), self.bins.filter(inside))


def write_states(df: DataFrame, period: str, cols: list[str], path: str | None = None, mode: str = "append") -> States:
    """Add the states of the periods in ``df`` to the tables under ``path`` (partitioned by period;
    periods that come again add up as well). One wide aggregate and one grouped count; both are
    combined map-side, so a task hands on a row per period, column and bin at most."""
    spark = df.sparkSession
    path = path or work_dir(spark, "states")
    src = df.select(F.col(period).alias("period"), *[present(F.col(c).cast("double"), "double").alias(c) for c in cols])
    long = src.unpivot(["period"], cols, "feature", "x")
    x = F.col("x")
    heads = long.groupBy("period", "feature").agg(
        F.count(x).alias("n"), F.count_if(x.isNull()).alias("n_null"), F.min(x).alias("lo"), F.max(x).alias("hi"), F.sum(x).alias("total"),
        F.hll_sketch_agg(F.xxhash64(F.when(x == 0, F.lit(0.0)).otherwise(x)), F.lit(HLL_LG_K)).alias("distinct"))
    bins = long.filter(x.isNotNull()).groupBy("period", "feature", grid_bin(x).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    for name, rows in (("heads", heads), ("bins", bins)):
        rows.repartition("period").write.mode(mode).partitionBy("period").parquet(f"{path}/{name}")
    return read_states(spark, path)


def read_states(spark: SparkSession, path: str) -> States:
    return States(spark.read.parquet(f"{path}/heads"), spark.read.parquet(f"{path}/bins"))


def merged_profile(states: States, probs: list[float], names: list[str]) -> DataFrame:
    """One row per feature over all periods of ``states``: n, n_null, min, max, mean, n_distinct (about)
    and quantiles (the value at rank floor((n - 1) p), within ``ACCURACY``)."""
    heads = states.heads.groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.min("lo").alias("min"), F.max("hi").alias("max"),
        F.try_divide(F.sum("total"), F.sum("n")).alias("mean"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"))
    in_order = Window.partitionBy("feature").orderBy("bin")  # bins of the grid, bounded by it
    per = states.bins.groupBy("feature", "bin").agg(F.sum("n").alias("n"))
    per = per.withColumn("after", F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    total = F.sum("n").over(Window.partitionBy("feature"))
    per = per.withColumn("total", total)
    aggs = []
    for p, name in zip(probs, names, strict=True):
        rank = F.floor((F.col("total") - 1) * F.lit(float(p)))
        aggs.append(F.min(F.when(F.col("after") > rank, F.col("bin"))).alias(name))
    at = per.groupBy("feature").agg(*aggs)
    out = heads.join(at, "feature", "left")
    clipped = [F.greatest(F.least(bin_value(F.col(n)), F.col("max")), F.col("min")).alias(n) for n in names]
    return out.select("feature", "n", "n_null", "min", "max", "mean", "n_distinct", *clipped)


def trailing_js(states: States, periods: int, coarse: int = 16) -> DataFrame:
    """Jensen-Shannon distance (base 2) of every period from the ``periods`` before it together, on
    bins of ``coarse`` grid steps: pair (the period), feature, n1, n2, js_distance. Integer periods;
    only stored bins are read."""
    b = F.col("bin")
    wide = F.when(b > 0, F.floor((b - 1) / coarse) + 1).when(b < 0, -(F.floor((-b - 1) / coarse) + 1)).otherwise(0)
    roles = F.array(*[F.struct((F.col("period") + k).alias("pair"), F.lit(2 if k == 0 else 1).alias("w")) for k in range(periods + 1)])
    cells = (states.bins.select("feature", wide.alias("bin"), "n", F.explode(roles).alias("r"))
             .groupBy("r.pair", "feature", "bin").agg(*[F.sum(F.when(F.col("r.w") == w, F.col("n")).otherwise(0)).alias(f"c{w}") for w in (1, 2)]))
    totals = cells.groupBy("pair", "feature").agg(F.sum("c1").alias("n1"), F.sum("c2").alias("n2")).filter("n1 > 0 AND n2 > 0")
    p, q = F.col("c1") / F.col("n1"), F.col("c2") / F.col("n2")
    m = (p + q) / 2
    per = cells.join(totals, ["pair", "feature"]).groupBy("pair", "feature").agg(
        F.first("n1").alias("n1"), F.first("n2").alias("n2"), F.sum(xlogy_ratio(p, m) + xlogy_ratio(q, m)).alias("_div"))
    return per.select("pair", "feature", "n1", "n2", F.sqrt(F.greatest(F.col("_div") / 2, F.lit(0.0))).alias("js_distance"))
