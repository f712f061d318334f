"""Exact quantiles by rank refinement: bins are counted and moved, values are not.

A quantile is the value at a known rank. One aggregate gives each column's count, range and
moments. The range is then cut into ``BINS`` bins; a grouped count per bin (combined map-side, so
a task hands on at most one row per bin) shows which bins hold a wanted rank, and only these are
cut again, each between its own smallest and largest value. A bin whose smallest and largest value
agree is the answer. Ties and hot values are one bin from the start.

Every pass is one scan and one small shuffle, for all columns, windows and quantiles together. A
pass splits a range by the factor ``BINS``, and a range that resists (values spread over many
magnitudes) is cut by logarithm next, so a double needs at most a handful of passes whatever the
number of rows; two are usual. The driver holds the bounds of the open bins: at most two per
quantile, column and window.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from driftline.functions.columns import present

BINS = 4096
STUBBORN = 16  # a bin that keeps more than one in so many of its range's values is cut by logarithm next
MAX_PASSES = 64  # far above what 64-bit values can need
MAX_GROUPS = 1000  # groups of ``by``: windows or periods, not keys of the data
_SPAN = 1500.0  # natural logarithms of positive doubles lie within [-745, 710]


@dataclass
class Bracket:
    """Values of one column and group in [lo, hi], ``before`` of them below, that hold ``ranks``."""
    lo: float
    hi: float
    before: int
    ranks: list[int]
    by_log: bool = False
    size: int = 0


@dataclass
class Target:
    """One column in one group: its moments, wanted ranks and the values found at them."""
    group: object
    column: str
    stats: dict
    brackets: list[Bracket] = field(default_factory=list)
    found: dict[int, float] = field(default_factory=dict)

    def quantile(self, p: float) -> float | None:
        """Linear interpolation between the two ranks around (n - 1) p."""
        n = self.stats["n"]
        if not n:
            return None
        h = (n - 1) * p
        lo, hi = self.found[math.floor(h)], self.found[math.ceil(h)]
        return lo if lo == hi else lo + (h - math.floor(h)) * (hi - lo)


def _moments(df: DataFrame, cols: list[str], by: str | None) -> list[Target]:
    """One wide aggregate over all columns."""
    one = [e.alias(f"{name}_{i}") for i, c in enumerate(cols) for name, e in (
        ("n", F.count(c)), ("min", F.min(c)), ("max", F.max(c)), ("mean", F.avg(c)), ("std", F.stddev_samp(c)))]
    grouped = df.groupBy(*[by] if by else []).agg(F.count(F.lit(1)).alias("rows"), *one)
    rows = grouped.limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"{by} has more than {MAX_GROUPS} groups; use driftline.operators.ecdf for keys of the data")
    out = []
    for r in rows:
        for i, c in enumerate(cols):
            stats = {name: r[f"{name}_{i}"] for name in ("n", "min", "max", "mean", "std")}
            out.append(Target(r[by] if by else None, c, stats | {"n_null": r["rows"] - stats["n"]}))
    return out


def _log_scale(x: float) -> float:
    return math.copysign(1 + (math.log(abs(x)) + 745) / _SPAN, x) if x else 0.0


def _bin(x: Column, b: Bracket) -> Column:
    """Bin of a value within a bracket, in value order: 0 and BINS + 1 hold the infinities."""
    top = sys.float_info.max
    lo, hi = max(b.lo, -top), min(b.hi, top)
    if b.by_log:
        size = F.lit(1.0) + (F.log(F.abs(x)) + 745.0) / _SPAN
        y, lo, hi = F.when(x > 0, size).when(x < 0, -size).otherwise(0.0), _log_scale(lo), _log_scale(hi)
    elif math.isinf(hi - lo):
        y, lo, hi = x / 2, lo / 2, hi / 2
    else:
        y = x
    cell = F.floor((y - F.lit(lo)) / F.lit(hi - lo) * float(BINS)) if hi > lo else F.lit(0)
    inside = F.least(F.greatest(cell, F.lit(0)), F.lit(BINS - 1)) + 1
    return F.when(x == -math.inf, F.lit(0)).when(x == math.inf, F.lit(BINS + 1)).otherwise(inside).cast("int")


def bin_counts(df: DataFrame, targets: list[Target], by: str | None) -> DataFrame:
    """(target, bracket, bin, n, lo, hi) of all open brackets, from one scan."""
    cells: dict[str, Column] = {}
    for t, target in enumerate(targets):
        for j, b in enumerate(target.brackets):
            x = F.col(target.column)
            here = (x >= F.lit(b.lo)) & (x <= F.lit(b.hi))
            if by:
                here = F.col(by).eqNullSafe(F.lit(target.group)) & here
            cell = F.struct(F.lit(t).alias("target"), F.lit(j).alias("bracket"), _bin(x, b).alias("bin"), x.alias("x"))
            cells[target.column] = cells[target.column].when(here, cell) if target.column in cells else F.when(here, cell)
    long = df.select(F.explode(F.array(*cells.values())).alias("c")).filter("c IS NOT NULL").select("c.*")
    return long.groupBy("target", "bracket", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))


def _refine(df: DataFrame, targets: list[Target], by: str | None) -> None:
    """One pass: every open bracket gives way to the bins that hold its ranks, or to their value."""
    spark = df.sparkSession
    open_ = [t for t in targets if t.brackets]
    wanted = spark.createDataFrame([(i, j, b.before, b.ranks) for i, t in enumerate(open_) for j, b in enumerate(t.brackets)],
                                   "target int, bracket int, before bigint, ranks array<bigint>")
    in_order = Window.partitionBy("target", "bracket").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # at most BINS + 2 rows
    bins = (bin_counts(df, open_, by).join(F.broadcast(wanted), ["target", "bracket"])
            .withColumn("first", F.col("before") + F.coalesce(F.sum("n").over(in_order), F.lit(0)))
            .withColumn("ranks", F.filter("ranks", lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("n"))))
            .filter(F.size("ranks") > 0).select("target", "bracket", "first", "n", "lo", "hi", "ranks"))
    left: dict[int, list[Bracket]] = {i: [] for i in range(len(open_))}
    for r in bins.collect():
        target = open_[r["target"]]
        was = target.brackets[r["bracket"]]
        if r["lo"] == r["hi"]:
            target.found |= dict.fromkeys(r["ranks"], r["lo"])
            continue
        stubborn = not was.by_log and r["n"] * STUBBORN > was.size
        left[r["target"]].append(Bracket(r["lo"], r["hi"], r["first"], list(r["ranks"]), stubborn, r["n"]))
    for i, target in enumerate(open_):
        target.brackets = left[i]


def column_statistics(df: DataFrame, cols: list[str], probs: list[float], by: str | None = None) -> list[Target]:
    """Moments and exact quantiles of every column (and group of ``by``). NaN is missing."""
    src = df.select(*[by] if by else [], *[present(F.col(c).cast("double"), "double").alias(c) for c in cols])
    targets = _moments(src, cols, by)
    for t in targets:
        n, lo, hi = t.stats["n"], t.stats["min"], t.stats["max"]
        if n:
            t.found = {0: lo, n - 1: hi}
            ranks = {f((n - 1) * p) for p in probs for f in (math.floor, math.ceil)} - t.found.keys()
            if lo == hi:
                t.found |= dict.fromkeys(ranks, lo)
            elif ranks:
                t.brackets = [Bracket(lo, hi, 0, sorted(ranks), size=n)]
    for _ in range(MAX_PASSES):
        if not any(t.brackets for t in targets):
            return targets
        _refine(src, targets, by)
    raise RuntimeError(f"quantiles not settled after {MAX_PASSES} passes")


def statistics_frame(df: DataFrame, cols: list[str], probs: list[float], names: list[str], by: str | None = None) -> DataFrame:
    """:func:`column_statistics` as rows: feature, the group, n, n_null, min, max, mean, std, ``names``."""
    group = [StructField(by, df.schema[by].dataType)] if by else []
    schema = StructType([StructField("feature", StringType()), *group, StructField("n", LongType()), StructField("n_null", LongType()),
                         *[StructField(c, DoubleType()) for c in ("min", "max", "mean", "std", *names)]])
    rows = [(t.column, *[t.group] * bool(by), *[t.stats[s] for s in ("n", "n_null", "min", "max", "mean", "std")],
             *[t.quantile(p) for p in probs]) for t in column_statistics(df, cols, probs, by)]
    return df.sparkSession.createDataFrame(rows, schema)
