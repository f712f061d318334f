"""Decisions over ordered periods, and a domain classifier that never scores its training rows.

Both work from moments: one aggregate per period or fold, then small linear algebra on as many rows
as there are periods or folds. The data are not read again for another candidate, fold or
permutation of the labels.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.operators.models import _unpack, moment_stats, pool, solve_linear, sse_on

LEVELS = 4096  # score levels of the domain classifier


def monitor_loop(df: DataFrame, period: str, features: list[str], label: str, group: str | None = None,
                 margin: float = 0.0) -> DataFrame:
    """Retrain and keep only what is better, period by period.

    The first model is fitted on the first period. Before each later period a candidate is fitted on
    all periods so far; both are tested on the new period, and the candidate takes over if its
    RMSE is lower by more than ``margin`` (a share of the current one). Returns for every
    tested period: [group], period, n, trained_to (last period of the current model's data, before
    the decision), rmse_current, rmse_candidate, replaced, and the model in force afterwards.

    One aggregate by (group, period) makes the moments; a group's decisions run over its rows of
    these, one per period. Rows with a null period, feature or label are left out."""
    keys = [group] if group else []
    stats = moment_stats(df.filter(F.col(period).isNotNull()), features, label, [*keys, period])
    stats = stats if group else stats.withColumn("_g", F.lit(0))
    by = group or "_g"
    coefs = [f"coef_{f}" for f in features]
    columns = [by, period, "n", "trained_to", "rmse_current", "rmse_candidate", "replaced", "intercept", *coefs]
    kinds = dict(stats.dtypes)
    schema = ", ".join([f"`{by}` {kinds[by]}", f"`{period}` {kinds[period]}", "n long", f"trained_to {kinds[period]}", "rmse_current double",
                        "rmse_candidate double", "replaced boolean", "intercept double", *[f"`{c}` double" for c in coefs]])

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        records = pdf.sort_values(period).to_dict("records")
        parts = [_unpack(r, features, label) for r in records]
        seen, rows = parts[0], []
        current, trained_to = solve_linear(*seen)[:2], records[0][period]
        for i in range(1, len(parts)):
            candidate = solve_linear(*seen)[:2]
            old, new = (float(np.sqrt(sse_on(*parts[i], *m) / parts[i][0])) for m in (current, candidate))
            before, better = trained_to, new < old * (1 - margin)
            if better:
                current, trained_to = candidate, records[i - 1][period]
            rows.append((records[i][by], records[i][period], int(parts[i][0]), before, old, new, better, current[1], *map(float, current[0])))
            seen = pool([seen, parts[i]])
        return pd.DataFrame(rows, columns=columns)

    out = stats.groupBy(by).applyInPandas(decide, schema)
    return out if group else out.drop("_g")


def _row_hash(keys: list[str], seed: int) -> Column:
    """A number in [0, 1) from a row's key."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)


def cross_fitted_auc(df: DataFrame, label: str, cols: list[str], keys: list[str], folds: int = 5, permutations: int = 9) -> DataFrame:
    """AUC of a linear domain classifier by cross-fitting: test (0 = observed, then one per redrawn
    labelling), n, n_pos, auc.

    Rows fall into folds by a hash of ``keys``; the discriminant that scores a fold is solved from the
    moments of the others. For the null distribution the labels are redrawn at the observed rate, by
    hash, and all is done again with the same moments of the columns. Scores are mapped to
    ``LEVELS`` ordered levels, so the rank sum needs counts per level only. Missing values count
    as the column's mean."""
    x = [F.col(c).cast("double") for c in cols]
    x = [F.when(~F.isnan(v), v) for v in x]
    known = F.col(label).isNotNull()
    means = df.filter(known).agg(F.avg(F.col(label).cast("double")), *[F.avg(v) for v in x], *[F.stddev_pop(v) for v in x]).first()
    rate, mean, spread = means[0], means[1:1 + len(cols)], means[1 + len(cols):]
    if rate is None:
        return df.sparkSession.createDataFrame([], "test int, n long, n_pos long, auc double")
    names, labels = [f"x{i}" for i in range(len(cols))], [f"y{j}" for j in range(permutations + 1)]
    drawn = [F.col(label).cast("double")] + [(_row_hash(keys, 100 + j) < rate).cast("double") for j in range(permutations)]
    # centred and scaled once, so that plain sums of products are stable
    rows = df.filter(known).select(F.floor(_row_hash(keys, 1) * folds).cast("int").alias("fold"), *[y.alias(n) for y, n in zip(drawn, labels)],
                                   *[F.coalesce((v - (m or 0.0)) / (s or 1.0), F.lit(0.0)).alias(n) for v, m, s, n in zip(x, mean, spread, names)])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *[F.sum(a).alias(a) for a in (*names, *labels)],
                                    *[F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a, b in pairs],
                                    *[F.sum(F.col(a) * F.col(y)).alias(f"{a}_{y}") for a in names for y in labels]).collect()  # one row per fold
    weights = {r["fold"]: _discriminants([s.asDict() for s in sums if s["fold"] != r["fold"]], names, labels) for r in sums}
    level = None
    for fold, per_label in weights.items():
        scores = [sum((F.col(n) * w for n, w in zip(names, ws)), F.lit(0.0)) for ws in per_label]
        cells = F.array(*[F.struct(F.lit(j).alias("test"), F.col(y).alias("y"),
                                   F.least(F.floor(F.lit(float(LEVELS)) / (F.lit(1.0) + F.exp(F.lit(-1.7) * s))), F.lit(LEVELS - 1)).alias("level"))
                          for j, (y, s) in enumerate(zip(labels, scores))])
        level = (F if level is None else level).when(F.col("fold") == fold, cells)
    counts = rows.select(F.explode(level).alias("c")).groupBy("c.test", "c.level").agg(F.count_if(F.col("c.y") == 1).alias("c1"), F.count_if(F.col("c.y") == 0).alias("c0"))
    below = Window.partitionBy("test").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)  # LEVELS rows at most
    ranked = counts.withColumn("under", F.coalesce(F.sum("c0").over(below), F.lit(0)))
    wins = F.sum(F.col("c1") * (F.col("under") + F.col("c0") / 2.0))
    return ranked.groupBy("test").agg((F.sum("c1") + F.sum("c0")).alias("n"), F.sum("c1").alias("n_pos"),
                                      F.try_divide(wins, F.sum("c1").cast("double") * F.sum("c0")).alias("auc"))


def _discriminants(sums: list[dict], names: list[str], labels: list[str]) -> list[list[float]]:
    """Per labelling the weights of the columns, scaled so that scores have unit variance."""
    if not sums:
        return [[0.0] * len(names) for _ in labels]
    total = {k: sum(s[k] for s in sums) for k in sums[0] if k != "fold"}
    n, mean = total["n"], np.array([total[a] for a in names]) / total["n"]
    cov = np.array([[total[f"{min(a, b, key=names.index)}_{max(a, b, key=names.index)}"] for b in names] for a in names]) / n - np.outer(mean, mean)
    out = []
    for y in labels:
        cross = np.array([total[f"{a}_{y}"] for a in names]) / n - mean * total[y] / n
        w = np.linalg.lstsq(cov, cross, rcond=1e-10)[0]
        size = float(np.sqrt(max(w @ cov @ w, 0.0)))
        out.append((w / size if size > 0 else w * 0).tolist())
    return out


def domain_drift(df: DataFrame, label: str, cols: list[str], keys: list[str], folds: int = 5, permutations: int = 9) -> DataFrame:
    """One row: n_rows, domain_auc, null_auc (the farthest from 0.5 among redrawn labels) and drift:
    whether the observed AUC is farther from 0.5 than all of them."""
    tests = cross_fitted_auc(df, label, cols, keys, folds, permutations)
    far = F.abs(F.col("auc") - 0.5)
    one = tests.agg(F.max(F.when(F.col("test") == 0, F.col("n"))).alias("n_rows"), F.max(F.when(F.col("test") == 0, F.col("auc"))).alias("domain_auc"),
                    F.max(F.when(F.col("test") == 0, far)).alias("_far"), F.max(F.when(F.col("test") > 0, far)).alias("null_auc"))
    return one.select("n_rows", "domain_auc", (F.col("null_auc") + 0.5).alias("null_auc"), (F.col("_far") > F.col("null_auc")).alias("drift"))
