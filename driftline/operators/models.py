"""Model-side data work: sufficient statistics for linear models, metrics as aggregates,
rank-based AUC, exact imputation, and helpers around MLlib estimators.

Linear models are fitted from *sufficient statistics*: one grouped aggregate computes means
and (numerically stable, Welford-merged) covariances per group or fold; the tiny d x d solve
happens per group on one row. Work is one pass over the data whatever the number of groups,
folds or candidate settings, and no group's rows are ever gathered in one place.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.operators.ecdf import prefix_sums
from driftline.operators.joins import join_bounded


# ------------------------------------------------------------------------ sufficient statistics
def moment_stats(df: DataFrame, features: list[str], label: str, group_cols: list[str] = ()) -> DataFrame:
    """n, means, population covariances of (features, label) per group: one aggregate."""
    cols = [*features, label]
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(c).alias(f"m_{c}") for c in cols]
    for a, b in itertools.combinations_with_replacement(cols, 2):
        aggs.append(F.covar_pop(a, b).alias(f"c_{a}__{b}"))
    src = df.select(*group_cols, *[F.col(c).cast("double").alias(c) for c in cols]).na.drop(subset=cols)
    return src.groupBy(*group_cols).agg(*aggs) if group_cols else src.agg(*aggs)


def _unpack(row: dict, features: list[str], label: str):
    cols = [*features, label]
    n = float(row["n"])
    mean = np.array([row[f"m_{c}"] for c in cols], dtype="float64")
    cov = np.zeros((len(cols), len(cols)))
    for (i, a), (j, b) in itertools.combinations_with_replacement(list(enumerate(cols)), 2):
        v = row.get(f"c_{a}__{b}")
        cov[i, j] = cov[j, i] = 0.0 if v is None or pd.isna(v) else v
    return n, mean, cov


def pool(parts):
    """Combine (n, mean, cov) of disjoint parts into the stats of their union."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    cov = sum(p[0] * (p[2] + np.outer(p[1] - mean, p[1] - mean)) for p in parts) / n
    return n, mean, cov


def solve_linear(n: float, mean: np.ndarray, cov: np.ndarray, reg: float = 0.0):
    """Least squares (ridge when reg > 0, intercept not penalised) from centered statistics.

    Returns (coef, intercept, mse_on_these_stats)."""
    d = len(mean) - 1
    sxx, sxy = cov[:d, :d], cov[:d, d]
    a = n * sxx + reg * np.eye(d)
    coef = np.linalg.lstsq(a, n * sxy, rcond=None)[0]
    intercept = mean[d] - coef @ mean[:d]
    mse = cov[d, d] - 2 * coef @ sxy + coef @ sxx @ coef
    return coef, float(intercept), float(max(mse, 0.0))


def sse_on(n: float, mean: np.ndarray, cov: np.ndarray, coef: np.ndarray, intercept: float) -> float:
    """Sum of squared errors of a fixed linear model on data summarised by (n, mean, cov)."""
    d = len(mean) - 1
    bias = mean[d] - intercept - coef @ mean[:d]
    var = cov[d, d] - 2 * coef @ cov[:d, d] + coef @ cov[:d, :d] @ coef
    return float(n * (bias * bias + max(var, 0.0)))


def grouped_linear_fit(df: DataFrame, group_col: str, features: list[str], label: str,
                       reg: float = 0.0) -> DataFrame:
    """One linear model per group: (group, n_used, intercept, coef_<f>..., mse).

    The per-group statistics table has one row per group; the solve runs in
    ``applyInPandas`` on those rows only (coefficients travel in the result row).
    """
    stats = moment_stats(df, features, label, [group_col])
    gtype = df.schema[group_col].dataType.simpleString()
    out_schema = (f"{group_col} {gtype}, n_used long, intercept double, "
                  + ", ".join(f"coef_{f} double" for f in features) + ", mse double")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for rec in pdf.to_dict("records"):
            n, mean, cov = _unpack(rec, features, label)
            coef, b0, mse = solve_linear(n, mean, cov, reg)
            rows.append({group_col: rec[group_col], "n_used": int(n), "intercept": b0,
                         **{f"coef_{f}": float(c) for f, c in zip(features, coef)}, "mse": mse})
        return pd.DataFrame(rows, columns=[group_col, "n_used", "intercept", *[f"coef_{f}" for f in features], "mse"])

    return stats.groupBy(group_col).applyInPandas(fit, out_schema)


def linear_score(df: DataFrame, coefs: DataFrame, group_col: str, features: list[str],
                 out: str = "prediction", max_groups: int | None = None) -> DataFrame:
    """Score facts with their group's model: join on the key to the coefficient table (one row
    per group) and evaluate the linear form natively. The table is broadcast when the caller
    bounds the number of groups (``max_groups``); otherwise AQE picks the join from its
    measured size."""
    pred = F.col("intercept")
    for f in features:
        pred = pred + F.col(f"coef_{f}") * F.col(f)
    table = coefs.select(group_col, "intercept", *[f"coef_{f}" for f in features])
    return join_bounded(df, table, group_col, "left", max_rows=max_groups) \
        .withColumn(out, pred).drop("intercept", *[f"coef_{f}" for f in features])


def cv_ridge_trials(df: DataFrame, features: list[str], label: str, fold: Column, k: int,
                    candidates: DataFrame) -> DataFrame:
    """k-fold CV of ridge candidates, one trial per task.

    One aggregate computes per-fold statistics (k rows, bounded by k x d^2); they ship to the
    tasks with the closure. ``candidates`` (trial_id, reg) is grouped by trial and each
    task solves on the k-1 training folds and scores the held-out fold, so the data is read
    once no matter how many candidates there are. Loss = -mean r2 (to maximise r2).
    """
    stats = moment_stats(df.withColumn("_fold", fold), features, label, ["_fold"]).collect()  # k rows
    folds = {int(r["_fold"]): _unpack(r.asDict(), features, label) for r in stats}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for rec in pdf.to_dict("records"):
            r2s, rmses = [], []
            for f, (nv, mv, cv) in folds.items():
                tr = pool([v for g, v in folds.items() if g != f])
                coef, b0, _ = solve_linear(*tr, reg=float(rec["reg"]))
                sse = sse_on(nv, mv, cv, coef, b0)
                sst = nv * cv[-1, -1]
                r2s.append(1 - sse / sst if sst > 0 else 0.0)
                rmses.append(np.sqrt(sse / nv))
            out.append({"trial_id": rec["trial_id"], "reg": rec["reg"], "mean_r2": float(np.mean(r2s)),
                        "mean_rmse": float(np.mean(rmses)), "loss": -float(np.mean(r2s)), "n_folds": len(folds)})
        return pd.DataFrame(out, columns=["trial_id", "reg", "mean_r2", "mean_rmse", "loss", "n_folds"])

    return candidates.groupBy("trial_id").applyInPandas(
        run, "trial_id long, reg double, mean_r2 double, mean_rmse double, loss double, n_folds int")


def cv_ridge_losses(df: DataFrame, features: list[str], label: str, fold: Column):
    """A function (reg, columns) -> mean RMSE over held-out folds, for any subset of ``features``: the data
    are read once, for the moments per fold; every trial is linear algebra on these few rows."""
    stats = moment_stats(df.withColumn("_fold", fold), features, label, ["_fold"]).collect()  # a row per fold
    folds = {r["_fold"]: _unpack(r.asDict(), features, label) for r in stats}

    def loss(reg: float, columns: list[str]) -> float:
        at = [features.index(c) for c in columns] + [len(features)]
        part = {f: (n, mean[at], cov[np.ix_(at, at)]) for f, (n, mean, cov) in folds.items()}
        out = []
        for f, held in part.items():
            coef, intercept, _ = solve_linear(*pool([v for g, v in part.items() if g != f]), reg=reg)
            out.append(np.sqrt(sse_on(*held, coef, intercept) / held[0]))
        return float(np.mean(out))

    return loss


# ------------------------------------------------------------------------ metrics as aggregates
def regression_metrics(df: DataFrame, label: str, pred: str, group_cols: list[str] = ()) -> DataFrame:
    """rmse, mse, mae, r2 (1 - SSE/SST) in one aggregate."""
    e = F.col(label) - F.col(pred)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
            F.sum(e * e).alias("_sse"), F.var_pop(label).alias("_vy")]
    g = df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
    return g.select(*group_cols, "n", F.sqrt("mse").alias("rmse"), "mse", "mae",
                    (1 - F.try_divide(F.col("_sse"), F.col("_vy") * F.col("n"))).alias("r2"))


def smape(df: DataFrame, label: str, pred: str, digits: int | None = None) -> DataFrame:
    """Symmetric MAPE: mean of 2|y - p| / (|y| + |p|), 0 where both are 0; with the row count."""
    y, p = F.col(label), F.col(pred)
    term = F.when((F.abs(y) + F.abs(p)) == 0, F.lit(0.0)).otherwise(2 * F.abs(y - p) / (F.abs(y) + F.abs(p)))
    val = F.avg(term) if digits is None else F.round(F.avg(term), digits)
    return df.agg(F.count(F.lit(1)).alias("n_days"), val.alias("smape"))


def confusion_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Binary accuracy / precision / recall / f1 from the four confusion counts."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    g = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
               F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return g.select("tp", "fp", "fn", "tn",
                    F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def auc_rank(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC AUC by the rank-sum (Mann-Whitney) identity with average ranks for tied scores.

    Ranks come from the two-level prefix sums over distinct scores, so no global sort into
    one task is needed."""
    vc = (df.select(F.col(score).cast("double").alias("value"), (F.col(label) == 1).alias("_pos"))
          .groupBy("value").agg(F.count_if("_pos").alias("cp"), F.count(F.lit(1)).alias("c")))
    r = prefix_sums(vc.withColumn("_k", F.lit(0)), ["_k"], "value", ["c", "cp"], n_keys=1)
    avg_rank = F.col("cum_c") - F.col("c") + (F.col("c") + 1) / 2.0
    g = r.agg(F.sum(F.col("cp") * avg_rank).alias("rsum"), F.first("total_cp").alias("npos"),
              F.first("total_c").alias("n"))
    npos = F.col("npos").cast("double")
    nneg = (F.col("n") - F.col("npos")).cast("double")
    return g.select(F.try_divide(F.col("rsum") - npos * (npos + 1) / 2, npos * nneg).alias("auc"))


# ------------------------------------------------------------------------ MLlib helpers
def max_bins_for(df: DataFrame, cat_cols: list[str], floor: int = 32) -> int:
    """maxBins = max(32, largest category count): trees fail to fit otherwise."""
    if not cat_cols:
        return floor
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in cat_cols]).first()
    return max(floor, max(int(v) for v in exact))


# ------------------------------------------------------------------------ per-group MLlib models
def _group_dir(group_col: str) -> Column:
    """Folder name of a group: a hash of its typed value, so that "01" and "1" stay two groups
    and a null group has a folder of its own."""
    c = F.col(group_col)
    return F.coalesce(F.md5(c.cast("string")), F.lit("null"))


def grouped_mllib_fit(df: DataFrame, group_col: str, make_pipeline, label: str, out_dir: str,
                      groups: list, parallelism: int = 4) -> DataFrame:
    """One MLlib model (e.g. a forest) for each of the ``groups`` the caller names (None is the
    null group), each fitted as a distributed job on its group's rows, saved under ``out_dir``;
    returns (group, n_used, mse, model_path). The driver loops over the named groups; for a
    model of every group use :func:`grouped_linear_fit` (sufficient statistics).

    A group holding a third of all rows is trained by the whole cluster. Up to ``parallelism``
    fits run at once (concurrent jobs from driver threads, as ``CrossValidator(parallelism=...)``
    does), so small groups do not leave the cluster idle.
    """
    from concurrent.futures import ThreadPoolExecutor
    spark, kind = df.sparkSession, df.schema[group_col].dataType
    base = out_dir.rstrip("/")
    # one partitioned copy, so each fit reads only its group's directory (partition pruning)
    df.withColumn("_group_dir", _group_dir(group_col)).write.mode("overwrite").partitionBy("_group_dir").parquet(f"{base}/_data")
    data = spark.read.parquet(f"{base}/_data")
    names = spark.createDataFrame([(g,) for g in groups], f"{group_col} {kind.simpleString()}")
    names = names.select(group_col, _group_dir(group_col).alias("d")).collect()

    def fit_one(r):
        part = data.filter(F.col("_group_dir") == r["d"]).drop("_group_dir")
        model = make_pipeline().fit(part)
        m = regression_metrics(model.transform(part), label, "prediction").first()
        path = f"{base}/models/{r['d']}"
        model.write().overwrite().save(path)
        return (r[group_col], int(m["n"]), float(m["mse"]), path)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(fit_one, names))
    return spark.createDataFrame(rows, f"{group_col} {kind.simpleString()}, n_used long, mse double, model_path string")


def grouped_mllib_score(df: DataFrame, models: DataFrame, group_col: str, work_path: str | None = None) -> DataFrame:
    """Score each row with its group's saved model (one row of ``models`` per named group); rows
    of a group without a model are kept with a null prediction.

    ``df`` is first written once partitioned by the group, so each group's branch reads only its
    own directory: the input is read twice in total, not once per group."""
    from functools import reduce
    from pyspark.ml import PipelineModel
    from driftline.session import work_dir
    path = work_path or work_dir(df.sparkSession, "score-by-group")
    df.withColumn("_group_dir", _group_dir(group_col)).write.mode("overwrite").partitionBy("_group_dir").parquet(path)
    data = df.sparkSession.read.parquet(path)
    named = models.select(_group_dir(group_col).alias("d"), "model_path").collect()  # one row per named group
    parts = [data.filter(~F.col("_group_dir").isin([r["d"] for r in named])).withColumn("prediction", F.lit(None).cast("double"))]
    parts += [PipelineModel.load(r["model_path"]).transform(data.filter(F.col("_group_dir") == r["d"])) for r in named]
    return reduce(DataFrame.unionByName, [p.select(*df.columns, "prediction") for p in parts])
