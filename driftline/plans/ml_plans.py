"""Feature engineering, MLlib models, evaluation and tuning."""

from __future__ import annotations

import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (Imputer, OneHotEncoder, RFormula, SQLTransformer, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from driftline.functions import hashing as H
from driftline.operators import models as MD
from driftline.operators import profile as P
from driftline.operators import trees as TR
from driftline.operators import tuning as TU
from driftline.plans.fixtures import LINEITEM_NULLS_SQL, lineitem_nulls
from driftline.plans.ml_fixtures import listings
from driftline.plans.registry import query, round_doubles
from driftline.session import work_dir
from driftline.sources.tables import Tables

NUM = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
CAT = ["l_returnflag", "l_linestatus", "p_brand", "p_type"]
LABEL = "l_extendedprice"
HASH80 = "(CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) % 100) < 80"


def _split(df, key="l_orderkey"):
    return H.hash_split(df, key, 80)


def _listings(spark, sf_dir):
    return listings(Tables(spark, sf_dir))


# ----------------------------------------------------------------------------- imputation / encoding
@query("impute_median_exact", f"""WITH s AS ({LINEITEM_NULLS_SQL}),
m AS (SELECT quantile_cont(l_discount, 0.5) AS md, quantile_cont(l_tax, 0.5) AS mt FROM s)
SELECT l_orderkey, l_linenumber, round(coalesce(l_discount, md), 6) AS l_discount, round(coalesce(l_tax, mt), 6) AS l_tax,
       CASE WHEN l_discount IS NULL THEN 1.0 ELSE 0.0 END AS l_discount_na,
       CASE WHEN l_tax IS NULL THEN 1.0 ELSE 0.0 END AS l_tax_na FROM s, m""", "ml")
def impute_median_exact(spark, sf_dir):
    from driftline.operators.cleaning import impute_exact_median
    li = lineitem_nulls(Tables(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return round_doubles(impute_exact_median(li, ["l_discount", "l_tax"]), 6)


@query("impute_mean", f"""WITH s AS ({LINEITEM_NULLS_SQL}), m AS (SELECT avg(l_discount) AS md, avg(l_tax) AS mt FROM s)
SELECT l_orderkey, l_linenumber, round(coalesce(l_discount, md), 6) AS l_discount, round(coalesce(l_tax, mt), 6) AS l_tax FROM s, m""",
       "ml")
def impute_mean(spark, sf_dir):
    li = lineitem_nulls(Tables(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    model = Imputer(strategy="mean", inputCols=["l_discount", "l_tax"], outputCols=["l_discount", "l_tax"]).fit(li)
    return round_doubles(model.transform(li), 6)


@query("impute_median_mllib", f"""SELECT feature, count(value) AS n, count(*) - count(value) AS n_filled, true AS within
FROM (SELECT * FROM (SELECT l_discount, l_tax FROM ({LINEITEM_NULLS_SQL})) UNPIVOT INCLUDE NULLS (value FOR feature IN (l_discount, l_tax)))
GROUP BY feature""", "ml")
def impute_median_mllib(spark, sf_dir):
    """MLlib's Imputer(median): one quantile sketch per column. Returned with it: the rows it fills, and
    whether the surrogate's rank is within the sketch's relative error of the middle."""
    cols = ["l_discount", "l_tax"]
    li = lineitem_nulls(Tables(spark, sf_dir)).select(*cols)
    imputer = Imputer(strategy="median", inputCols=cols, outputCols=cols)
    found = imputer.fit(li).surrogateDF.first()  # one value per column
    parts = []
    for c in cols:
        n, below, upto = F.count(c), F.count_if(F.col(c) < F.lit(found[c])), F.count_if(F.col(c) <= F.lit(found[c]))
        slack = imputer.getRelativeError() * n + 1
        parts.append(F.struct(F.lit(c).alias("feature"), n.alias("n"), F.count_if(F.col(c).isNull()).alias("n_filled"),
                              ((below <= n / 2 + slack) & (upto >= n / 2 - slack)).alias("within")))
    return li.agg(F.explode(F.array(*parts)).alias("r")).select("r.*")


@query("string_index", """SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS DOUBLE) AS brand_idx, count(*) AS n
FROM part GROUP BY p_brand""", "ml")
def string_index(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    idx = StringIndexer(inputCol="p_brand", outputCol="brand_idx", handleInvalid="skip").fit(part)
    return idx.transform(part).groupBy("p_brand", "brand_idx").agg(F.count(F.lit(1)).alias("n"))


@query("one_hot_long", """WITH i AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS idx, count(*) OVER () AS k
  FROM part GROUP BY p_brand)
SELECT p_partkey, CAST(CASE WHEN idx < k - 1 THEN idx END AS DOUBLE) AS active, CAST(k - 1 AS INTEGER) AS width
FROM part JOIN i USING (p_brand)""", "ml")
def one_hot_long(spark, sf_dir):
    part = Tables(spark, sf_dir).part.select("p_partkey", "p_brand")
    pipe = Pipeline(stages=[StringIndexer(inputCol="p_brand", outputCol="bi", handleInvalid="skip"),
                            OneHotEncoder(inputCols=["bi"], outputCols=["oh"], dropLast=True)]).fit(part)
    arr = vector_to_array(F.col("oh"))
    pos = F.array_position(arr, F.lit(1.0).cast("double"))
    return pipe.transform(part).select("p_partkey", F.when(pos > 0, pos - 1).cast("double").alias("active"),
                                       F.size(arr).alias("width"))


def _assembled(spark, sf_dir):
    df = _listings(spark, sf_dir)
    idx = [f"{c}_idx" for c in CAT]
    stages = [StringIndexer(inputCols=CAT, outputCols=idx, handleInvalid="skip"),
              OneHotEncoder(inputCols=idx, outputCols=[f"{c}_oh" for c in CAT]),
              VectorAssembler(inputCols=[f"{c}_oh" for c in CAT] + NUM, outputCol="features")]
    return Pipeline(stages=stages), df


# one-hot drops the last category of each of the 4 string columns; 5 numeric columns pass as is
WIDTH_SQL = """WITH l AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT CAST(count(DISTINCT l_returnflag) + count(DISTINCT l_linestatus) + count(DISTINCT p_brand) + count(DISTINCT p_type) - 4 + 5
            AS INTEGER) AS width, count(*) AS count FROM l"""


@query("assembled_size", WIDTH_SQL, "ml")
def assembled_size(spark, sf_dir):
    pipe, df = _assembled(spark, sf_dir)
    out = pipe.fit(df).transform(df)
    return out.select(F.size(vector_to_array("features")).alias("width")).groupBy("width").count()


@query("rformula_width", WIDTH_SQL, "ml")
def rformula_width(spark, sf_dir):
    df = _listings(spark, sf_dir).select(*CAT, *NUM, LABEL, "l_orderkey", "l_linenumber", "l_partkey")
    rf = RFormula(formula=f"{LABEL} ~ . - l_orderkey - l_linenumber - l_partkey", featuresCol="features", labelCol="label")
    out = rf.fit(df).transform(df)
    return out.select(F.size(vector_to_array("features")).alias("width")).groupBy("width").count()


# ----------------------------------------------------------------------------- regression models
@query("linreg_univariate", """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""", "ml")
def linreg_univariate(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_quantity", LABEL)
    va = VectorAssembler(inputCols=["l_quantity"], outputCol="features")
    m = LinearRegression(featuresCol="features", labelCol=LABEL, solver="normal").fit(va.transform(li))
    coef = m.coefficients.toArray().tolist()
    # the fitted model is two scalars; return them next to the training row count they came from
    return li.agg(F.count(F.lit(1)).alias("_n")).select(F.round(F.lit(coef[0]), 4).alias("slope"),
                                                         F.round(F.lit(m.intercept), 4).alias("intercept"))


LINREG2_SQL = """WITH s AS (SELECT l_quantity AS x1, p_retailprice AS x2, l_extendedprice AS y
  FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, covar_pop(x1, x1) AS s11, covar_pop(x2, x2) AS s22,
             covar_pop(x1, x2) AS s12, covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y FROM s),
b AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2,
             m1, m2, my FROM c)
SELECT round(b1, 4) AS coef_l_quantity, round(b2, 4) AS coef_p_retailprice, round(my - b1 * m1 - b2 * m2, 3) AS intercept FROM b"""


@query("linreg_multi", LINREG2_SQL, "ml")
def linreg_multi(spark, sf_dir):
    df = _listings(spark, sf_dir).select("l_quantity", "p_retailprice", LABEL)
    va = VectorAssembler(inputCols=["l_quantity", "p_retailprice"], outputCol="features")
    m = LinearRegression(featuresCol="features", labelCol=LABEL, solver="normal").fit(va.transform(df))
    c = m.coefficients.toArray().tolist()
    return df.agg(F.count(F.lit(1)).alias("_n")).select(
        F.round(F.lit(c[0]), 4).alias("coef_l_quantity"), F.round(F.lit(c[1]), 4).alias("coef_p_retailprice"),
        F.round(F.lit(m.intercept), 3).alias("intercept"))


@query("linreg_sufficient_stats", LINREG2_SQL, "ml")
def linreg_sufficient_stats(spark, sf_dir):
    """Same fit from one covariance aggregate + a 2x2 solve (no iterative solver)."""
    df = _listings(spark, sf_dir).select("l_quantity", "p_retailprice", LABEL).withColumn("_g", F.lit(0))
    fit = MD.grouped_linear_fit(df, "_g", ["l_quantity", "p_retailprice"], LABEL)
    return fit.select(F.round("coef_l_quantity", 4).alias("coef_l_quantity"),
                      F.round("coef_p_retailprice", 4).alias("coef_p_retailprice"), F.round("intercept", 3).alias("intercept"))


def _fit_eval(spark, sf_dir, estimator, log_label=False):
    pipe, df = _assembled(spark, sf_dir)
    if log_label:
        df = df.withColumn("label", F.log(LABEL))
    else:
        df = df.withColumn("label", F.col(LABEL))
    train, test = _split(df)
    model = Pipeline(stages=[*pipe.getStages(), estimator]).fit(train)
    pred = model.transform(test)
    if log_label:
        pred = pred.withColumn("prediction", F.exp("prediction"))
    return model, pred


RIDGE_ALPHA = 0.9
RIDGE_SQL = f"""WITH s AS (SELECT l_quantity AS x1, l_discount AS x2, l_extendedprice AS y, {HASH80.format(k='l_orderkey')} AS is_train FROM lineitem),
m AS (SELECT count(*) * var_pop(x1) + {RIDGE_ALPHA} AS a, count(*) * covar_pop(x1, x2) AS b, count(*) * var_pop(x2) + {RIDGE_ALPHA} AS d,
      count(*) * covar_pop(x1, y) AS p, count(*) * covar_pop(x2, y) AS q, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM s WHERE is_train),
c AS (SELECT (p * d - q * b) / (a * d - b * b) AS b1, (q * a - p * b) / (a * d - b * b) AS b2, m1, m2, my FROM m)
SELECT count(*) AS n, round(max(b1), 4) AS coef_quantity, round(max(b2), 2) AS coef_discount,
       round(sqrt(avg((y - (my + b1 * (x1 - m1) + b2 * (x2 - m2))) ** 2)), 2) AS rmse FROM s, c WHERE NOT is_train"""


@query("ridge", RIDGE_SQL, "ml")
def ridge(spark, sf_dir):
    """Ridge with the penalty alpha on raw features (intercept free), from one pass of moments."""
    train, test = _split(Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_quantity", "l_discount", LABEL))
    x = ["l_quantity", "l_discount"]
    fit = MD.grouped_linear_fit(train.withColumn("_g", F.lit(0)), "_g", x, LABEL, reg=RIDGE_ALPHA)
    pred = MD.linear_score(test.withColumn("_g", F.lit(0)), fit, "_g", x, max_groups=1)
    err = F.col(LABEL) - F.col("prediction")
    coefs = fit.select("_g", F.round("coef_l_quantity", 4).alias("coef_quantity"), F.round("coef_l_discount", 2).alias("coef_discount"))
    out = pred.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(err * err)), 2).alias("rmse"))
    return out.join(coefs, "_g").drop("_g")


@query("log_target_metrics", None, "ml")
def log_target_metrics(spark, sf_dir):
    _, pred = _fit_eval(spark, sf_dir, LinearRegression(featuresCol="features", labelCol="label"), log_label=True)
    return MD.regression_metrics(pred, LABEL, "prediction")


@query("log_target_univariate", f"""WITH s AS (SELECT l_quantity AS x, l_extendedprice AS y, {HASH80.format(k='l_orderkey')} AS is_train FROM lineitem),
c AS (SELECT regr_slope(ln(y), x) AS b, regr_intercept(ln(y), x) AS a FROM s WHERE is_train),
p AS (SELECT y, exp(a + b * x) AS p FROM s, c WHERE NOT is_train)
SELECT count(*) AS n, round(sqrt(avg(pow(y - p, 2))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae, round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)), 8) AS r2 FROM p""", "ml")
def log_target_univariate(spark, sf_dir):
    """Linear regression of the log label on one column, scored on the label's own scale."""
    train, test = _split(Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_quantity", LABEL).withColumn("label", F.log(LABEL)))
    stages = [VectorAssembler(inputCols=["l_quantity"], outputCol="features"), LinearRegression(solver="normal")]
    pred = Pipeline(stages=stages).fit(train).transform(test).withColumn("prediction", F.exp("prediction"))
    m = MD.regression_metrics(pred, LABEL, "prediction")
    return m.select("n", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 8).alias("r2"))


@query("baseline_rmse", f"""WITH s AS (SELECT l_extendedprice AS y, {HASH80.format(k='l_orderkey')} AS is_train FROM lineitem),
t AS (SELECT avg(y) AS mu, quantile_cont(y, 0.5) AS med FROM s WHERE is_train)
SELECT round(sqrt(avg((y - mu) * (y - mu))), 4) AS rmse_mean, round(sqrt(avg((y - med) * (y - med))), 4) AS rmse_median
FROM s, t WHERE NOT is_train""", "ml")
def baseline_rmse(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", LABEL)
    train, test = _split(li)
    mu = train.agg(F.avg(LABEL)).first()[0]
    md = P.quantiles(train, [LABEL], [0.5], ["p50"]).first()["p50"]
    return test.agg(F.round(F.sqrt(F.avg(F.pow(F.col(LABEL) - F.lit(mu), 2))), 4).alias("rmse_mean"),
                    F.round(F.sqrt(F.avg(F.pow(F.col(LABEL) - F.lit(md), 2))), 4).alias("rmse_median"))


def _tree_frame(spark, sf_dir):
    df = TU.training_table(_listings(spark, sf_dir).select("l_orderkey", LABEL, *CAT, *NUM), "listings")  # joined once
    idx = [f"{c}_idx" for c in CAT]
    si = StringIndexer(inputCols=CAT, outputCols=idx, handleInvalid="skip")
    va = VectorAssembler(inputCols=idx + NUM, outputCol="features")
    return df, si, va, MD.max_bins_for(df, CAT)


@query("dtree_bounds", f"""SELECT max(l_extendedprice) FILTER ({HASH80.format(k='l_orderkey')}) AS train_max, true AS bounded,
       count(*) FILTER (NOT {HASH80.format(k='l_orderkey')}) AS n_test FROM lineitem JOIN part ON l_partkey = p_partkey""", "ml")
def dtree_bounds(spark, sf_dir):
    df, si, va, bins = _tree_frame(spark, sf_dir)
    train, test = _split(df)
    model = Pipeline(stages=[si, va, DecisionTreeRegressor(labelCol=LABEL, maxBins=bins, maxDepth=5)]).fit(train)
    pred = model.transform(test)
    tmax = train.agg(F.max(LABEL)).first()[0]
    return pred.agg(F.lit(tmax).alias("train_max"), (F.max("prediction") <= F.lit(tmax)).alias("bounded"),
                    F.count(F.lit(1)).alias("n_test"))


@query("rf_regression", None, "ml")
def rf_regression(spark, sf_dir):
    df, si, va, bins = _tree_frame(spark, sf_dir)
    train, test = _split(df)
    model = Pipeline(stages=[si, va, RandomForestRegressor(labelCol=LABEL, maxBins=bins, numTrees=10, maxDepth=5,
                                                           seed=42)]).fit(train)
    return MD.regression_metrics(model.transform(test), LABEL, "prediction")


@query("rf_classifier", None, "ml")
def rf_classifier(spark, sf_dir):
    df, si, va, bins = _tree_frame(spark, sf_dir)
    df = df.withColumn("label", (F.col(LABEL) >= 50000).cast("double"))
    train, test = _split(df)
    _, [train, test] = TU.prepared([si, va], train, [test], ["label"])
    rf = RandomForestClassifier(labelCol="label", maxBins=bins, numTrees=10, maxDepth=5, seed=42)
    pred = rf.fit(train).transform(test)
    auc = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC").evaluate(pred)
    return MD.confusion_metrics(pred, "label", "prediction").withColumn("area_under_roc", F.lit(auc))


@query("gbt_regression", None, "ml")
def gbt_regression(spark, sf_dir):
    df, si, va, bins = _tree_frame(spark, sf_dir)
    df = df.withColumn("label", F.log(LABEL))
    train, test = _split(df)
    gbt = TR.GBTRegressor(labelCol="label", maxIter=100, stepSize=0.1, maxDepth=4, maxBins=bins, seed=42)
    pred = Pipeline(stages=[si, va, gbt]).fit(train).transform(test).withColumn("prediction", F.exp("prediction"))
    return MD.regression_metrics(pred, LABEL, "prediction")


@query("feature_importance", None, "ml")
def feature_importance(spark, sf_dir):
    df, si, va, bins = _tree_frame(spark, sf_dir)
    model = Pipeline(stages=[si, va, RandomForestRegressor(labelCol=LABEL, maxBins=bins, numTrees=10, maxDepth=5,
                                                           seed=42)]).fit(df)
    imp = model.stages[-1].featureImportances.toArray().tolist()
    names = [f"{c}_idx" for c in CAT] + NUM
    # names x importances is one row per model input column (bounded by the schema)
    rows = spark.createDataFrame(list(zip(names, [float(v) for v in imp])), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature")


@query("model_roundtrip", """SELECT count(*) AS n, 0.0 AS max_abs_diff FROM lineitem JOIN part ON l_partkey = p_partkey""", "ml")
def model_roundtrip(spark, sf_dir):
    pipe, df = _assembled(spark, sf_dir)
    df = df.withColumn("label", F.col(LABEL))
    model = Pipeline(stages=[*pipe.getStages(), LinearRegression(featuresCol="features", labelCol="label")]).fit(df)
    path = work_dir(spark, "pipeline-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    # both models score the same rows in one pass (no join: lineitem has no unique row key)
    a = model.transform(df).select(*df.columns, F.col("prediction").alias("p1"))
    b = loaded.transform(a).select("p1", F.col("prediction").alias("p2"))
    return b.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_diff"))


# ----------------------------------------------------------------------------- evaluation
FIXED_PRED_SQL = "(l_quantity * p_retailprice * 0.98 + 100)"


def _fixed_pred(spark, sf_dir):
    df = _listings(spark, sf_dir)
    return df.withColumn("prediction", F.col("l_quantity") * F.col("p_retailprice") * 0.98 + 100)


@query("regression_metrics", f"""SELECT count(*) AS n, round(sqrt(avg(pow(l_extendedprice - {FIXED_PRED_SQL}, 2))), 4) AS rmse,
       round(avg(pow(l_extendedprice - {FIXED_PRED_SQL}, 2)), 2) AS mse, round(avg(abs(l_extendedprice - {FIXED_PRED_SQL})), 4) AS mae,
       round(1 - sum(pow(l_extendedprice - {FIXED_PRED_SQL}, 2)) / (var_pop(l_extendedprice) * count(*)), 8) AS r2
FROM lineitem JOIN part ON l_partkey = p_partkey""", "ml")
def regression_metrics(spark, sf_dir):
    m = MD.regression_metrics(_fixed_pred(spark, sf_dir), LABEL, "prediction")
    return m.select("n", F.round("rmse", 4).alias("rmse"), F.round("mse", 2).alias("mse"), F.round("mae", 4).alias("mae"),
                    F.round("r2", 8).alias("r2"))


def _sig(col: str, digits: int = 9) -> str:
    return f"round({col}, {digits} - CAST(ceil(log10(abs({col}))) AS INTEGER))"


@query("regression_evaluator", f"""WITH e AS (SELECT l_extendedprice - {FIXED_PRED_SQL} AS r, l_extendedprice AS y
                                            FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT sqrt(avg(r * r)) AS rmse, avg(r * r) AS mse, avg(abs(r)) AS mae,
             1 - sum(r * r) / (var_pop(y) * count(*)) AS r2 FROM e)
SELECT 'rmse' AS metric, {_sig('rmse')} AS value FROM m UNION ALL SELECT 'mse', {_sig('mse')} FROM m
UNION ALL SELECT 'mae', {_sig('mae')} FROM m UNION ALL SELECT 'r2', {_sig('r2')} FROM m""", "ml")
def regression_evaluator(spark, sf_dir):
    """MLlib's RegressionEvaluator on the same predictions (one job per metric); values kept
    to 9 significant digits so both engines hash the same digits."""
    import math
    pred = _fixed_pred(spark, sf_dir)
    ev = RegressionEvaluator(labelCol=LABEL, predictionCol="prediction")
    vals = {m: ev.setMetricName(m).evaluate(pred) for m in ("rmse", "mse", "mae", "r2")}
    sig = {k: round(v, 9 - math.ceil(math.log10(abs(v)))) if v else 0.0 for k, v in vals.items()}
    return spark.createDataFrame([(k, float(v)) for k, v in sig.items()], "metric string, value double")


CONF_SQL = """WITH s AS (SELECT CAST(l_extendedprice >= 50000 AS INTEGER) AS y,
  CAST(l_quantity >= 30 AS INTEGER) AS p FROM lineitem),
c AS (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn FROM s)
SELECT tp, fp, fn, tn, round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 8) AS accuracy,
       round(CAST(tp AS DOUBLE) / (tp + fp), 8) AS "precision", round(CAST(tp AS DOUBLE) / (tp + fn), 8) AS recall,
       round(2.0 * tp / (2 * tp + fp + fn), 8) AS f1 FROM c"""


@query("confusion_metrics", CONF_SQL, "ml")
def confusion_metrics(spark, sf_dir):
    df = Tables(spark, sf_dir).lineitem.select((F.col(LABEL) >= 50000).cast("int").alias("y"),
                                               (F.col("l_quantity") >= 30).cast("int").alias("p"))
    return round_doubles(MD.confusion_metrics(df, "y", "p"), 8)


AUC_SQL = """WITH s AS (SELECT CAST(l_extendedprice >= 50000 AS INTEGER) AS y, l_quantity AS score FROM lineitem),
r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM s)
SELECT round((sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
       / (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0)), 8) AS auc FROM r"""


@query("auc_rank", AUC_SQL, "ml")
def auc_rank(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select((F.col(LABEL) >= 50000).cast("int").alias("y"), F.col("l_quantity").alias("score"))
    return round_doubles(MD.auc_rank(li, "y", "score"), 8)


# ----------------------------------------------------------------------------- tuning
HASH_SQL = "CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8) AS BIGINT)"


@query("cv_grid_table", None, "tuning")
def cv_grid_table(spark, sf_dir):
    df, si, va, bins = _tree_frame(spark, sf_dir)
    df = df.select(LABEL, *CAT, *NUM, H.fold_col("l_orderkey", 3).alias("fold"))
    rf = TR.RandomForestRegressor(labelCol=LABEL, maxBins=bins, seed=42)
    grid = ParamGridBuilder().addGrid(rf.maxDepth, [2, 5]).addGrid(rf.numTrees, [5, 10]).build()
    ev = RegressionEvaluator(labelCol=LABEL, metricName="rmse")
    cv = TU.FoldwiseCrossValidator([si, va], df, [LABEL], estimator=rf, estimatorParamMaps=grid, evaluator=ev,
                                   foldCol="fold", parallelism=TU.trials_at_once(df, 4), seed=42)
    model = cv.fit_rows()
    rows = [(int(pm[rf.maxDepth]), int(pm[rf.numTrees]), float(m)) for pm, m in zip(grid, model.avgMetrics)]
    return spark.createDataFrame(rows, "max_depth int, num_trees int, avg_rmse double")


SEARCH_SPACE = {"reg": ("loguniform", 1e-3, 1e3)}
GRID = [0.0, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]
TRIAL_COLS = ["l_quantity", "l_discount"]


def _trials_sql(regs: list[float]) -> str:
    """Ridge with two columns in closed form, per candidate and held-out fold."""
    cands = ", ".join(f"({i}, {r!r})" for i, r in enumerate(regs))
    return f"""
WITH s AS (SELECT l_quantity AS x1, l_discount AS x2, l_extendedprice AS y, {HASH_SQL} % 3 AS f FROM lineitem JOIN part ON l_partkey = p_partkey),
g AS (SELECT g, count(*) AS n, var_pop(x1) AS v1, var_pop(x2) AS v2, covar_pop(x1, x2) AS v12, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2,
             avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM s, range(0, 3) AS t(g) WHERE f <> g GROUP BY g),
c AS (SELECT g, trial_id, reg, m1, m2, my, (n * c1 * (n * v2 + reg) - n * c2 * n * v12) / ((n * v1 + reg) * (n * v2 + reg) - n * v12 * n * v12) AS b1,
             (n * c2 * (n * v1 + reg) - n * c1 * n * v12) / ((n * v1 + reg) * (n * v2 + reg) - n * v12 * n * v12) AS b2
      FROM g, (VALUES {cands}) AS v(trial_id, reg)),
e AS (SELECT g, trial_id, any_value(reg) AS reg, sum(pow(y - my - b1 * (x1 - m1) - b2 * (x2 - m2), 2)) AS sse, count(*) * var_pop(y) AS sst, count(*) AS n
      FROM s JOIN c ON f = g GROUP BY g, trial_id)
SELECT CAST(trial_id AS BIGINT) AS trial_id, round(any_value(CAST(reg AS DOUBLE)), 6) AS reg, round(avg(1 - sse / sst), 6) AS mean_r2, round(avg(sqrt(sse / n)), 4) AS mean_rmse,
       round(-avg(1 - sse / sst), 6) AS loss, CAST(count(*) AS INTEGER) AS n_folds FROM e GROUP BY trial_id"""


def _rounded_trials(out):
    return out.select("trial_id", F.round("reg", 6).alias("reg"), F.round("mean_r2", 6).alias("mean_r2"),
                      F.round("mean_rmse", 4).alias("mean_rmse"), F.round("loss", 6).alias("loss"), "n_folds").orderBy("loss")


@query("parallel_trials", _trials_sql([TU.sample_space(SEARCH_SPACE, r)["reg"] for r in [random.Random(42)] for _ in range(16)]), "tuning")
def parallel_trials(spark, sf_dir):
    df = _listings(spark, sf_dir)
    cands = TU.seeded_candidates(spark, SEARCH_SPACE, n=16, seed=42)
    return _rounded_trials(MD.cv_ridge_trials(df, TRIAL_COLS, LABEL, H.fold_col("l_orderkey", 3), 3, cands))


@query("random_search_table", None, "tuning")
def random_search_table(spark, sf_dir):
    df, si, va, bins = _tree_frame(spark, sf_dir)
    space = {"maxDepth": ("quniform", 2, 5, 1), "numTrees": ("quniform", 10, 100, 10)}
    return TU.random_search(spark, df, si, va, LABEL, space, n_trials=4, seed=42, max_bins=bins)


@query("leaderboard", None, "tuning")
def leaderboard(spark, sf_dir):
    df, si, va, bins = _tree_frame(spark, sf_dir)
    return TU.leaderboard(df, si, va, LABEL, bins)


@query("leaderboard_classes", f"""SELECT 6 AS n_trials, count(*) AS n_test, true AS beats_majority, true AS best_first, true AS model_agrees
FROM lineitem WHERE {HASH_SQL} % 100 >= 80""", "tuning")
def leaderboard_classes(spark, sf_dir):
    """Six classifiers of the return flag, ranked by log loss on held-out rows; the facts about the
    board that do not depend on the fits' arithmetic."""
    df, prepare = _flag_frame(spark, sf_dir)
    board, best, scores = TU.class_leaderboard(df, prepare, "flag", "l_orderkey")
    top = board.filter("rank = 1").first()
    majority = scores.filter(F.col("trial") == top["trial"]).groupBy("y").count().agg(F.max("count") / F.sum("count")).first()[0]
    test = H.hash_split(df, "l_orderkey", 80)[1]
    right = best.transform(test).agg(F.avg((F.col("prediction") == F.col("flag")).cast("double"))).first()[0]
    return board.agg(F.count(F.lit(1)).cast("int").alias("n_trials"), F.max("n").alias("n_test"),
                     (F.max("accuracy") >= F.lit(majority)).alias("beats_majority"),
                     (F.min("log_loss") == F.min_by("log_loss", "rank")).alias("best_first"),
                     F.lit(abs(right - top["accuracy"]) < 1e-9).alias("model_agrees"))


@query("leaderboard_class_scores", None, "tuning")
def leaderboard_class_scores(spark, sf_dir):
    """The board itself: accuracy, log loss, f1, precision and recall per classifier."""
    df, prepare = _flag_frame(spark, sf_dir)
    return round_doubles(TU.class_leaderboard(df, prepare, "flag", "l_orderkey")[0], 6)


def _flag_frame(spark, sf_dir):
    df = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
                                               F.datediff("l_shipdate", F.lit("1992-01-01")).cast("double").alias("ship_day"),
                                               (F.col("l_returnflag") != "N").cast("double").alias("flag"))
    return df, [VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax", "l_extendedprice", "ship_day"], outputCol="features")]


@query("search_adaptive", """SELECT 24 AS n_trials, count(*) AS n_rows, round(stddev_pop(l_extendedprice * (1 - l_discount)), 4) AS baseline_rmse,
       true AS beats_baseline, true AS no_worse_than_start FROM lineitem JOIN part ON l_partkey = p_partkey""", "tuning")
def search_adaptive(spark, sf_dir):
    """Adaptive search over the ridge penalty and the set of columns; a round of trials is solved from one
    aggregate's moments per fold."""
    df = _listings(spark, sf_dir).withColumn("net", F.col(LABEL) * (1 - F.col("l_discount")))
    every = ["p_size", "l_tax", "l_quantity", LABEL, "l_discount"]
    space = {"reg": ("loguniform", 1e-4, 1e5), "n_cols": ("quniform", 1, len(every), 1)}
    losses = MD.cv_ridge_losses(df, every, "net", H.fold_col("l_orderkey", 3))
    trials = TU.adaptive_search(space, lambda settings: [losses(s["reg"], every[:int(s["n_cols"])]) for s in settings], max_trials=24)
    best, start = min(x for _, x in trials), min(x for _, x in trials[:8])
    return df.agg(F.lit(len(trials)).alias("n_trials"), F.count(F.lit(1)).alias("n_rows"), F.round(F.stddev_pop("net"), 4).alias("baseline_rmse"),
                  (F.lit(best) < 0.5 * F.stddev_pop("net")).alias("beats_baseline"), F.lit(best <= start).alias("no_worse_than_start"))


PRE_POST_SQL = """
WITH s AS (SELECT l_quantity AS x1, p_retailprice AS x2, l_discount + l_tax AS x3, l_extendedprice AS y FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(y) AS my, var_pop(x1) AS a, var_pop(x2) AS e, var_pop(x3) AS i, covar_pop(x1, x2) AS b,
             covar_pop(x1, x3) AS c, covar_pop(x2, x3) AS f, covar_pop(x1, y) AS p, covar_pop(x2, y) AS q, covar_pop(x3, y) AS r FROM s),
d AS (SELECT *, a * (e * i - f * f) - b * (b * i - f * c) + c * (b * f - e * c) AS det FROM m),
w AS (SELECT *, (p * (e * i - f * f) - b * (q * i - f * r) + c * (q * f - e * r)) / det AS b1,
             (a * (q * i - f * r) - p * (b * i - f * c) + c * (b * r - q * c)) / det AS b2,
             (a * (e * r - q * f) - b * (b * r - q * c) + p * (b * f - e * c)) / det AS b3 FROM d)
SELECT CASE WHEN my + b1 * (x1 - m1) + b2 * (x2 - m2) + b3 * (x3 - m3) > 50000 THEN 'premium' ELSE 'standard' END AS price_class, count(*) AS n
FROM s, w GROUP BY 1"""


@query("pipeline_pre_post", PRE_POST_SQL, "ml")
def pipeline_pre_post(spark, sf_dir):
    """Model with pre- and post-processing inside one pipeline (row-sum feature, threshold text)."""
    df = _listings(spark, sf_dir)
    pre = SQLTransformer(statement="SELECT *, l_discount + l_tax AS score_sum FROM __THIS__")
    va = VectorAssembler(inputCols=["l_quantity", "p_retailprice", "score_sum"], outputCol="features")
    lr = LinearRegression(featuresCol="features", labelCol=LABEL)
    post = SQLTransformer(statement="SELECT *, CASE WHEN prediction > 50000 THEN 'premium' ELSE 'standard' END "
                                    "AS price_class FROM __THIS__")
    model = Pipeline(stages=[pre, va, lr, post]).fit(df)
    return model.transform(df).groupBy("price_class").agg(F.count(F.lit(1)).alias("n"))


@query("cv_in_pipeline_table", None, "tuning")
def cv_in_pipeline_table(spark, sf_dir):
    """CV placed inside the pipeline: indexer/assembler fitted once on all rows (faster, but the
    folds see category statistics of their held-out rows); kept beside the leak-safe default."""
    df, si, va, bins = _tree_frame(spark, sf_dir)
    _, [table] = TU.prepared([si, va], df.withColumn("fold", H.fold_col("l_orderkey", 3)), [], [LABEL, "fold"])
    rf = TR.RandomForestRegressor(labelCol=LABEL, maxBins=bins, seed=42)
    grid = ParamGridBuilder().addGrid(rf.maxDepth, [2, 5]).addGrid(rf.numTrees, [5, 10]).build()
    cv = CrossValidator(estimator=rf, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol=LABEL),
                        foldCol="fold", parallelism=TU.trials_at_once(table, 4), seed=42)
    model = cv.fit(table)
    rows = [(int(pm[rf.maxDepth]), int(pm[rf.numTrees]), float(m)) for pm, m in zip(grid, model.avgMetrics)]
    return spark.createDataFrame(rows, "max_depth int, num_trees int, avg_rmse double")


@query("grid_trials", _trials_sql(GRID), "tuning")
def grid_trials(spark, sf_dir):
    """Grid search of small models (one trial per task) from per-fold sufficient statistics."""
    df = _listings(spark, sf_dir)
    cands = spark.createDataFrame(list(enumerate(GRID)), "trial_id long, reg double")
    return _rounded_trials(MD.cv_ridge_trials(df, TRIAL_COLS, LABEL, H.fold_col("l_orderkey", 3), 3, cands))


@query("multiclass_metrics", None, "ml")
def multiclass_metrics(spark, sf_dir):
    """Multi-class classification on vector features (embeddings -> label): f1, accuracy,
    weighted recall and log loss from MLlib's evaluator, on held-out rows."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    emb = Tables(spark, sf_dir).embeddings.select("vec_id", array_to_vector("embedding").alias("features"),
                                                  F.col("label").cast("double").alias("label"))
    train, test = H.hash_split(emb, "vec_id", 80)
    pred = LogisticRegression(maxIter=50, regParam=0.01).fit(train).transform(test)
    ev = MulticlassClassificationEvaluator(labelCol="label")
    vals = [(m, float(ev.setMetricName(m).evaluate(pred))) for m in ("f1", "accuracy", "weightedRecall", "logLoss")]
    return spark.createDataFrame(vals, "metric string, value double")
