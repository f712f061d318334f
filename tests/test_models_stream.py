"""Sufficient-statistic fits, metrics, UDF scoring, streaming restart, model contract."""

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from driftline.operators import models as MD
from driftline.operators import scoring as S
from driftline.operators.contract import check_model_contract
from driftline.session import work_dir
from driftline.streaming import files as SF
from conftest import SF001


def test_grouped_fit_matches_numpy(spark):
    rng = np.random.default_rng(3)
    n = 600
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "x1": rng.normal(size=n), "x2": rng.normal(size=n)})
    pdf["y"] = 1.5 + 2 * pdf.x1 - 3 * pdf.x2 + pdf.g + rng.normal(scale=0.1, size=n)
    fit = {r["g"]: r for r in MD.grouped_linear_fit(spark.createDataFrame(pdf), "g", ["x1", "x2"], "y").collect()}
    for g, part in pdf.groupby("g"):
        X = np.column_stack([np.ones(len(part)), part.x1, part.x2])
        beta = np.linalg.lstsq(X, part.y, rcond=None)[0]
        np.testing.assert_allclose([fit[g]["intercept"], fit[g]["coef_x1"], fit[g]["coef_x2"]], beta, rtol=1e-8)
        assert fit[g]["n_used"] == len(part)


def test_metrics_agree_with_mllib(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").withColumn("p", F.col("l_quantity") * 1000.0)
    m = MD.regression_metrics(li, "l_extendedprice", "p").first()
    ev = RegressionEvaluator(labelCol="l_extendedprice", predictionCol="p")
    for k in ("rmse", "mse", "mae", "r2"):
        assert abs(m[k] - ev.setMetricName(k).evaluate(li)) <= 1e-9 * max(1, abs(m[k]))
    lab = li.select((F.col("l_extendedprice") > 30000).cast("double").alias("label"), F.col("l_quantity").cast("double").alias("s"))
    auc = MD.auc_rank(lab, "label", "s").first()["auc"]
    ev2 = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="s", metricName="areaUnderROC")
    assert abs(auc - ev2.evaluate(lab)) < 1e-6


def test_udf_flavours_agree(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    model = S.LinearModel(["l_quantity", "l_tax"], [2.0, -1.0], 0.5)
    a = li.select("l_orderkey", "l_linenumber", S.scalar_udf(model)("l_quantity", "l_tax").alias("p"))
    b = li.select("l_orderkey", "l_linenumber", S.iterator_udf(spark, model)("l_quantity", "l_tax").alias("p"))
    c = S.map_in_pandas_score(li, model, "p").select("l_orderkey", "l_linenumber", "p")
    exp = li.select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 2 - F.col("l_tax") + 0.5).alias("p"))
    for df in (a, b, c):
        assert df.exceptAll(exp).count() == 0


def test_stream_restart_exactly_once(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    src, out, ckpt = work_dir(spark, "s-in"), work_dir(spark, "s-out"), work_dir(spark, "s-ck")
    SF.write_chunks(ev.filter("event_id < 500"), src, 2, "ts")
    SF.run_until_done(SF.start_append(SF.read_stream(spark, src, SF.EVENTS_SCHEMA), out, ckpt))
    SF.write_chunks(ev.filter("event_id >= 500"), src, 2, "ts")
    prog = SF.run_until_done(SF.start_append(SF.read_stream(spark, src, SF.EVENTS_SCHEMA), out, ckpt))
    back = spark.read.parquet(out)
    assert back.count() == ev.count() and back.select("event_id").distinct().count() == ev.count()
    assert all(p["numInputRows"] >= 0 for p in prog)
    assert SF.stop_all(spark) == 0


def test_model_contract(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_quantity", "l_tax", "l_extendedprice")
    from pyspark.ml.feature import SQLTransformer
    model = SQLTransformer(statement="SELECT *, l_quantity * 2.0 AS prediction FROM __THIS__")
    ok = check_model_contract(model, li.drop("l_extendedprice"), {"l_quantity": "double", "l_tax": "double"}, "prediction", "double")
    assert ok["passed"]
    bad = check_model_contract(model, li.drop("l_extendedprice"), {"l_quantity": "double", "x": "double"}, "prediction", "double")
    assert not bad["passed"] and bad["missing"] == ["x"]


def test_approx_quantile_error_bound(spark):
    from driftline.operators import profile as P
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    exact = P.quantiles(li, ["l_extendedprice"], [0.5], ["m"]).first()["m"]
    approx = P.approx_quantiles(li, ["l_extendedprice"], [0.5], accuracy=100).first()["quantiles"][0]
    n = li.count()
    rank = li.filter(F.col("l_extendedprice") <= approx).count()
    assert abs(rank - 0.5 * n) <= n / 100 + 1
    assert exact > 0


def test_feature_importances_sum_to_one(spark):
    import __spark_entry__ as E
    imp = E.queries()["feature_importance"](spark, SF001).collect()
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-9


def test_stream_progress_then_stop_all(spark):
    """A continuously triggered stream: wait for N progress reports, then stop every stream."""
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    src, out, ckpt = work_dir(spark, "p-in"), work_dir(spark, "p-out"), work_dir(spark, "p-ck")
    SF.write_chunks(ev, src, 3, "ts")
    q = SF.start_append(SF.read_stream(spark, src, SF.EVENTS_SCHEMA), out, ckpt, available_now=False,
                        interval="1 second")
    prog = SF.wait_for_progress(q, 3, timeout_s=300)
    assert len(prog) >= 3
    assert SF.stop_all(spark) == 1 and not q.isActive
    assert spark.read.parquet(out).count() == ev.count()


def test_run_log_roundtrip(spark):
    """Runs logged as rows come back one row per run with params / tags / metrics maps;
    search by param, best run per group and the parent/child tree."""
    from driftline.operators.runlog import RunLog
    log = RunLog(spark, work_dir(spark, "runlog-test"))
    runs = spark.createDataFrame([
        ("p", None, "exp", "2024-01-01 00:00:00", "2024-01-01 01:00:00", {"data_version": "1"}, {"role": "parent"}, {"n": 3.0}),
        ("c1", "p", "exp", "2024-01-01 00:10:00", "2024-01-01 00:20:00", {"data_version": "1", "depth": "2"}, {"device": "a"}, {"mse": 2.5}),
        ("c2", "p", "exp", "2024-01-01 00:30:00", "2024-01-01 00:40:00", {"data_version": "1", "depth": "5"}, {"device": "b"}, {"mse": 1.5}),
    ], "run_id string, parent_run_id string, experiment string, start_time string, end_time string, "
       "params map<string,string>, tags map<string,string>, metrics map<string,double>")
    runs = runs.withColumn("start_time", F.col("start_time").cast("timestamp")).withColumn("end_time", F.col("end_time").cast("timestamp"))
    log.log(runs)
    back = {r["run_id"]: r for r in log.runs().collect()}
    assert set(back) == {"p", "c1", "c2"}
    assert back["c1"]["params"] == {"data_version": "1", "depth": "2"} and back["c2"]["metrics"] == {"mse": 1.5}
    assert back["c1"]["tags"] == {"device": "a"} and back["c1"]["parent_run_id"] == "p"
    found = [r["run_id"] for r in log.search_runs("params['depth'] = '5'").collect()]
    assert found == ["c2"]
    newest = [r["run_id"] for r in log.search_runs("parent_run_id IS NOT NULL").collect()]
    assert newest == ["c2", "c1"]


def test_param_grid_cv_table(spark):
    """Grid depth {2,5} x trees {5,10}, 3 hash folds: one average metric per grid point."""
    import __spark_entry__ as E
    out = E.queries()["cv_grid_table"](spark, SF001).collect()
    assert sorted((r["max_depth"], r["num_trees"]) for r in out) == [(2, 5), (2, 10), (5, 5), (5, 10)]
    assert all(r["avg_rmse"] > 0 for r in out)
