"""Fits read tables that are written once; trials at once follow the rows; files of a clustering follow the rows."""

import os
import sys

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conftest import SF001  # noqa: E402
from driftline.operators import tuning as TU  # noqa: E402
from driftline.plans import ml_plans as MP  # noqa: E402
from driftline.sources import files as FL  # noqa: E402


def _rows(spark, n=900):
    c = F.when(F.col("id") % 7 < 3, "x").when(F.col("id") % 7 < 6, "y").otherwise("z")
    return spark.range(0, n, 1, 1).select("id", c.alias("c"), (F.col("id") % 11).cast("double").alias("a"), (F.col("id") % 3).cast("int").alias("fold"),
                                          ((F.col("id") % 11) * 2 + (F.col("id") % 7)).cast("double").alias("y"))


def _stages():
    return [StringIndexer(inputCols=["c"], outputCols=["c_idx"], handleInvalid="skip"), VectorAssembler(inputCols=["c_idx", "a"], outputCol="features")]


def _scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation ["), "Join" in plan


def test_tree_frame_is_joined_once(spark):
    df, *_ = MP._tree_frame(spark, SF001)
    assert _scans(df) == (1, False)
    assert df.count() == spark.read.parquet(f"{SF001}/lineitem.parquet").count()


def test_prepared_tables_keep_rows_and_categories(spark):
    df = _rows(spark)
    model, [train, test] = TU.prepared(_stages(), df.filter("id < 600"), [df.filter("id >= 600")], ["y"])
    want = model.transform(df.filter("id < 600")).select("y", "features").collect()
    assert train.collect() == want and test.count() == 300 and _scans(train) == (1, False)
    kinds = train.schema["features"].metadata["ml_attr"]["attrs"]
    assert kinds["nominal"][0]["vals"] == ["x", "y", "z"] and kinds["numeric"][0]["name"] == "a"


def test_fewer_trials_at_once_on_more_rows(spark, monkeypatch):
    monkeypatch.setattr(TU, "ROWS_AT_ONCE", 1000)
    assert [TU.trials_at_once(spark.range(n), 4) for n in (0, 100, 250, 400, 900, 5000)] == [4, 4, 4, 2, 1, 1]


def test_training_table_in_equal_files(spark, monkeypatch):
    monkeypatch.setattr(TU, "ROWS_PER_FILE", 100)
    t = TU.training_table(_rows(spark))
    assert FL.file_inventory(t).count() == 9 and t.count() == 900


def test_foldwise_cross_validation_equals_the_pipeline_inside(spark, monkeypatch):
    df = _rows(spark)
    dt = DecisionTreeRegressor(labelCol="y", seed=1)
    grid = ParamGridBuilder().addGrid(dt.maxDepth, [1, 3]).build()
    say = dict(estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y"), foldCol="fold", parallelism=2, seed=1)
    want = CrossValidator(estimator=Pipeline(stages=[*_stages(), dt]), **say).fit(df)
    fits = []
    fit = StringIndexer._fit
    monkeypatch.setattr(StringIndexer, "_fit", lambda self, d: fits.append(1) or fit(self, d))
    got = TU.FoldwiseCrossValidator(_stages(), df, ["y"], estimator=dt, **say).fit_rows()
    np.testing.assert_allclose(got.avgMetrics, want.avgMetrics, rtol=1e-12)
    assert got.bestModel.toDebugString.split("\n")[1:] == want.bestModel.stages[-1].toDebugString.split("\n")[1:]
    assert len(fits) == 4  # one per fold and one for the refit, whatever the grid


def test_leaderboards_and_searches_prepare_once(spark, monkeypatch):
    fits = []
    fit = StringIndexer._fit
    monkeypatch.setattr(StringIndexer, "_fit", lambda self, d: fits.append(1) or fit(self, d))
    df = _rows(spark).withColumnRenamed("id", "l_orderkey")
    board = TU.leaderboard(df, *_stages(), "y").collect()
    assert len(board) == 4 and sorted(r["rank"] for r in board) == [1, 2, 3, 4] and len(fits) == 1
    space = {"maxDepth": ("quniform", 1, 3, 1), "numTrees": ("quniform", 2, 4, 1)}
    rows = TU.random_search(spark, df, *_stages(), "y", space, n_trials=3).collect()
    assert len(rows) == 3 and sum(r["is_best"] for r in rows) == 1 and len(fits) == 3  # for the trials, then for the refit


def test_classifier_reads_written_features(spark, monkeypatch):
    seen = []
    written = TU.training_table
    monkeypatch.setattr(TU, "training_table", lambda df, *a: seen.append(df.columns) or written(df, *a))
    rows = MP.rf_classifier(spark, SF001).collect()
    assert len(rows) == 1 and len(seen) == 3 and all("features" in c for c in seen[1:])


def test_clustering_makes_more_files_of_more_rows(spark, tmp_uri, monkeypatch):
    df = spark.range(0, 8000, 1, 4).select("id", (F.col("id") % 97).alias("a"), (F.col("id") % 89).alias("b"))
    FL.clustered_rewrite(df, f"{tmp_uri}/few", ["a", "b"], 4)
    assert FL.file_inventory(spark.read.parquet(f"{tmp_uri}/few")).count() == 4
    monkeypatch.setattr(FL, "ROWS_PER_FILE", 500)
    FL.clustered_rewrite(df, f"{tmp_uri}/many", ["a", "b"], 4)
    back = spark.read.parquet(f"{tmp_uri}/many")
    assert back.exceptAll(df).count() == 0 and back.count() == 8000
    files = FL.file_inventory(back)
    assert files.count() == 16 and files.agg(F.max("n_rows")).first()[0] < 1000
