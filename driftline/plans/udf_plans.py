"""Grouped training/scoring and the Arrow UDF surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.operators import models as MD
from driftline.operators import scoring as S
from driftline.plans.ml_fixtures import grouped_facts
from driftline.plans.registry import query, round_doubles
from driftline.sources.tables import Tables

FACTS_SQL = """(SELECT event_id, CAST(user_id % 12 AS INTEGER) AS user_group, value,
       CAST(event_id % 100 AS DOUBLE) / 10 AS tail, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       round(value * 2 + (event_id % 100) / 10.0, 6) AS label FROM events)"""

GROUPED_TRAIN_SQL = f"""WITH f AS {FACTS_SQL},
c AS (SELECT user_group, count(*) AS n_used, regr_slope(label, value) AS b, regr_intercept(label, value) AS a FROM f GROUP BY user_group)
SELECT user_group, n_used, round(a, 6) AS intercept, round(b, 6) AS coef_value,
       round(avg((label - (a + b * value)) * (label - (a + b * value))), 6) AS mse
FROM f JOIN c USING (user_group) GROUP BY user_group, n_used, a, b"""


def _fit(spark, sf_dir, feats=("value",)):
    facts = grouped_facts(Tables(spark, sf_dir))
    return facts, MD.grouped_linear_fit(facts, "user_group", list(feats), "label")


@query("grouped_train", GROUPED_TRAIN_SQL, "udf")
def grouped_train(spark, sf_dir):
    """One model per device from per-device sufficient statistics (applyInPandas on one row
    per device); the coefficients travel in the result row instead of a model file."""
    return round_doubles(_fit(spark, sf_dir)[1], 6)


GROUPED_MULTI_SQL = f"""WITH f AS {FACTS_SQL},
m AS (SELECT user_group, count(*) AS n_used, var_pop(value) AS a, covar_pop(value, k) AS b, var_pop(k) AS d,
      covar_pop(value, label) AS p, covar_pop(k, label) AS q, avg(value) AS m1, avg(k) AS m3, avg(label) AS my
      FROM f GROUP BY user_group),
c AS (SELECT *, (p * d - q * b) / (a * d - b * b) AS b1, (q * a - p * b) / (a * d - b * b) AS b3 FROM m)
SELECT user_group, n_used, round(b1, 5) AS coef_value, round(b3, 5) AS coef_k, round(my - b1 * m1 - b3 * m3, 4) AS intercept FROM c"""


@query("grouped_train_multi", GROUPED_MULTI_SQL, "udf")
def grouped_train_multi(spark, sf_dir):
    fit = _fit(spark, sf_dir, ("value", "k"))[1]
    return fit.select("user_group", "n_used", F.round("coef_value", 5).alias("coef_value"),
                      F.round("coef_k", 5).alias("coef_k"), F.round("intercept", 4).alias("intercept"))


GROUPED_SCORE_SQL = f"""WITH f AS {FACTS_SQL},
c AS (SELECT user_group, regr_slope(label, value) AS b, regr_intercept(label, value) AS a FROM f GROUP BY user_group)
SELECT event_id, round(a + b * value, 4) AS prediction FROM f JOIN c USING (user_group)"""


@query("grouped_linear_score", GROUPED_SCORE_SQL, "udf")
def grouped_linear_score(spark, sf_dir):
    """Score each fact with its device's model: join to the coefficient table + arithmetic."""
    facts, coefs = _fit(spark, sf_dir)
    # user_group = user_id % 12: at most 12 coefficient rows
    scored = MD.linear_score(facts, coefs, "user_group", ["value"], max_groups=12)
    return scored.select("event_id", F.round("prediction", 4).alias("prediction"))


@query("grouped_bundle_score", GROUPED_SCORE_SQL, "udf")
def grouped_bundle_score(spark, sf_dir):
    """Per-key model bundle routed by key inside an iterator pandas UDF (no grouping)."""
    facts, coefs = _fit(spark, sf_dir)
    bundle = S.bundle_from_frame(coefs, "user_group", ["value"], list(range(12)))
    scored = S.apply_bundle(facts, spark, bundle)
    return scored.select("event_id", F.round("prediction", 4).alias("prediction"))


# ----------------------------------------------------------------------------- model as a UDF
UNI_SQL = """WITH c AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 4) AS prediction FROM lineitem, c"""


def _uni_model(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    fit = MD.grouped_linear_fit(li.withColumn("_g", F.lit(0)), "_g", ["l_quantity"], "l_extendedprice")
    return li, S.model_from_row(fit.first(), ["l_quantity"])


@query("pandas_udf_score", UNI_SQL, "udf")
def pandas_udf_score(spark, sf_dir):
    li, model = _uni_model(spark, sf_dir)
    pred = S.scalar_udf(model)(F.col("l_quantity"))
    return li.select("l_orderkey", "l_linenumber", F.round(pred, 4).alias("prediction"))


@query("pandas_iter_score", UNI_SQL, "udf")
def pandas_iter_score(spark, sf_dir):
    li, model = _uni_model(spark, sf_dir)
    pred = S.iterator_udf(spark, model)(F.col("l_quantity"))
    return li.select("l_orderkey", "l_linenumber", F.round(pred, 4).alias("prediction"))


@query("map_in_pandas_score", UNI_SQL, "udf")
def map_in_pandas_score(spark, sf_dir):
    li, model = _uni_model(spark, sf_dir)
    out = S.map_in_pandas_score(li, model)
    return out.select("l_orderkey", "l_linenumber", F.round("prediction", 4).alias("prediction"))


@query("sql_udf_score", UNI_SQL, "udf")
def sql_udf_score(spark, sf_dir):
    li, model = _uni_model(spark, sf_dir)
    S.register_sql_model(spark, "price_model", model)
    li.createOrReplaceTempView("lineitem_for_scoring")
    return spark.sql("SELECT l_orderkey, l_linenumber, round(price_model(l_quantity), 4) AS prediction "
                     "FROM lineitem_for_scoring")


@query("pandas_api_value_counts", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1", "udf")
def pandas_api_value_counts(spark, sf_dir):
    import pyspark.pandas as ps
    ps.set_option("compute.default_index_type", "distributed")
    psdf = ps.read_parquet(Tables(spark, sf_dir).path("orders"), columns=["o_orderpriority"])
    vc = psdf["o_orderpriority"].value_counts()
    out = vc.to_frame().reset_index()
    out.columns = ["o_orderpriority", "count"]
    return out.to_spark()
