"""Run log, forecasting backtest, streaming error-rate detector, domain classifier and
per-period model monitoring (SURVEY §2.14, M20, M26, Q10, Q18, Q19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.operators import detectors as DT
from driftline.operators import drift
from driftline.operators import forecast as FC
from driftline.operators import models as MD
from driftline.operators import monitor as M
from driftline.operators.runlog import RunLog
from driftline.plans.fixtures import LI_NUM, SPLIT_DATE
from driftline.plans.ml_fixtures import grouped_facts
from driftline.plans.registry import query, round_doubles
from driftline.session import work_dir
from driftline.sources.tables import Tables

# ----------------------------------------------------------------------------- run log
CUTOFF = "2024-01-15"


def _runlog(spark, sf_dir) -> RunLog:
    """Training runs per user group on two data versions (events before the cutoff, all events),
    logged from Spark results: a parent run per version and one child run per group."""
    ev = Tables(spark, sf_dir).events.select("event_id", "ts")
    facts = grouped_facts(Tables(spark, sf_dir)).join(ev, "event_id")
    log = RunLog(spark, work_dir(spark, "runlog"))
    for version, data in ((1, facts.filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))), (2, facts)):
        fit = MD.grouped_linear_fit(data, "user_group", ["value"], "label")
        end = data.groupBy("user_group").agg(F.max("ts").cast("timestamp").alias("end_time"))
        child = fit.join(end, "user_group").select(
            F.concat(F.lit(f"v{version}-group-"), F.col("user_group").cast("string")).alias("run_id"),
            F.lit(f"v{version}-parent").alias("parent_run_id"), F.lit("grouped_training").alias("experiment"),
            F.col("end_time").alias("start_time"), "end_time",
            F.create_map(F.lit("user_group"), F.col("user_group").cast("string")).alias("params"),
            F.create_map(F.lit("device"), F.col("user_group").cast("string")).alias("tags"),
            F.create_map(F.lit("mse"), F.col("mse"), F.lit("n_used"), F.col("n_used").cast("double"),
                         F.lit("coef_value"), F.col("coef_value")).alias("metrics"))
        parent = data.agg(F.max("ts").cast("timestamp").alias("end_time"), F.count(F.lit(1)).alias("n")).select(
            F.lit(f"v{version}-parent").alias("run_id"), F.lit(None).cast("string").alias("parent_run_id"),
            F.lit("grouped_training").alias("experiment"), F.col("end_time").alias("start_time"), "end_time",
            F.create_map(F.lit("role"), F.lit("parent")).alias("tags"),
            F.create_map(F.lit("n_rows"), F.col("n").cast("double")).alias("metrics"))
        log.log(child.unionByName(parent, allowMissingColumns=True), data_path="events", data_version=version)
    return log


FACTS_TS_SQL = """(SELECT event_id, CAST(user_id % 12 AS INTEGER) AS user_group, value,
       round(value * 2 + (event_id % 100) / 10.0, 6) AS label, ts FROM events)"""


@query("runlog_latest", f"""WITH f AS {FACTS_TS_SQL},
c AS (SELECT user_group, count(*) AS n, regr_slope(label, value) AS b, regr_intercept(label, value) AS a FROM f GROUP BY user_group)
SELECT CAST(f.user_group AS VARCHAR) AS device, 'v2-group-' || CAST(f.user_group AS VARCHAR) AS run_id,
       CAST(max(c.n) AS DOUBLE) AS n_used, round(avg((label - (a + b * value)) * (label - (a + b * value))), 6) AS mse,
       2 AS data_version
FROM f JOIN c USING (user_group) GROUP BY f.user_group""", "runlog")
def runlog_latest(spark, sf_dir):
    """Latest run per device tag; the data version is read back as an int (max of versions)."""
    lt = _runlog(spark, sf_dir).latest_per_tag("device")
    return lt.select("device", "run_id", F.col("metrics")["n_used"].alias("n_used"),
                     F.round(F.col("metrics")["mse"], 6).alias("mse"),
                     F.col("params")["data_version"].cast("int").alias("data_version"))


RUNS_MSE_SQL = f"""WITH f AS {FACTS_TS_SQL},
v AS (SELECT 1 AS version, * FROM f WHERE ts < TIMESTAMP '{CUTOFF}' UNION ALL SELECT 2 AS version, * FROM f),
c AS (SELECT version, user_group, regr_slope(label, value) AS b, regr_intercept(label, value) AS a
      FROM v GROUP BY version, user_group),
m AS (SELECT v.version, v.user_group, avg((label - (a + b * value)) * (label - (a + b * value))) AS mse
      FROM v JOIN c USING (version, user_group) GROUP BY v.version, v.user_group)"""


@query("runlog_search", RUNS_MSE_SQL + """,
r AS (SELECT 'v1-group-' || CAST(user_group AS VARCHAR) AS run_id, mse FROM m WHERE version = 1)
SELECT run_id, round(mse, 6) AS mse FROM r ORDER BY mse, run_id LIMIT 3""", "runlog")
def runlog_search(spark, sf_dir):
    """Top 3 child runs of data version 1 by mse (the cap is the search feature)."""
    r = _runlog(spark, sf_dir).search_runs("params['data_version'] = '1' AND parent_run_id IS NOT NULL",
                                           [F.asc(F.col("metrics")["mse"]), F.asc("run_id")], max_results=3)
    return r.select("run_id", F.round(F.col("metrics")["mse"], 6).alias("mse"))


@query("runlog_best", RUNS_MSE_SQL + """
SELECT CAST(version AS VARCHAR) AS data_version, 'v' || CAST(version AS VARCHAR) || '-group-' || CAST(user_group AS VARCHAR) AS run_id,
       round(mse, 6) AS mse
FROM m QUALIFY row_number() OVER (PARTITION BY version ORDER BY mse, run_id) = 1""", "runlog")
def runlog_best(spark, sf_dir):
    """Child run with the smallest mse per data version."""
    best = _runlog(spark, sf_dir).best_run("mse", ascending=True, group_by="data_version")
    return best.withColumn("mse", F.round("mse", 6))


@query("runlog_data", RUNS_MSE_SQL + """
SELECT 'events' AS data_path, CAST(version AS VARCHAR) AS data_version, count(*) + 1 AS n_runs, round(avg(mse), 6) AS mse FROM m GROUP BY version""", "runlog")
def runlog_data(spark, sf_dir):
    """Runs by the data set and version they read, as logged with them."""
    runs = _runlog(spark, sf_dir).runs_on("events")
    p = F.col("params")
    return runs.groupBy(p["data_path"].alias("data_path"), p["data_version"].alias("data_version")).agg(
        F.count(F.lit(1)).alias("n_runs"), F.round(F.avg(F.col("metrics")["mse"]), 6).alias("mse"))


@query("runlog_tree", f"""WITH f AS {FACTS_TS_SQL},
v AS (SELECT 1 AS version, * FROM f WHERE ts < TIMESTAMP '{CUTOFF}' UNION ALL SELECT 2 AS version, * FROM f),
c AS (SELECT version, user_group, regr_slope(label, value) AS b, regr_intercept(label, value) AS a
      FROM v GROUP BY version, user_group),
m AS (SELECT v.version, v.user_group, avg((label - (a + b * value)) * (label - (a + b * value))) AS mse
      FROM v JOIN c USING (version, user_group) GROUP BY v.version, v.user_group)
SELECT 'v' || CAST(version AS VARCHAR) || '-parent' AS run_id, 'grouped_training' AS experiment,
       count(*) AS n_children, round(avg(mse), 6) AS avg_child_mse FROM m GROUP BY version""", "runlog")
def runlog_tree(spark, sf_dir):
    """Parent runs (one per data version) with their child count and mean child mse."""
    return _runlog(spark, sf_dir).tree("mse").withColumn("avg_child_mse", F.round("avg_child_mse", 6))


# ----------------------------------------------------------------------------- forecasting
FORECAST_SQL = """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS y FROM orders GROUP BY 1),
lim AS (SELECT max(day) - INTERVAL 10 DAY AS last_train FROM d),
tr AS (SELECT d.* FROM d, lim WHERE day <= last_train),
c AS (SELECT dayofweek(day) + 1 AS dow, regr_slope(y, CAST(day - DATE '1970-01-01' AS DOUBLE)) AS b,
             regr_intercept(y, CAST(day - DATE '1970-01-01' AS DOUBLE)) AS a FROM tr GROUP BY 1),
fut AS (SELECT CAST(last_train + INTERVAL (h) DAY AS DATE) AS day FROM lim, range(1, 11) AS t(h))
SELECT strftime(f.day, '%Y-%m-%d') AS day, CAST(dayofweek(f.day) + 1 AS INTEGER) AS dow,
       round(a + b * CAST(f.day - DATE '1970-01-01' AS DOUBLE), 2) AS forecast
FROM fut f JOIN c ON dayofweek(f.day) + 1 = c.dow"""


@query("forecast_dow_trend", FORECAST_SQL, "forecast")
def forecast_dow_trend(spark, sf_dir):
    daily = FC.daily_series(Tables(spark, sf_dir).orders, "o_orderdate", "o_totalprice")
    train, _ = FC.holdout_last(daily, 10)
    fc = FC.dow_trend_forecast(train, horizon=10)
    return fc.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "dow", F.round("forecast", 2).alias("forecast"))


SMAPE_SQL = FORECAST_SQL.replace("SELECT strftime(f.day, '%Y-%m-%d') AS day", "SELECT f.day AS day_d, strftime(f.day, '%Y-%m-%d') AS day") \
    .replace("round(a + b * CAST(f.day - DATE '1970-01-01' AS DOUBLE), 2) AS forecast",
             "a + b * CAST(f.day - DATE '1970-01-01' AS DOUBLE) AS forecast")
SMAPE_SQL = f"""WITH p AS ({SMAPE_SQL}),
d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS y FROM orders GROUP BY 1)
SELECT count(*) AS n_days, round(avg(CASE WHEN abs(y) + abs(forecast) = 0 THEN 0 ELSE 2 * abs(y - forecast) / (abs(y) + abs(forecast)) END), 8) AS smape
FROM p JOIN d ON p.day_d = d.day"""


@query("smape", SMAPE_SQL, "forecast")
def smape(spark, sf_dir):
    daily = FC.daily_series(Tables(spark, sf_dir).orders, "o_orderdate", "o_totalprice")
    train, test = FC.holdout_last(daily, 10)
    fc = FC.dow_trend_forecast(train, horizon=10)
    j = fc.join(test, "day")
    return MD.smape(j, "y", "forecast", digits=8)


# ----------------------------------------------------------------------------- detectors
DDM_SQL = """WITH b AS (SELECT user_id, ts, event_id, CAST(event_type = 'error' AS INTEGER) AS e FROM events),
r AS (SELECT user_id, ts, event_id,
             count(*) OVER w AS i, sum(e) OVER w AS ce FROM b
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
q AS (SELECT *, CAST(ce AS DOUBLE) / i AS p FROM r),
s AS (SELECT *, sqrt(p * (1 - p) / i) AS s FROM q),
m AS (SELECT *, min(CASE WHEN i >= 30 THEN {'ps': p + s, 'ni': -i, 'pm': p, 'sm': s} END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mn FROM s),
st AS (SELECT user_id, i, CASE WHEN i < 30 THEN 'in_control' WHEN p + s >= mn.pm + 3 * mn.sm THEN 'drift'
                               WHEN p + s >= mn.pm + 2 * mn.sm THEN 'warning' ELSE 'in_control' END AS state FROM m)
SELECT user_id, count(*) AS n, CAST(min(CASE WHEN state <> 'in_control' THEN i END) AS DOUBLE) AS first_warning,
       CAST(min(CASE WHEN state = 'drift' THEN i END) AS DOUBLE) AS first_drift,
       count(*) FILTER (WHERE state = 'warning') AS n_warning, count(*) FILTER (WHERE state = 'drift') AS n_drift
FROM st GROUP BY user_id"""


@query("ddm_states", DDM_SQL, "drift")
def ddm_states(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("user_id", F.struct("ts", "event_id").alias("_ord"),
                                             (F.col("event_type") == "error").alias("_e"))
    states = DT.ddm(ev, "user_id", "_ord", "_e")
    out = DT.ddm_summary(states, "user_id")
    return out.select("user_id", "n", F.col("first_warning").cast("double").alias("first_warning"),
                      F.col("first_drift").cast("double").alias("first_drift"), "n_warning", "n_drift")


def _domain(spark, sf_dir):
    t = Tables(spark, sf_dir)
    w = F.when(F.col("l_shipdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz"), 0).otherwise(1)
    return t.lineitem.select("l_orderkey", "l_linenumber", *LI_NUM, w.alias("label"))


@query("domain_auc", None, "drift")
def domain_auc(spark, sf_dir):
    """Domain classifier: predict the window a row came from, every row by a model that has not seen
    it; AUC near 0.5, within what redrawn labels give, means no drift."""
    return M.domain_drift(_domain(spark, sf_dir), "label", LI_NUM, ["l_orderkey", "l_linenumber"])


@query("domain_auc_range", f"""SELECT test, count(*) AS n, true AS in_range,
       CASE WHEN test = 0 THEN count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '{SPLIT_DATE}') END AS n_pos
FROM lineitem, range(0, 10) AS t(test) GROUP BY test""", "drift")
def domain_auc_range(spark, sf_dir):
    """The same test by test: every row is scored once per labelling, and no labelling is separable."""
    out = M.cross_fitted_auc(_domain(spark, sf_dir), "label", LI_NUM, ["l_orderkey", "l_linenumber"])
    return out.select(F.col("test").cast("bigint").alias("test"), "n", (F.abs(F.col("auc") - 0.5) < 0.1).alias("in_range"),
                      F.when(F.col("test") == 0, F.col("n_pos")).alias("n_pos"))


MONITOR_SQL = """
WITH RECURSIVE d AS (SELECT year(l_shipdate) * 4 + quarter(l_shipdate) AS q, l_quantity AS x, l_extendedprice AS y FROM lineitem),
p AS (SELECT q, row_number() OVER (ORDER BY q) AS i FROM (SELECT DISTINCT q FROM d)),
r AS (SELECT i, q, x, y FROM d JOIN p USING (q)),
m AS (SELECT p.i, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM p JOIN r ON r.i < p.i GROUP BY p.i),
e AS (SELECT m.i AS model, r.i AS i, sqrt(avg((y - a - b * x) * (y - a - b * x))) AS rmse, count(*) AS n
      FROM m JOIN r ON r.i >= m.i GROUP BY ALL),
loop AS (SELECT CAST(2 AS BIGINT) AS i, CAST(2 AS BIGINT) AS used, CAST(2 AS BIGINT) AS model
   UNION ALL
   SELECT l.i + 1, l.model, CASE WHEN new.rmse < old.rmse THEN l.i + 1 ELSE l.model END
   FROM loop l JOIN e old ON old.model = l.model AND old.i = l.i + 1 JOIN e new ON new.model = l.i + 1 AND new.i = l.i + 1)
SELECT CAST(p.q AS INTEGER) AS period, old.n, CAST(t.q AS INTEGER) AS trained_to, round(old.rmse, 4) AS rmse_current, round(new.rmse, 4) AS rmse_candidate,
       l.model <> l.used AS replaced, round(m.a, 4) AS intercept, round(m.b, 4) AS slope
FROM loop l JOIN p ON p.i = l.i JOIN p t ON t.i = l.used - 1 JOIN e old ON old.model = l.used AND old.i = l.i
JOIN e new ON new.model = l.i AND new.i = l.i JOIN m ON m.i = l.model
"""


@query("monitor_loop", MONITOR_SQL, "drift")
def monitor_loop(spark, sf_dir):
    """Quarter by quarter: a candidate fitted on all quarters so far takes over if it predicts the next
    one better than the model in use."""
    li = Tables(spark, sf_dir).lineitem.select((F.year("l_shipdate") * 4 + F.quarter("l_shipdate")).alias("period"),
                                               F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    out = M.monitor_loop(li, "period", ["x"], "y")
    return round_doubles(out.withColumnRenamed("coef_x", "slope"), 4)


RMSE_SQL = """WITH tr AS (SELECT o_orderpriority, avg(o_totalprice) AS pred FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1)
SELECT CAST(year(o_orderdate) AS INTEGER) AS period, count(*) AS n, round(sqrt(avg((o_totalprice - pred) * (o_totalprice - pred))), 4) AS rmse
FROM orders JOIN tr USING (o_orderpriority) WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1"""


@query("rmse_by_period", RMSE_SQL, "drift")
def rmse_by_period(spark, sf_dir):
    """Monitoring loop step: join predictions to observed values, RMSE per period."""
    o = Tables(spark, sf_dir).orders
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    model = o.filter(F.col("o_orderdate") < cut).groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("pred"))
    scored = o.filter(F.col("o_orderdate") >= cut).join(model, "o_orderpriority")
    m = MD.regression_metrics(scored.withColumn("period", F.year("o_orderdate")), "o_totalprice", "pred", ["period"])
    return m.select("period", "n", F.round("rmse", 4).alias("rmse"))
