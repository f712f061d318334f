"""Drift and data-quality monitoring queries with their DuckDB oracles."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from driftline.functions.stats import chi2_sf_sql_duckdb, ks_pvalue_sql
from driftline.operators import drift
from driftline.operators import sketches as SK
from driftline.operators.quantiles import column_statistics
from driftline.plans.fixtures import LI_CAT, LI_NUM, LINEITEM_W_SQL, SHIFTED_W_SQL, lineitem_tagged
from driftline.plans.registry import query, round_doubles
from driftline.sources.tables import Tables

NUM_LIST = ", ".join(LI_NUM)
CAT_LIST = ", ".join(LI_CAT)


def _long_sql(src: str, cols: str, cast: str = "DOUBLE") -> str:
    casted = ", ".join(f"CAST({c} AS {cast}) AS {c}" for c in cols.split(", "))
    return (f"(SELECT w, feature, value FROM (UNPIVOT (SELECT w, {casted} FROM ({src})) "
            f"ON {cols} INTO NAME feature VALUE value))")


def _stacked(spark, sf_dir, shifted=False):
    """(None, None, tagged frame): both windows come from one scan of lineitem."""
    return None, None, lineitem_tagged(Tables(spark, sf_dir), shifted)


# ------------------------------------------------------------------------ Jensen-Shannon
JS_SQL_TMPL = """
WITH l AS {long},
r AS (SELECT feature, min(value) AS lo, max(value) AS hi,
             count(*) FILTER (WHERE w = 1) AS n1, count(*) FILTER (WHERE w = 2) AS n2
      FROM l GROUP BY feature),
h AS (SELECT l.feature, CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / (hi - lo) * 20), 19) END AS bin,
             count(*) FILTER (WHERE w = 1) AS c1, count(*) FILTER (WHERE w = 2) AS c2
      FROM l JOIN r USING (feature) GROUP BY ALL),
t AS (SELECT h.feature, CAST(c1 AS DOUBLE) / n1 AS p, CAST(c2 AS DOUBLE) / n2 AS q, n1, n2
      FROM h JOIN r USING (feature))
SELECT feature, n1, n2,
       round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                              + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)), 8) AS js_distance
FROM t GROUP BY feature, n1, n2
"""


@query("js_distance", JS_SQL_TMPL.format(long=_long_sql(LINEITEM_W_SQL, NUM_LIST)), "drift")
def js_distance(spark, sf_dir):
    _, _, st = _stacked(spark, sf_dir)
    return round_doubles(drift.js_distance(drift.to_long(st, LI_NUM), ["feature"], n_tests=len(LI_NUM)), 8)


@query("js_distance_shifted", JS_SQL_TMPL.format(long=_long_sql(SHIFTED_W_SQL, NUM_LIST)), "drift")
def js_distance_shifted(spark, sf_dir):
    _, _, st = _stacked(spark, sf_dir, shifted=True)
    return round_doubles(drift.js_distance(drift.to_long(st, LI_NUM), ["feature"], n_tests=len(LI_NUM)), 8)


HIST_SQL = f"""
WITH l AS {_long_sql(LINEITEM_W_SQL, NUM_LIST)},
r AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM l GROUP BY feature),
h AS (SELECT l.feature, CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / (hi - lo) * 20), 19) END AS bin,
             count(*) FILTER (WHERE w = 1) AS c1, count(*) FILTER (WHERE w = 2) AS c2
      FROM l JOIN r USING (feature) GROUP BY ALL),
g AS (SELECT feature, lo, hi, CAST(b.range AS INTEGER) AS bin FROM r, range(20) AS b)
SELECT g.feature, g.bin, coalesce(h.c1, 0) AS c1, coalesce(h.c2, 0) AS c2, round(g.lo, 6) AS lo, round(g.hi, 6) AS hi
FROM g LEFT JOIN h ON g.feature = h.feature AND g.bin = h.bin
"""


@query("histogram20", HIST_SQL, "profile")
def histogram20(spark, sf_dir):
    _, _, st = _stacked(spark, sf_dir)
    h = drift.histogram_counts(drift.to_long(st, LI_NUM), ["feature"], 20, n_tests=len(LI_NUM))
    return round_doubles(h.select("feature", "bin", "c1", "c2", "lo", "hi"), 6)


LOGHIST_SQL = """
WITH l AS (SELECT 1 AS w, 'log10_price' AS feature, log10(l_extendedprice) AS value FROM lineitem WHERE l_extendedprice > 0),
r AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM l GROUP BY feature)
SELECT l.feature, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / (hi - lo) * 20), 19) END AS INTEGER) AS bin,
       count(*) AS c1
FROM l JOIN r USING (feature) GROUP BY ALL
"""


@query("log_histogram", LOGHIST_SQL, "profile")
def log_histogram(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.filter(F.col("l_extendedprice") > 0).select(F.log10("l_extendedprice").alias("log10_price"))
    st = li.withColumn("_w", F.lit(1))
    h = drift.histogram_counts(drift.to_long(st, ["log10_price"]), ["feature"], 20, n_tests=1)
    return h.filter(F.col("c1") > 0).select("feature", "bin", "c1")


# ------------------------------------------------------------------------ KS family
def _ecdf_sql(long: str) -> str:
    return f"""
WITH l AS {long},
vc AS (SELECT feature, value, count(*) FILTER (WHERE w = 1) AS c1, count(*) FILTER (WHERE w = 2) AS c2
       FROM l GROUP BY feature, value),
e AS (SELECT feature, value, c1, c2, c1 + c2 AS c,
             sum(c1) OVER (PARTITION BY feature ORDER BY value) AS cum1,
             sum(c2) OVER (PARTITION BY feature ORDER BY value) AS cum2,
             sum(c1 + c2) OVER (PARTITION BY feature ORDER BY value) AS cum,
             sum(c1) OVER (PARTITION BY feature) AS n1, sum(c2) OVER (PARTITION BY feature) AS n2,
             lead(value) OVER (PARTITION BY feature ORDER BY value) AS next_value
      FROM vc)"""


KS_SQL = _ecdf_sql(_long_sql(LINEITEM_W_SQL, NUM_LIST)) + f"""
, k AS (SELECT feature, CAST(max(n1) AS BIGINT) AS n1, CAST(max(n2) AS BIGINT) AS n2,
              max(abs(cum1 / n1 - cum2 / n2)) AS ks_stat FROM e GROUP BY feature)
SELECT feature, n1, n2, round(ks_stat, 8) AS ks_stat,
       round({ks_pvalue_sql("ks_stat * sqrt(CAST(n1 AS DOUBLE) * n2 / (n1 + n2))")}, 6) AS p_value,
       round(0.05 / 4, 8) AS alpha_corrected,
       {ks_pvalue_sql("ks_stat * sqrt(CAST(n1 AS DOUBLE) * n2 / (n1 + n2))")} <= 0.05 / 4 AS drift
FROM k
"""


@query("ks_statistic", KS_SQL, "drift")
def ks_statistic(spark, sf_dir):
    _, _, st = _stacked(spark, sf_dir)
    ks = drift.ks_test(drift.to_long(st, LI_NUM), ["feature"], 0.05, len(LI_NUM))
    ks = ks.select("feature", "n1", "n2", F.round("ks_stat", 8).alias("ks_stat"),
                   F.round("p_value", 6).alias("p_value"), F.round("alpha_corrected", 8).alias("alpha_corrected"),
                   "drift")
    return ks


KS_FIXED_SQL = _ecdf_sql(_long_sql(SHIFTED_W_SQL, NUM_LIST)) + f"""
, k AS (SELECT feature, max(n1) AS n1, max(n2) AS n2, max(abs(cum1 / n1 - cum2 / n2)) AS ks_stat FROM e GROUP BY feature)
SELECT feature, round(ks_stat, 8) AS ks_stat,
       round({ks_pvalue_sql("ks_stat * sqrt(CAST(n1 AS DOUBLE) * n2 / (n1 + n2))")}, 3) AS p_value,
       {ks_pvalue_sql("ks_stat * sqrt(CAST(n1 AS DOUBLE) * n2 / (n1 + n2))")} <= 0.05 AS drift
FROM k
"""


@query("ks_fixed_alpha", KS_FIXED_SQL, "drift")
def ks_fixed_alpha(spark, sf_dir):
    """KS with a fixed alpha of 0.05 (no correction) and the p-value rounded to 3 digits."""
    _, _, st = _stacked(spark, sf_dir, shifted=True)
    ks = drift.ks_test(drift.to_long(st, LI_NUM), ["feature"], 0.05, len(LI_NUM), correct=False)
    return ks.select("feature", F.round("ks_stat", 8).alias("ks_stat"), F.round("p_value", 3).alias("p_value"), "drift")


W1_SQL = _ecdf_sql(_long_sql(SHIFTED_W_SQL, NUM_LIST)) + """
SELECT feature, round(sum(abs(cum1 / n1 - cum2 / n2) * coalesce(next_value - value, 0)), 6) AS wasserstein1
FROM e GROUP BY feature
"""


@query("wasserstein1", W1_SQL, "drift")
def wasserstein1(spark, sf_dir):
    _, _, st = _stacked(spark, sf_dir, shifted=True)
    return round_doubles(drift.wasserstein1(drift.to_long(st, LI_NUM), ["feature"], n_tests=len(LI_NUM)), 6)


MWU_SQL = _ecdf_sql(_long_sql(LINEITEM_W_SQL, NUM_LIST)) + """
, g AS (SELECT feature, CAST(max(n1) AS DOUBLE) AS n1, CAST(max(n2) AS DOUBLE) AS n2,
              sum(c1 * (cum - c + (c + 1) / 2.0)) AS r1,
              sum(pow(CAST(c AS DOUBLE), 3) - c) AS ties FROM e GROUP BY feature),
u AS (SELECT feature, n1, n2, r1 - n1 * (n1 + 1) / 2 AS u_stat, ties FROM g)
SELECT feature, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(u_stat, 4) AS u_stat,
       round((u_stat - n1 * n2 / 2 - sign(u_stat - n1 * n2 / 2) * 0.5)
             / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))), 6) AS z_score
FROM u
"""


@query("mann_whitney_u", MWU_SQL, "drift")
def mann_whitney_u(spark, sf_dir):
    _, _, st = _stacked(spark, sf_dir)
    m = drift.mann_whitney(drift.to_long(st, LI_NUM), ["feature"], n_tests=len(LI_NUM))
    return m.select("feature", "n1", "n2", F.round("u_stat", 4).alias("u_stat"), F.round("z_score", 6).alias("z_score"))


KL_SQL = f"""
WITH l AS {_long_sql(SHIFTED_W_SQL, NUM_LIST)},
r AS (SELECT feature, min(value) AS lo, max(value) AS hi,
             count(*) FILTER (WHERE w = 1) AS n1, count(*) FILTER (WHERE w = 2) AS n2 FROM l GROUP BY feature),
h AS (SELECT l.feature, CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / (hi - lo) * 20), 19) END AS bin,
             count(*) FILTER (WHERE w = 1) AS c1, count(*) FILTER (WHERE w = 2) AS c2
      FROM l JOIN r USING (feature) GROUP BY ALL),
t AS (SELECT h.feature, c1, c2, CAST(c1 AS DOUBLE) / n1 AS p, CAST(c2 AS DOUBLE) / n2 AS q FROM h JOIN r USING (feature))
SELECT feature, CASE WHEN max(CASE WHEN c1 > 0 AND c2 = 0 THEN 1 ELSE 0 END) = 0
                     THEN round(sum(CASE WHEN c1 > 0 THEN p * ln(p / q) ELSE 0 END), 8) END AS kl_divergence
FROM t GROUP BY feature
"""


@query("kl_divergence", KL_SQL, "drift")
def kl_divergence(spark, sf_dir):
    _, _, st = _stacked(spark, sf_dir, shifted=True)
    return round_doubles(drift.kl_divergence(drift.to_long(st, LI_NUM), ["feature"], n_tests=len(LI_NUM)), 8)


# ------------------------------------------------------------------------ categorical
def _counts_sql(src: str) -> str:
    return f"""
WITH l AS {_long_sql(src, CAT_LIST, "VARCHAR")},
o AS (SELECT feature, value, count(*) FILTER (WHERE w = 1) AS o1, count(*) FILTER (WHERE w = 2) AS o2
      FROM l GROUP BY feature, value)"""


CONTINGENCY_SQL = _counts_sql(SHIFTED_W_SQL) + "\nSELECT feature, value, o1, o2 FROM o"


@query("contingency_counts", CONTINGENCY_SQL, "drift")
def contingency_counts(spark, sf_dir):
    _, _, st = _stacked(spark, sf_dir, shifted=True)
    return drift.category_counts(st, LI_CAT)


def _chi2_sql(src: str) -> str:
    return _counts_sql(src) + f"""
, t AS (SELECT feature, sum(o1) AS n1, sum(o2) AS n2, count(*) AS k FROM o GROUP BY feature),
j AS (SELECT o.feature, o1, o2, n1, n2, k, CAST(o1 + o2 AS DOUBLE) * n1 / (n1 + n2) AS e1,
             CAST(o1 + o2 AS DOUBLE) * n2 / (n1 + n2) AS e2 FROM o JOIN t USING (feature)),
d AS (SELECT feature, k, CASE WHEN k = 2 THEN abs(o1 - e1) - least(0.5, abs(o1 - e1)) ELSE abs(o1 - e1) END AS d1,
             CASE WHEN k = 2 THEN abs(o2 - e2) - least(0.5, abs(o2 - e2)) ELSE abs(o2 - e2) END AS d2, e1, e2 FROM j),
s AS (SELECT feature, CASE WHEN max(k) > 1 THEN sum(d1 * d1 / e1 + d2 * d2 / e2) ELSE 0 END AS chi2,
             CAST(max(k) - 1 AS BIGINT) AS dof FROM d GROUP BY feature)
SELECT feature, round(chi2, 6) AS chi2, dof, round({chi2_sf_sql_duckdb("chi2", "dof")}, 6) AS p_value,
       round(0.05 / 2, 8) AS alpha_corrected, {chi2_sf_sql_duckdb("chi2", "dof")} < 0.05 / 2 AS drift
FROM s
"""


def _chi2_spark(st):
    ch = drift.chi2_test(drift.category_counts(st, LI_CAT), ["feature"], 0.05, len(LI_CAT))
    return ch.select("feature", F.round("chi2", 6).alias("chi2"), "dof", F.round("p_value", 6).alias("p_value"),
                     F.round("alpha_corrected", 8).alias("alpha_corrected"), "drift")


@query("chi2_contingency", _chi2_sql(LINEITEM_W_SQL), "drift")
def chi2_contingency(spark, sf_dir):
    return _chi2_spark(_stacked(spark, sf_dir)[2])


@query("chi2_contingency_shifted", _chi2_sql(SHIFTED_W_SQL), "drift")
def chi2_contingency_shifted(spark, sf_dir):
    return _chi2_spark(_stacked(spark, sf_dir, shifted=True)[2])


CHI2_GOF_SQL = _counts_sql(SHIFTED_W_SQL) + """
, t AS (SELECT feature, sum(o1) AS n1, sum(o2) AS n2, count(*) AS k FROM o GROUP BY feature),
j AS (SELECT o.feature, o2, CAST(o1 AS DOUBLE) * n2 / n1 AS e, k FROM o JOIN t USING (feature))
SELECT feature, CASE WHEN max(CASE WHEN e = 0 AND o2 > 0 THEN 1 ELSE 0 END) = 0
                     THEN round(sum(CASE WHEN e > 0 THEN (o2 - e) * (o2 - e) / e ELSE 0 END), 6) END AS chi2,
       CAST(max(k) - 1 AS BIGINT) AS dof
FROM j GROUP BY feature
"""


@query("chi2_goodness", CHI2_GOF_SQL, "drift")
def chi2_goodness(spark, sf_dir):
    _, _, st = _stacked(spark, sf_dir, shifted=True)
    return round_doubles(drift.chi2_goodness(drift.category_counts(st, LI_CAT), ["feature"], n_tests=len(LI_CAT)), 6)


# ------------------------------------------------------------------------ nulls, summaries
NULL_SQL = f"""
WITH s AS ({SHIFTED_W_SQL}),
u AS (UNPIVOT (SELECT w, count(*) AS n, {", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in LI_NUM + LI_CAT)}
               FROM s GROUP BY w) ON {NUM_LIST}, {CAT_LIST} INTO NAME feature VALUE nulls)
SELECT feature, round(sum(CASE WHEN w = 1 THEN 100.0 * nulls / n END), 6) AS null_pct_1,
       round(sum(CASE WHEN w = 2 THEN 100.0 * nulls / n END), 6) AS null_pct_2,
       CAST(sum(CASE WHEN w = 1 THEN nulls END) AS BIGINT) AS nulls_1,
       CAST(sum(CASE WHEN w = 2 THEN nulls END) AS BIGINT) AS nulls_2
FROM u GROUP BY feature
"""


@query("null_rates", NULL_SQL, "drift")
def null_rates(spark, sf_dir):
    _, _, st = _stacked(spark, sf_dir, shifted=True)
    return round_doubles(drift.null_rates_stacked(st, LI_NUM + LI_CAT), 6)


PCT_SQL = f"""
WITH l AS {_long_sql(SHIFTED_W_SQL, NUM_LIST)},
s AS (SELECT feature, w, CAST(count(value) AS DOUBLE) AS "count", avg(value) AS mean, stddev_samp(value) AS std,
             min(value) AS "min", quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
             quantile_cont(value, 0.75) AS p75, max(value) AS "max" FROM l GROUP BY feature, w),
u AS (UNPIVOT s ON "count", mean, std, "min", p25, p50, p75, "max" INTO NAME stat VALUE v)
SELECT feature, stat, round(sum(CASE WHEN w = 1 THEN v END), 6) AS s1, round(sum(CASE WHEN w = 2 THEN v END), 6) AS s2,
       round(100 * abs((sum(CASE WHEN w = 1 THEN v END) - sum(CASE WHEN w = 2 THEN v END))
                       / (sum(CASE WHEN w = 1 THEN v END) + 1e-100)), 6) AS pct_change
FROM u GROUP BY feature, stat
"""


@query("summary_pct_change", PCT_SQL, "drift")
def summary_pct_change(spark, sf_dir):
    _, _, st = _stacked(spark, sf_dir, shifted=True)
    return round_doubles(drift.summary_pct_change_stacked(st, LI_NUM), 6)


# ------------------------------------------------------------------------ the monitor
def _report_sql(src: str) -> str:
    js = JS_SQL_TMPL.format(long=_long_sql(src, NUM_LIST))
    chi = _chi2_sql(src)
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in LI_NUM + LI_CAT)
    return f"""
SELECT feature, 'js_distance' AS test, js_distance AS statistic, CAST(NULL AS DOUBLE) AS p_value,
       0.2 AS threshold, js_distance >= 0.2 AS drift FROM ({js})
UNION ALL
SELECT feature, 'chi2' AS test, chi2 AS statistic, p_value, alpha_corrected AS threshold, drift FROM ({chi})
UNION ALL
SELECT '*' AS feature, 'total_nulls_' || CAST(w AS VARCHAR) AS test, CAST({nulls} AS DOUBLE) AS statistic,
       CAST(NULL AS DOUBLE) AS p_value, CAST(NULL AS DOUBLE) AS threshold, false AS drift
FROM ({src}) GROUP BY w
"""


def _report_spark(spark, sf_dir, shifted):
    _, _, st = _stacked(spark, sf_dir, shifted=shifted)
    rep = drift.drift_report_stacked(st, LI_CAT, LI_NUM)
    return rep.select("feature", "test",
                      F.when(F.col("test") == "js_distance", F.round("statistic", 8))
                      .otherwise(F.round("statistic", 6)).alias("statistic"),
                      F.round("p_value", 6).alias("p_value"), F.round("threshold", 8).alias("threshold"), "drift")


@query("drift_report", _report_sql(LINEITEM_W_SQL), "drift")
def drift_report(spark, sf_dir):
    return _report_spark(spark, sf_dir, False)


@query("drift_report_shifted", _report_sql(SHIFTED_W_SQL), "drift")
def drift_report_shifted(spark, sf_dir):
    return _report_spark(spark, sf_dir, True)


ALERTS_SQL = f"""
SELECT feature, test, statistic, p_value, threshold, 'distribution change: ' || feature AS message
FROM ({_report_sql(SHIFTED_W_SQL)}) WHERE drift
"""


@query("drift_alerts", ALERTS_SQL, "drift")
def drift_alerts(spark, sf_dir):
    return drift.alerts(_report_spark(spark, sf_dir, True))


# ------------------------------------------------------------------------ rolling windows
WEEK_SPARK = "CAST(floor(datediff(to_date(ts), DATE'1970-01-05') / 7) AS BIGINT)"
WEEK_DUCK = "CAST(floor(datediff('day', DATE '1970-01-05', CAST(ts AS DATE)) / 7) AS BIGINT)"

WEEKLY_SQL = f"""
WITH ev AS (SELECT {WEEK_DUCK} AS wk, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
st AS (SELECT wk AS pair, 2 AS w, value, k FROM ev UNION ALL SELECT wk + 1 AS pair, 1 AS w, value, k FROM ev),
l AS (SELECT pair, w, feature, value FROM (UNPIVOT st ON value, k INTO NAME feature VALUE value)),
r AS (SELECT pair, feature, min(value) AS lo, max(value) AS hi,
             count(*) FILTER (WHERE w = 1) AS n1, count(*) FILTER (WHERE w = 2) AS n2 FROM l GROUP BY pair, feature),
h AS (SELECT l.pair, l.feature, CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / (hi - lo) * 20), 19) END AS bin,
             count(*) FILTER (WHERE w = 1) AS c1, count(*) FILTER (WHERE w = 2) AS c2
      FROM l JOIN r USING (pair, feature) GROUP BY ALL),
t AS (SELECT h.pair, h.feature, CAST(c1 AS DOUBLE) / n1 AS p, CAST(c2 AS DOUBLE) / n2 AS q, n1, n2
      FROM h JOIN r USING (pair, feature) WHERE n1 > 0 AND n2 > 0)
SELECT pair, feature, n1, n2,
       round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                              + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)), 8) AS js_distance
FROM t GROUP BY pair, feature, n1, n2
"""


@query("weekly_js", WEEKLY_SQL, "drift")
def weekly_js(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select(
        F.expr(WEEK_SPARK).alias("wk"), "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"))
    return round_doubles(drift.rolling_js(ev, "wk", ["value", "k"]), 8)


TRAILING_SQL = f"""
WITH ev AS (SELECT {WEEK_DUCK} AS wk, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
l AS (SELECT wk, feature, value FROM (UNPIVOT ev ON value, k INTO NAME feature VALUE value)),
g AS (SELECT wk, feature, CASE WHEN value = 0 THEN 0 ELSE sign(value) * (floor((ceil(ln(abs(value)) / {SK._LOG_GAMMA!r}) + {SK._SHIFT} - 1) / 16) + 1) END AS bin,
             count(*) AS n FROM l GROUP BY ALL),
c AS (SELECT wk + j AS pair, feature, bin, sum(CASE WHEN j > 0 THEN n ELSE 0 END) AS c1, sum(CASE WHEN j = 0 THEN n ELSE 0 END) AS c2
      FROM g, range(0, 5) AS t(j) GROUP BY ALL),
t AS (SELECT pair, feature, sum(c1) AS n1, sum(c2) AS n2 FROM c GROUP BY ALL HAVING sum(c1) > 0 AND sum(c2) > 0),
pq AS (SELECT c.pair, c.feature, c1 / n1 AS p, c2 / n2 AS q, n1, n2 FROM c JOIN t USING (pair, feature))
SELECT pair, feature, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2,
       round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                              + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)), 8) AS js_distance
FROM pq GROUP BY pair, feature, n1, n2
"""


def _weekly_states(spark, sf_dir):
    """States of the events per week, written once."""
    ev = Tables(spark, sf_dir).events.select(F.expr(WEEK_SPARK).alias("wk"), "value",
                                             F.get_json_object("props", "$.k").cast("double").alias("k"))
    return ev, SK.write_states(ev, "wk", ["value", "k"])


@query("trailing_js", TRAILING_SQL, "drift")
def trailing_js(spark, sf_dir):
    """Every week against the four before it, from stored states alone."""
    return round_doubles(SK.trailing_js(_weekly_states(spark, sf_dir)[1], 4), 8)


@query("sketch_profile", f"""
WITH ev AS (SELECT {WEEK_DUCK} AS wk, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
l AS (SELECT wk, feature, value FROM (UNPIVOT ev ON value, k INTO NAME feature VALUE value)),
w AS (SELECT min(wk) AS first, max(wk) AS last FROM ev)
SELECT part, feature, count(*) AS n, round(min(value), 6) AS "min", round(max(value), 6) AS "max", round(avg(value), 6) AS mean,
       true AS p50_within, true AS p99_within, true AS distinct_within
FROM l, w, (VALUES ('all'), ('recent')) AS v(part) WHERE part = 'all' OR wk > last - 2 GROUP BY part, feature
""", "drift")
def sketch_profile(spark, sf_dir):
    """Merged states of all weeks and of the last two; quantiles and distinct counts are compared with
    exact ones and come out as whether they keep their bounds."""
    ev, states = _weekly_states(spark, sf_dir)
    first, last = states.heads.agg(F.min("period"), F.max("period")).first()
    parts = []
    for part, lo in (("all", first), ("recent", last - 1)):
        got = SK.merged_profile(states.between(lo, last), [0.5, 0.99], ["p50", "p99"])
        rows = ev.filter(F.col("wk") >= lo)
        exact = []
        for t in column_statistics(rows, ["value", "k"], [0.5, 0.99]):
            at = [t.found[math.floor((t.stats["n"] - 1) * p)] if t.stats["n"] else None for p in (0.5, 0.99)]
            exact.append((t.column, *at))
        known = spark.createDataFrame(exact, "feature string, x50 double, x99 double")
        distinct = rows.unpivot([], ["value", "k"], "feature", "x").groupBy("feature").agg(F.count_distinct("x").alias("d"))
        near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= SK.ACCURACY * 1.000001 * F.abs(b)
        error = 4 * 1.04 / math.sqrt(2 ** SK.HLL_LG_K)  # four standard errors
        parts.append(got.join(known, "feature").join(distinct, "feature").select(
            F.lit(part).alias("part"), "feature", "n", "min", "max", "mean", near("p50", "x50").alias("p50_within"), near("p99", "x99").alias("p99_within"),
            (F.abs(F.col("n_distinct") - F.col("d")) <= F.greatest(F.lit(1.0), error * F.col("d"))).alias("distinct_within")))
    return round_doubles(parts[0].unionByName(parts[1]), 6)


PEARSON_SQL = """
SELECT feature, round(corr(value, l_extendedprice), 8) AS pearson
FROM (UNPIVOT (SELECT l_extendedprice, l_quantity, l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem)
      ON l_quantity, l_discount, l_tax, l_linenumber INTO NAME feature VALUE value)
GROUP BY feature
"""


@query("pearson", PEARSON_SQL, "drift")
def pearson(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_extendedprice", "l_quantity", "l_discount", "l_tax",
                                               F.col("l_linenumber").cast("double").alias("l_linenumber"))
    long = li.unpivot(["l_extendedprice"], ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "feature", "value")
    return long.groupBy("feature").agg(F.round(F.corr("value", "l_extendedprice"), 8).alias("pearson"))
