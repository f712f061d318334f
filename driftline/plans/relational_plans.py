"""Scans, projections, predicates, aggregates, sorts, sets, scalar functions, splits, joins
(SURVEY §2.1-§2.9) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.functions import columns as C
from driftline.functions import hashing as H
from driftline.operators import keys as K
from driftline.operators import profile as P
from driftline.operators.ecdf import prefix_min, value_statistics
from driftline.operators.runlog import latest_version
from driftline.plans.fixtures import (LINEITEM_NULLS_SQL, PEOPLE_SQL, lineitem_nulls, people)
from driftline.plans.registry import query, round_doubles
from driftline.sources.tables import Tables

LI_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def T(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


# ----------------------------------------------------------------------------- scans / projection
@query("scan_parquet", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45", "scan")
def scan_parquet(spark, sf_dir):
    return T(spark, sf_dir).lineitem.filter(F.col("l_quantity") > 45).select("l_orderkey", "l_partkey", "l_quantity")


@query("project_keep", "SELECT p_partkey, p_brand, p_type, p_size FROM part", "scan")
def project_keep(spark, sf_dir):
    return T(spark, sf_dir).part.select(["p_partkey", "p_brand", "p_type", "p_size"])


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders", "scan")
def drop_columns(spark, sf_dir):
    return T(spark, sf_dir).orders.drop("o_orderdate", "o_orderpriority")


@query("rename_columns", "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id, "
       "c_acctbal AS account_balance, c_mktsegment AS segment FROM customer", "scan")
def rename_columns(spark, sf_dir):
    return T(spark, sf_dir).customer.withColumnsRenamed(
        {"c_custkey": "customer_id", "c_name": "customer_name", "c_nationkey": "nation_id",
         "c_acctbal": "account_balance", "c_mktsegment": "segment"})


@query("computed_column", """SELECT l_orderkey, l_linenumber,
       round(l_extendedprice * (1 - l_discount), 4) AS revenue,
       round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge,
       l_orderkey % 7 AS bucket, round(l_extendedprice / l_quantity, 8) AS unit_price FROM lineitem""", "scan")
def computed_column(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    rev = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", F.round(rev, 4).alias("revenue"),
                     F.round(rev * (1 + F.col("l_tax")), 6).alias("charge"),
                     (F.col("l_orderkey") % 7).alias("bucket"),
                     F.round(F.col("l_extendedprice") / F.col("l_quantity"), 8).alias("unit_price"))


@query("row_mean", f"""SELECT l_orderkey, l_linenumber, round((l_quantity + l_discount + l_tax) / 3.0, 8) AS row_mean
FROM ({LINEITEM_NULLS_SQL})""", "clean")
def row_mean(spark, sf_dir):
    li = lineitem_nulls(T(spark, sf_dir))
    return li.select("l_orderkey", "l_linenumber", F.round(C.row_mean(["l_quantity", "l_discount", "l_tax"]), 8).alias("row_mean"))


@query("preprocess_sum", f"""SELECT l_orderkey, CAST(CAST(l_linenumber AS VARCHAR) AS DOUBLE) AS l_linenumber,
       l_quantity, l_extendedprice, l_returnflag, l_linestatus, round(l_discount + l_tax, 6) AS score_sum
FROM ({LINEITEM_NULLS_SQL})""", "clean")
def preprocess_sum(spark, sf_dir):
    li = lineitem_nulls(T(spark, sf_dir))
    out = li.withColumn("score_sum", F.round(C.row_sum(["l_discount", "l_tax"]), 6)).drop("l_discount", "l_tax", "l_partkey")
    return out.withColumn("l_linenumber", F.col("l_linenumber").cast("string").cast("double"))


@query("cast_columns", """SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity * 1.7) AS INTEGER) AS qty_int,
       CAST(CAST(l_linenumber AS VARCHAR) || '.5' AS DOUBLE) AS text_to_double,
       strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS ship_day FROM lineitem""", "clean")
def cast_columns(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 1.7).cast("int").alias("qty_int"),
                     F.concat(F.col("l_linenumber").cast("string"), F.lit(".5")).cast("double").alias("text_to_double"),
                     F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd").alias("ship_day"))


@query("ints_to_double", """SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, p_name, p_brand, p_type,
       CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part""", "clean")
def ints_to_double(spark, sf_dir):
    return C.ints_to_double(T(spark, sf_dir).part)


@query("filter_predicates", """SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice > 100000 AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus = 'F'
  AND o_orderpriority IS NOT NULL AND o_custkey <= 1000""", "scan")
def filter_predicates(spark, sf_dir):
    o = T(spark, sf_dir).orders
    return (o.filter(F.col("o_totalprice") > 100000)
            .filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
            .filter("o_orderstatus = 'F'").filter(F.col("o_orderpriority").isNotNull())
            .where(F.col("o_custkey") <= 1000).select("o_orderkey", "o_totalprice"))


@query("outlier_rules", """SELECT count(*) AS n_rows, round(sum(l_extendedprice), 2) AS total_price
FROM lineitem WHERE l_extendedprice > 0 AND l_quantity <= 45""", "scan")
def outlier_rules(spark, sf_dir):
    li = T(spark, sf_dir).lineitem.filter(F.col("l_extendedprice") > 0).filter(F.col("l_quantity") <= 45)
    return li.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_extendedprice"), 2).alias("total_price"))


@query("null_out_value", """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END AS l_returnflag,
       CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_linestatus END AS l_linestatus FROM lineitem""", "clean")
def null_out_value(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", C.null_out("l_returnflag", "R").alias("l_returnflag"),
                     F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")).alias("l_linestatus"))


@query("null_flags", f"""SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount IS NULL THEN 1.0 ELSE 0.0 END AS l_discount_na,
       CASE WHEN l_tax IS NULL THEN 1.0 ELSE 0.0 END AS l_tax_na,
       CASE WHEN l_returnflag IS NULL THEN 1.0 ELSE 0.0 END AS l_returnflag_na FROM ({LINEITEM_NULLS_SQL})""", "clean")
def null_flags(spark, sf_dir):
    li = lineitem_nulls(T(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_returnflag")
    return C.null_flags(li, ["l_discount", "l_tax", "l_returnflag"]).drop("l_discount", "l_tax", "l_returnflag")


@query("na_fill", f"""SELECT l_orderkey, l_linenumber, coalesce(l_discount, 0.0) AS l_discount, coalesce(l_tax, 0.0) AS l_tax,
       coalesce(l_returnflag, 'U') AS l_returnflag FROM ({LINEITEM_NULLS_SQL})""", "clean")
def na_fill(spark, sf_dir):
    li = lineitem_nulls(T(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_returnflag")
    return li.na.fill(0.0, ["l_discount", "l_tax"]).na.fill({"l_returnflag": "U"})


@query("na_drop", f"""SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM ({LINEITEM_NULLS_SQL})
WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL""", "clean")
def na_drop(spark, sf_dir):
    li = lineitem_nulls(T(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return li.na.drop(subset=["l_discount", "l_tax"])


@query("fill_mode", f"""WITH s AS ({LINEITEM_NULLS_SQL}),
m AS (SELECT l_returnflag AS mode FROM s WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
      ORDER BY count(*) DESC, l_returnflag LIMIT 1)
SELECT l_returnflag, count(*) AS n FROM (SELECT coalesce(s.l_returnflag, m.mode) AS l_returnflag FROM s, m) GROUP BY l_returnflag""",
       "clean")
def fill_mode(spark, sf_dir):
    li = lineitem_nulls(T(spark, sf_dir)).select("l_returnflag")
    return C.fill_with_mode(li, ["l_returnflag"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("fill_missing_category", f"""SELECT coalesce(l_returnflag, 'missing') AS l_returnflag, count(*) AS n
FROM ({LINEITEM_NULLS_SQL}) GROUP BY 1""", "clean")
def fill_missing_category(spark, sf_dir):
    li = lineitem_nulls(T(spark, sf_dir))
    return li.select(C.fill_missing_category("l_returnflag").alias("l_returnflag")).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"))


@query("threshold_class", """SELECT l_orderkey, l_linenumber, CAST(l_extendedprice >= 50000 AS INTEGER) AS high_price,
       CASE WHEN l_extendedprice > 100000 THEN 'premium' ELSE 'standard' END AS price_class FROM lineitem""", "clean")
def threshold_class(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", C.threshold_label("l_extendedprice", 50000).alias("high_price"),
                     C.threshold_text("l_extendedprice", 100000, "premium", "standard").alias("price_class"))


@query("baseline_predictions", """WITH m AS (SELECT avg(l_extendedprice) AS mu, median(l_extendedprice) AS med FROM lineitem)
SELECT round(sqrt(avg((l_extendedprice - mu) * (l_extendedprice - mu))), 4) AS rmse_mean,
       round(sqrt(avg((l_extendedprice - med) * (l_extendedprice - med))), 4) AS rmse_median FROM lineitem, m""", "model")
def baseline_predictions(spark, sf_dir):
    """Constant predictions (train mean / median) and their RMSE; the two constants are fitted
    scalars, applied as literals."""
    li = T(spark, sf_dir).lineitem.select("l_extendedprice")
    med = P.quantiles(li, ["l_extendedprice"], [0.5], ["p50"])
    mu = li.agg(F.avg("l_extendedprice")).first()[0]
    md = med.first()["p50"]
    pred = li.select("l_extendedprice", F.lit(mu).alias("pred_mean"), F.lit(md).alias("pred_median"))
    return pred.agg(
        F.round(F.sqrt(F.avg(F.pow(F.col("l_extendedprice") - F.col("pred_mean"), 2))), 4).alias("rmse_mean"),
        F.round(F.sqrt(F.avg(F.pow(F.col("l_extendedprice") - F.col("pred_median"), 2))), 4).alias("rmse_median"))


@query("stable_row_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_id FROM orders", "keys")
def stable_row_id(spark, sf_dir):
    return K.stable_row_id(T(spark, sf_dir).orders.select("o_orderkey"), "o_orderkey")


# ----------------------------------------------------------------------------- aggregates
@query("row_count", "SELECT count(*) AS n_rows FROM lineitem", "agg")
def row_count(spark, sf_dir):
    return T(spark, sf_dir).lineitem.agg(F.count(F.lit(1)).alias("n_rows"))


@query("group_count", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority", "agg")
def group_count(spark, sf_dir):
    return T(spark, sf_dir).orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("daily_sums", """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow,
       count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
FROM orders GROUP BY 1, 2""", "agg")
def daily_sums(spark, sf_dir):
    o = T(spark, sf_dir).orders
    return (o.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.dayofweek("o_orderdate").alias("dow"))
            .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price")))


@query("group_avg", """SELECT l_linenumber, round(avg(l_extendedprice), 6) AS avg_price, round(avg(l_quantity), 6) AS avg_qty
FROM lineitem GROUP BY l_linenumber""", "agg")
def group_avg(spark, sf_dir):
    return T(spark, sf_dir).lineitem.groupBy("l_linenumber").agg(
        F.round(F.avg("l_extendedprice"), 6).alias("avg_price"), F.round(F.avg("l_quantity"), 6).alias("avg_qty"))


@query("mean_median", """SELECT round(avg(l_extendedprice), 6) AS mean_price, round(quantile_cont(l_extendedprice, 0.5), 6) AS median_price
FROM lineitem""", "agg")
def mean_median(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    med = P.quantiles(li, ["l_extendedprice"], [0.5], ["median_price"])
    mean = li.agg(F.avg("l_extendedprice").alias("mean_price")).withColumn("feature", F.lit("l_extendedprice"))
    return round_doubles(mean.join(med, "feature").select("mean_price", "median_price"), 6)


@query("approx_median", """SELECT feature, count(value) AS n, true AS p25_within, true AS p50_within, true AS p75_within
FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
      ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE value) GROUP BY feature""", "agg")
def approx_median(spark, sf_dir):
    """Sketched quartiles of every column, and whether their ranks keep the sketch's error bound."""
    li = T(spark, sf_dir).lineitem
    accuracy, probs = 1000, [0.25, 0.5, 0.75]
    found = P.approx_quantiles(li, LI_NUMS, probs, accuracy)
    long = P.long_values(li, LI_NUMS).join(F.broadcast(found), "feature")  # a row per column
    n, v = F.count("value"), F.col("value")

    def within(i: int):
        below, upto = F.count_if(v < F.col("quantiles")[i]), F.count_if(v <= F.col("quantiles")[i])
        return ((below <= n * (probs[i] + 1 / accuracy) + 1) & (upto >= n * (probs[i] - 1 / accuracy) - 1)).alias(f"p{int(100 * probs[i])}_within")

    return long.groupBy("feature").agg(n.alias("n"), *[within(i) for i in range(3)])


DESCRIBE_SQL = """SELECT feature, count(value) AS "count", round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev,
       round(min(value), 6) AS "min", round(max(value), 6) AS "max"
FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
      ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE value) GROUP BY feature"""


@query("describe_typed", DESCRIBE_SQL, "profile")
def describe_typed(spark, sf_dir):
    return round_doubles(P.describe(T(spark, sf_dir).lineitem, LI_NUMS), 6)


SUMMARY_SQL = """SELECT feature, count(value) AS "count", round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev,
       round(min(value), 6) AS "min", round(max(value), 6) AS "max", round(quantile_cont(value, 0.25), 6) AS p25,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75
FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
      ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE value) GROUP BY feature"""


@query("summary_typed", SUMMARY_SQL, "profile")
def summary_typed(spark, sf_dir):
    return round_doubles(P.summary(T(spark, sf_dir).lineitem, LI_NUMS), 6)


PROFILE_SQL = f"""WITH s AS ({LINEITEM_NULLS_SQL}),
l AS (SELECT * FROM (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM s)
      UNPIVOT INCLUDE NULLS (value FOR feature IN (l_quantity, l_extendedprice, l_discount, l_tax))),
m AS (SELECT feature, value AS mode FROM (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) AS rn
      FROM l WHERE value IS NOT NULL GROUP BY feature, value) WHERE rn = 1)
SELECT l.feature, count(*) AS n_rows, count(*) FILTER (WHERE value IS NULL) AS n_missing, count(DISTINCT value) AS n_distinct,
       round(min(value), 6) AS "min", round(max(value), 6) AS "max", round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS std, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75, round(max(m.mode), 6) AS mode
FROM l JOIN m USING (feature) GROUP BY l.feature"""


@query("column_profile", PROFILE_SQL, "profile")
def column_profile(spark, sf_dir):
    return round_doubles(P.column_profile(lineitem_nulls(T(spark, sf_dir)), LI_NUMS), 6)


CATPROF_SQL = f"""WITH s AS ({LINEITEM_NULLS_SQL}),
l AS (SELECT * FROM (SELECT l_returnflag, l_linestatus FROM s) UNPIVOT INCLUDE NULLS (value FOR feature IN (l_returnflag, l_linestatus))),
c AS (SELECT feature, value, count(*) AS c, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) AS rn
      FROM l WHERE value IS NOT NULL GROUP BY feature, value)
SELECT l.feature, count(*) AS n_rows, count(*) FILTER (WHERE value IS NULL) AS n_missing,
       (SELECT count(*) FROM c WHERE c.feature = l.feature) AS n_unique,
       (SELECT value FROM c WHERE c.feature = l.feature AND rn = 1) AS mode,
       (SELECT c FROM c WHERE c.feature = l.feature AND rn = 1) AS mode_count
FROM l GROUP BY l.feature"""


@query("category_profile", CATPROF_SQL, "profile")
def category_profile(spark, sf_dir):
    return P.category_profile(lineitem_nulls(T(spark, sf_dir)), ["l_returnflag", "l_linestatus"])


@query("value_counts", f"SELECT l_returnflag, count(*) AS count FROM ({LINEITEM_NULLS_SQL}) WHERE l_returnflag IS NOT NULL GROUP BY 1",
       "profile")
def value_counts(spark, sf_dir):
    return P.value_counts(lineitem_nulls(T(spark, sf_dir)), "l_returnflag")


@query("distinct_values", "SELECT DISTINCT p_brand, p_type FROM part", "profile")
def distinct_values(spark, sf_dir):
    return T(spark, sf_dir).part.select("p_brand", "p_type").distinct()


# ----------------------------------------------------------------------------- sorts, limits
@query("sort_multi", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand", "sort")
def sort_multi(spark, sf_dir):
    return (T(spark, sf_dir).part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("p_brand")))


@query("top_k", """SELECT l_partkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
FROM lineitem GROUP BY l_partkey ORDER BY sum(l_extendedprice * (1 - l_discount)) DESC, l_partkey LIMIT 10""", "sort")
def top_k(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    g = li.groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("_rev"))
    return g.orderBy(F.desc("_rev"), F.asc("l_partkey")).limit(10).select("l_partkey", F.round("_rev", 4).alias("revenue"))


@query("latest_per_key", """SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS last_order_day, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""", "sort")
def latest_per_key(spark, sf_dir):
    o = T(spark, sf_dir).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    last = K.latest_per_key(o, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return last.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_order_day"),
                       "o_totalprice")


@query("sql_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10", "scan")
def sql_limit(spark, sf_dir):
    T(spark, sf_dir).orders.createOrReplaceTempView("orders_view")
    return spark.sql("SELECT * FROM orders_view ORDER BY o_orderkey LIMIT 10")


# ----------------------------------------------------------------------------- sets / dedup
@query("union_all", """SELECT o_orderstatus, count(*) AS n FROM (
  SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' UNION ALL SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
GROUP BY o_orderstatus""", "sets")
def union_all(spark, sf_dir):
    o = T(spark, sf_dir).orders
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    u = o.filter(F.col("o_orderdate") < cut).unionByName(o.filter(F.col("o_orderdate") >= cut))
    return u.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("dedup_normalised", f"""SELECT src_id, name, ssn, segment, salary FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(name), replace(ssn, '-', '') ORDER BY src_id, name, ssn, segment, salary) AS rn
  FROM {PEOPLE_SQL}) WHERE rn = 1""", "sets")
def dedup_normalised(spark, sf_dir):
    p = people(T(spark, sf_dir))
    return K.dedup_normalised(p, {"_k_name": F.lower("name"), "_k_ssn": F.regexp_replace("ssn", "-", "")},
                              ["src_id", "name", "ssn", "segment", "salary"])


# ----------------------------------------------------------------------------- scalar functions
@query("clean_money", """SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) AS price_text,
       CAST(replace(replace('$' || format('{:,.2f}', o_totalprice), '$', ''), ',', '') AS DOUBLE) AS price FROM orders""", "functions")
def clean_money(spark, sf_dir):
    o = T(spark, sf_dir).orders
    text = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return o.select("o_orderkey", text.alias("price_text")).withColumn("price", C.clean_money("price_text"))


@query("log_exp", """SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 8) AS ln_price, round(log10(l_extendedprice), 8) AS log10_price,
       round(exp(ln(l_extendedprice)), 4) AS back, abs(l_quantity - 25) AS dist, l_linenumber % 3 AS m3 FROM lineitem""", "functions")
def log_exp(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", F.round(F.log("l_extendedprice"), 8).alias("ln_price"),
                     F.round(F.log10("l_extendedprice"), 8).alias("log10_price"),
                     F.round(F.exp(F.log("l_extendedprice")), 4).alias("back"),
                     F.abs(F.col("l_quantity") - 25).alias("dist"), (F.col("l_linenumber") % 3).alias("m3"))


@query("date_parts", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS dom, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
       "functions")
def date_parts(spark, sf_dir):
    o = T(spark, sf_dir).orders
    d = F.col("o_orderdate")
    return o.select("o_orderkey", F.date_format(d, "yyyy-MM-dd").alias("day"), F.dayofweek(d).alias("dow"),
                    F.month(d).alias("month"), F.dayofmonth(d).alias("dom"), F.year(d).alias("year"))


FP_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("dataset_fingerprint", f"""SELECT 'orders' AS dataset, count(*) AS n_rows,
       CAST(sum(CAST(('0x' || substr(md5(concat({", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-;')" for c in FP_COLS)})), 1, 8)) AS BIGINT)) % 4294967291 AS BIGINT) AS fingerprint
FROM orders""", "functions")
def dataset_fingerprint(spark, sf_dir):
    o = T(spark, sf_dir).orders.select(*FP_COLS)
    return H.dataset_fingerprint(o).select(F.lit("orders").alias("dataset"), "n_rows", "fingerprint")


@query("fingerprint_equal", """SELECT true AS same_data, false AS changed_data""", "functions")
def fingerprint_equal(spark, sf_dir):
    """Fingerprints are order/partition free: a shuffled copy matches, a modified copy does not."""
    o = T(spark, sf_dir).orders.select(*FP_COLS)
    fps = (H.dataset_fingerprint(o).withColumn("copy", F.lit("original"))
           .unionByName(H.dataset_fingerprint(o.repartition(7, "o_custkey")).withColumn("copy", F.lit("shuffled")))
           .unionByName(H.dataset_fingerprint(o.withColumn("o_totalprice", F.col("o_totalprice") + 0.01))
                        .withColumn("copy", F.lit("changed"))))
    fp = F.struct("n_rows", "fingerprint")
    g = fps.agg(F.max(F.when(F.col("copy") == "original", fp)).alias("a"),
                F.max(F.when(F.col("copy") == "shuffled", fp)).alias("b"),
                F.max(F.when(F.col("copy") == "changed", fp)).alias("c"))
    return g.select((F.col("a") == F.col("b")).alias("same_data"), (F.col("a") == F.col("c")).alias("changed_data"))


@query("events_props_json", """SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k,
       count(*) AS n FROM events GROUP BY event_type""", "functions")
def events_props_json(spark, sf_dir):
    ev = T(spark, sf_dir).events
    parsed = ev.select("event_type", F.from_json("props", "k INT").alias("p"))
    return parsed.groupBy("event_type").agg(F.sum("p.k").alias("sum_k"), F.count(F.lit(1)).alias("n"))


@query("answer_hash", """SELECT p_brand, count(*) AS n, CAST(('0x' || substr(md5(CAST(count(*) AS VARCHAR)), 1, 8)) AS BIGINT) AS answer_hash
FROM part GROUP BY p_brand""", "functions")
def answer_hash(spark, sf_dir):
    """Answers with their fingerprint (md5 form), so that a checker need not hold the answer."""
    g = T(spark, sf_dir).part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("answer_hash", H.answer_hash("n"))


# ----------------------------------------------------------------------------- splits
HASH_SQL = "(CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) % {m})"


@query("hash_split", f"""SELECT CASE WHEN {HASH_SQL.format(k='o_orderkey', m=100)} < 80 THEN 'train' ELSE 'test' END AS split,
       count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""", "split")
def hash_split(spark, sf_dir):
    o = T(spark, sf_dir).orders
    train, test = H.hash_split(o, "o_orderkey", 80)
    agg = [F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")]
    return (train.agg(*agg).select(F.lit("train").alias("split"), "n", "total")
            .unionByName(test.agg(*agg).select(F.lit("test").alias("split"), "n", "total")))


@query("hash_split3", f"""SELECT CASE WHEN b < 60 THEN 'train' WHEN b < 80 THEN 'val' ELSE 'test' END AS split, count(*) AS n
FROM (SELECT {HASH_SQL.format(k='l_orderkey', m=100)} AS b FROM lineitem) GROUP BY 1""", "split")
def hash_split3(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    parts = H.hash_split3(li, "l_orderkey")
    out = None
    for name, df in zip(["train", "val", "test"], parts):
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("split"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("time_split", """SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'train' ELSE 'test' END AS split, count(*) AS n
FROM orders GROUP BY 1""", "split")
def time_split(spark, sf_dir):
    o = T(spark, sf_dir).orders
    cond = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return o.select(F.when(cond, "train").otherwise("test").alias("split")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("split_complement_anti", f"""SELECT o_orderkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE {HASH_SQL.format(k='s.o_orderkey', m=2)} = 0 AND s.o_orderkey = o.o_orderkey)""",
       "split")
def split_complement_anti(spark, sf_dir):
    o = T(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    half = o.filter(H.md5_bucket("o_orderkey", 2) == 0)
    return o.join(half.select("o_orderkey"), "o_orderkey", "left_anti")


@query("fold_sizes", f"""SELECT CAST({HASH_SQL.format(k='o_orderkey', m=3)} AS INTEGER) AS fold, count(*) AS n FROM orders GROUP BY 1""",
       "split")
def fold_sizes(spark, sf_dir):
    o = T(spark, sf_dir).orders
    return o.select(H.fold_col("o_orderkey", 3).alias("fold")).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("sample_rows", "SELECT count(*) AS n_rows, true AS share_ok, true AS all_from_table FROM lineitem", "split")
def sample_rows(spark, sf_dir):
    """A seeded tenth of the rows: its share, and that each sampled row is one of the table."""
    li = T(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    key = [F.col(c) for c in li.columns]
    both = li.withColumn("w", F.lit(0)).unionByName(li.sample(fraction=0.1, seed=42).withColumn("w", F.lit(1)))
    per = both.groupBy(*key).agg(F.count_if(F.col("w") == 0).alias("a"), F.count_if(F.col("w") == 1).alias("s"))
    share = F.sum("s") / F.sum("a")
    return per.agg(F.sum("a").alias("n_rows"), share.between(0.08, 0.12).alias("share_ok"), F.bool_and(F.col("s") <= F.col("a")).alias("all_from_table"))


@query("random_split", "SELECT count(*) AS n_rows, true AS share_ok, true AS complete, true AS disjoint FROM lineitem", "split")
def random_split(spark, sf_dir):
    """Seeded 80/20 split: the parts are disjoint and together the table."""
    li = T(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber")
    train, test = li.randomSplit([0.8, 0.2], seed=42)
    both = li.withColumn("w", F.lit(0)).unionByName(train.withColumn("w", F.lit(1))).unionByName(test.withColumn("w", F.lit(2)))
    per = both.groupBy("l_orderkey", "l_linenumber").agg(*[F.count_if(F.col("w") == i).alias(f"n{i}") for i in range(3)])
    return per.agg(F.sum("n0").alias("n_rows"), (F.sum("n1") / F.sum("n0")).between(0.78, 0.82).alias("share_ok"),
                   F.bool_and(F.col("n1") + F.col("n2") == F.col("n0")).alias("complete"),
                   F.bool_and((F.col("n1") == 0) | (F.col("n2") == 0) | (F.col("n0") > 1)).alias("disjoint"))


@query("simulated_shift", """SELECT l_orderkey, l_linenumber, l_extendedprice + 20000 AS l_extendedprice,
       round(CASE WHEN l_quantity > 25 THEN l_discount + 0.05 ELSE l_tax END, 8) AS l_tax,
       CASE WHEN l_returnflag = 'N' AND l_quantity % 3 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem""", "split")
def simulated_shift(spark, sf_dir):
    from driftline.plans.fixtures import shifted_current
    s = shifted_current(T(spark, sf_dir).lineitem)
    return s.select("l_orderkey", "l_linenumber", "l_extendedprice", F.round("l_tax", 8).alias("l_tax"), "l_returnflag")


@query("iot_features", """SELECT event_id, CAST(user_id % 12 AS INTEGER) AS user_group, value,
       CAST(event_id % 100 AS DOUBLE) / 10 AS tail, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       round(value * 2 + (event_id % 100) / 10.0, 6) AS label FROM events""", "scan")
def iot_features(spark, sf_dir):
    from driftline.plans.ml_fixtures import grouped_facts
    return grouped_facts(T(spark, sf_dir))


# ----------------------------------------------------------------------------- joins
@query("left_join_groups", """WITH g AS (SELECT l_partkey, avg(l_quantity) AS avg_qty, count(*) AS n_lines FROM lineitem GROUP BY l_partkey)
SELECT p_partkey, p_brand, round(g.avg_qty, 6) AS avg_qty, g.n_lines FROM part LEFT JOIN g ON part.p_partkey = g.l_partkey""", "join")
def left_join_groups(spark, sf_dir):
    t = T(spark, sf_dir)
    g = t.lineitem.groupBy("l_partkey").agg(F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
                                            F.count(F.lit(1)).alias("n_lines"))
    return (t.part.select("p_partkey", "p_brand")
            .join(g.withColumnRenamed("l_partkey", "p_partkey"), "p_partkey", "left"))


@query("rand_features", None, "functions")
def rand_features(spark, sf_dir):
    """Seeded random columns (scaled / shifted uniform and normal) added to the IoT facts."""
    from driftline.plans.ml_fixtures import grouped_facts
    f = grouped_facts(T(spark, sf_dir))
    return f.select("event_id", "user_group", (F.rand(42) * 10 + 5).alias("u_5_15"), (F.randn(7) * 2 + 100).alias("n_100_2"))


@query("latest_versions", "SELECT o_orderpriority AS name, CAST(max(o_custkey % 1500) AS INTEGER) AS latest_version FROM orders GROUP BY 1", "agg")
def latest_versions(spark, sf_dir):
    """Newest version per name where versions are text: compared as numbers, so that 10 follows 9."""
    v = T(spark, sf_dir).orders.select(F.col("o_orderpriority").alias("name"), (F.col("o_custkey") % 1500).cast("string").alias("version"))
    return latest_version(v)


# ----------------------------------------------------------------------------- ordered statistics per key of the data
@query("quantiles_per_key", """SELECT user_id, count(value) AS n, count(DISTINCT value) AS n_distinct, round(quantile_cont(value, 0.25), 6) AS p25,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, round(min(m.mode), 6) AS mode
FROM events JOIN (SELECT user_id, value AS mode FROM events GROUP BY user_id, value
                  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, value) = 1) m USING (user_id) GROUP BY user_id""", "profile")
def quantiles_per_key(spark, sf_dir):
    """Exact quartiles and mode for every user: as many keys as the data have, a hot one over many tasks."""
    st = value_statistics(T(spark, sf_dir).events.select("user_id", "value"), ["user_id"])
    return round_doubles(st.select("user_id", "n", "n_distinct", "p25", "p50", "p75", "mode"), 6)


@query("running_minimum", """SELECT o_orderkey, round(min(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS lowest FROM orders""", "agg")
def running_minimum(spark, sf_dir):
    """Lowest order so far per priority, in date order: five keys, cut into as many segments as there are rows for."""
    o = T(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority", F.struct("o_orderdate", "o_orderkey").alias("at"), "o_totalprice")
    low = prefix_min(o, ["o_orderpriority"], "at", "o_totalprice", "lowest", n_keys=None)
    return low.select("o_orderkey", F.round("lowest", 4).alias("lowest"))
