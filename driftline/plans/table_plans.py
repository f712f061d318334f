"""Versioned tables, file sources/sinks and feature tables."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from driftline.session import work_dir
from driftline.sources import files as FL
from driftline.sources.featurestore import FeatureLookup, FeatureStore, check_keys
from driftline.sources.tables import Tables
from driftline.sources.versions import VersionedTable
from driftline.plans.fixtures import PEOPLE_SQL, people
from driftline.plans.registry import query, round_doubles

def _orders(spark, sf_dir):
    return Tables(spark, sf_dir).orders


def _three_versions(spark, sf_dir) -> VersionedTable:
    """v0 = all orders, v1 = urgent ones a tenth dearer, v2 = of these, orders in process have gone."""
    o = _orders(spark, sf_dir)
    dearer = o.withColumn("o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") * 1.1)
                          .otherwise(F.col("o_totalprice")))
    vt = VersionedTable(spark, work_dir(spark, "versioned-orders"))
    vt.write(o)
    vt.write(dearer, mode="overwrite")
    vt.write(dearer.filter(F.col("o_orderstatus") != "P"), mode="overwrite")
    return vt


def _status_agg(df):
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


DEARER = "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 1.1 ELSE o_totalprice END"
AGG_SQL = "SELECT o_orderstatus, count(*) AS n, round(sum({p}), 2) AS total FROM orders {w} GROUP BY o_orderstatus"


@query("version_overwrite_latest", AGG_SQL.format(p=DEARER, w="WHERE o_orderstatus <> 'P'"), "versions")
def version_overwrite_latest(spark, sf_dir):
    return _status_agg(_three_versions(spark, sf_dir).read())


@query("version_as_of", AGG_SQL.format(p=DEARER, w=""), "versions")
def version_as_of(spark, sf_dir):
    return _status_agg(_three_versions(spark, sf_dir).read(version=1))


@query("timestamp_as_of", AGG_SQL.format(p="o_totalprice", w=""), "versions")
def timestamp_as_of(spark, sf_dir):
    vt = _three_versions(spark, sf_dir)
    ts0 = vt.history().filter(F.col("version") == 0).first()["ts"]
    return _status_agg(vt.read(timestamp=ts0))


@query("version_history", """SELECT 2 AS version, 'OVERWRITE' AS operation, 'overwrite' AS mode, count(*) AS n_rows FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 1, 'OVERWRITE', 'overwrite', count(*) FROM orders
UNION ALL SELECT 0, 'WRITE', 'error', count(*) FROM orders""", "versions")
def version_history(spark, sf_dir):
    return _three_versions(spark, sf_dir).history().select("version", "operation", "mode", "n_rows")


@query("version_changes", f"""SELECT o_orderpriority, change, count(*) AS n, round(sum(delta), 2) AS delta FROM (
  SELECT o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN 'removed' ELSE 'updated' END AS change,
         CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE {DEARER} - o_totalprice END AS delta
  FROM orders WHERE o_orderstatus = 'P' OR (o_orderpriority = '1-URGENT' AND o_totalprice * 1.1 <> o_totalprice)) GROUP BY 1, 2""", "versions")
def version_changes(spark, sf_dir):
    """What happened between the first and the last version, by key."""
    ch = _three_versions(spark, sf_dir).changes(0, 2, ["o_orderkey"])
    delta = F.coalesce("after.o_totalprice", F.lit(0.0)) - F.coalesce("before.o_totalprice", F.lit(0.0))
    return ch.groupBy(F.coalesce("after.o_orderpriority", "before.o_orderpriority").alias("o_orderpriority"), "change").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(delta), 2).alias("delta"))


@query("partitioned_read", """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_orderstatus""", "files")
def partitioned_read(spark, sf_dir):
    path = work_dir(spark, "partitioned-orders")
    FL.write_partitioned(_orders(spark, sf_dir), path, ["o_orderpriority"])
    back = spark.read.parquet(path).filter(F.col("o_orderpriority") == "1-URGENT")  # partition pruning
    return _status_agg(back)


@query("clustered_rewrite", """SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty, CAST(sum(l_partkey) AS BIGINT) AS parts
FROM lineitem GROUP BY l_returnflag""", "files")
def clustered_rewrite(spark, sf_dir):
    path = work_dir(spark, "clustered-lineitem")
    li = Tables(spark, sf_dir).lineitem
    FL.clustered_rewrite(li, path, ["l_partkey", "l_suppkey"], 8)
    back = spark.read.parquet(path)
    return back.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"),
                                            F.sum("l_partkey").alias("parts"))


@query("clustered_rewrite_typed", """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, true AS skips_files
FROM orders GROUP BY o_orderpriority""", "files")
def clustered_rewrite_typed(spark, sf_dir):
    """Clustering by a timestamp and a text column: a year of one priority lies in few of the files."""
    path = work_dir(spark, "clustered-orders")
    FL.clustered_rewrite(Tables(spark, sf_dir).orders, path, ["o_orderdate", "o_orderpriority"], 16)
    back = spark.read.parquet(path)
    box = back.filter((F.year("o_orderdate") == 1995) & (F.col("o_orderpriority") == "1-URGENT"))
    touched = box.select("_metadata.file_path").distinct().count()  # 16 names at most
    return back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
                                               F.lit(touched <= 8).alias("skips_files"))


@query("people_delimited", f"""SELECT segment, count(*) AS n, round(sum(salary), 2) AS salary FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(name), replace(ssn, '-', '') ORDER BY src_id, name, ssn) AS rn FROM {PEOPLE_SQL}) WHERE rn = 1 GROUP BY segment""",
       "files")
def people_delimited(spark, sf_dir):
    """People in text files whose separator is found by a vote of the lines, then de-duplicated."""
    from driftline.operators.keys import dedup_normalised
    path = work_dir(spark, "delimited-people")
    people(Tables(spark, sf_dir)).write.option("header", True).option("sep", ":").csv(path)
    back = FL.read_delimited(spark, path, schema="src_id long, name string, ssn string, segment string, salary double")
    d = dedup_normalised(back, {"_k_name": F.lower("name"), "_k_ssn": F.regexp_replace("ssn", "-", "")}, ["src_id", "name", "ssn", "segment", "salary"])
    return d.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("salary"), 2).alias("salary"))


@query("schema_merge", """SELECT count(*) AS n_rows, count(c_acctbal) AS n_acctbal, count(c_name) AS n_name FROM (
  SELECT c_custkey, c_name, NULL AS c_acctbal FROM customer UNION ALL
  SELECT c_custkey, c_name, c_acctbal FROM customer)""", "versions")
def schema_merge(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    vt = VersionedTable(spark, work_dir(spark, "merge-schema"))
    vt.write(c.select("c_custkey", "c_name"))
    vt.write(c.select("c_custkey", "c_name", "c_acctbal"), mode="append", merge_schema=True)
    return vt.read().agg(F.count(F.lit(1)).alias("n_rows"), F.count("c_acctbal").alias("n_acctbal"),
                         F.count("c_name").alias("n_name"))


@query("partitioned_append", "SELECT o_orderstatus, 2 * count(*) AS n, round(2 * sum(o_totalprice), 2) AS total FROM orders GROUP BY 1", "versions")
def partitioned_append(spark, sf_dir):
    """Append to a partitioned versioned table and read both folders back."""
    o = Tables(spark, sf_dir).orders
    vt = VersionedTable(spark, work_dir(spark, "partitioned"))
    vt.write(o, partition_by=["o_orderstatus"])
    vt.write(o, mode="append", partition_by=["o_orderstatus"])
    return vt.read().groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("vacuum_keeps_recent", "SELECT count(*) AS n_rows, round(sum(o_totalprice), 2) AS total FROM orders", "versions")
def vacuum_keeps_recent(spark, sf_dir):
    """A version superseded a moment ago is within the default retention and can be read."""
    o = Tables(spark, sf_dir).orders
    vt = VersionedTable(spark, work_dir(spark, "vacuum"))
    vt.write(o)
    vt.write(o.withColumn("o_totalprice", -F.col("o_totalprice")), mode="overwrite")
    kept = [v for v in (0, 1) if v not in vt.expired()]
    return vt.read(version=kept[0]).agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("csv_roundtrip", "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents", "files")
def csv_roundtrip(spark, sf_dir):
    path = work_dir(spark, "csv-documents")
    FL.write_csv(Tables(spark, sf_dir).documents.select("doc_id", "lang", "text"), path)
    back = FL.read_csv(spark, path, multiline=True)  # header, inferred types, multi-line quoted text
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.md5("text").alias("text_md5"))


@query("csv_ddl_schema", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1", "files")
def csv_ddl_schema(spark, sf_dir):
    path = work_dir(spark, "csv-orders")
    FL.write_csv(_orders(spark, sf_dir), path)
    back = FL.read_csv(spark, path, schema="o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                           "o_orderdate timestamp_ntz, o_orderpriority string")
    return _status_agg(back)


@query("json_roundtrip", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1", "files")
def json_roundtrip(spark, sf_dir):
    path = work_dir(spark, "json-events")
    Tables(spark, sf_dir).events.select("event_id", "event_type", "value", "props").write.json(path)
    back = FL.read_json_lines(spark, path, "event_id long, event_type string, value double, props string")
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("file_inventory", "SELECT 8 AS n_files, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem", "files")
def file_inventory(spark, sf_dir):
    path = work_dir(spark, "eight-files")
    FL.write_n_files(Tables(spark, sf_dir).lineitem, path, 8)
    found = FL.file_inventory(spark.read.parquet(path))
    return found.agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"))


@query("dedup_eight_files", f"""SELECT count(*) AS n_rows FROM (SELECT DISTINCT lower(name), replace(ssn, '-', '') FROM {PEOPLE_SQL})""",
       "files")
def dedup_eight_files(spark, sf_dir):
    """Dedup lab end to end: de-duplicate people, write exactly 8 part files, read back."""
    from driftline.operators.keys import dedup_normalised
    path = work_dir(spark, "dedup-people")
    d = dedup_normalised(people(Tables(spark, sf_dir)),
                         {"_k_name": F.lower("name"), "_k_ssn": F.regexp_replace("ssn", "-", "")},
                         ["src_id", "name", "ssn", "segment", "salary"])
    FL.write_n_files(d, path, 8)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))


# ----------------------------------------------------------------------------- feature tables
def _customer_features(spark, sf_dir):
    return Tables(spark, sf_dir).customer.select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")


@query("fs_key_uniqueness", f"""SELECT 'customer' AS tbl, count(*) AS n_rows, 0 AS n_null_keys,
       count(*) - count(DISTINCT c_custkey) AS n_duplicate_keys FROM customer
UNION ALL SELECT 'people', count(*), 0, count(*) - count(DISTINCT src_id) FROM {PEOPLE_SQL}""", "featurestore")
def fs_key_uniqueness(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = check_keys(t.customer, ["c_custkey"]).select(F.lit("customer").alias("tbl"), "*")
    b = check_keys(people(t), ["src_id"]).select(F.lit("people").alias("tbl"), "*")
    return a.unionByName(b).select("tbl", "n_rows", F.col("n_null_keys").cast("int").alias("n_null_keys"),
                                   "n_duplicate_keys")


def _fs_with_table(spark, sf_dir):
    fs = FeatureStore(spark, work_dir(spark, "featurestore"))
    fs.create_table("customer_features", ["c_custkey"], df=_customer_features(spark, sf_dir),
                    description="customer balance, nation and segment", partition_columns=None)
    return fs


@query("fs_overwrite_nulls", """SELECT c_custkey, round(c_acctbal * 2, 4) AS c_acctbal, CAST(NULL AS DOUBLE) AS c_nationkey,
       CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer""", "featurestore")
def fs_overwrite_nulls(spark, sf_dir):
    fs = _fs_with_table(spark, sf_dir)
    c = Tables(spark, sf_dir).customer
    fs.write_table("customer_features", c.select("c_custkey", (F.col("c_acctbal") * 2).alias("c_acctbal")), mode="overwrite")
    out = fs.read_table("customer_features")
    return out.select("c_custkey", F.round("c_acctbal", 4).alias("c_acctbal"),
                      F.col("c_nationkey").cast("double").alias("c_nationkey"), "c_mktsegment")


# first write: three market segments; merge: three segments overlapping the first on one, so the
# merge updates FURNITURE rows, adds HOUSEHOLD/MACHINERY rows and leaves two segments untouched
FS_FIRST = ("AUTOMOBILE", "BUILDING", "FURNITURE")
FS_UPDATE = ("FURNITURE", "HOUSEHOLD", "MACHINERY")
_IN = "c_mktsegment IN ({})".format

FS_MERGE_SQL = f"""WITH t AS (SELECT c_custkey, c_acctbal, c_nationkey FROM customer WHERE {_IN(", ".join(repr(x) for x in FS_FIRST))}),
u AS (SELECT c_custkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer WHERE {_IN(", ".join(repr(x) for x in FS_UPDATE))})
SELECT coalesce(t.c_custkey, u.c_custkey) AS c_custkey,
       round(CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE t.c_acctbal END, 4) AS c_acctbal,
       CAST(t.c_nationkey AS DOUBLE) AS c_nationkey, u.c_mktsegment FROM t FULL OUTER JOIN u ON t.c_custkey = u.c_custkey"""


def _fs_merged(spark, sf_dir):
    fs = FeatureStore(spark, work_dir(spark, "featurestore"))
    c = Tables(spark, sf_dir).customer
    fs.create_table("cf", ["c_custkey"], df=c.filter(F.col("c_mktsegment").isin(*FS_FIRST))
                    .select("c_custkey", "c_acctbal", "c_nationkey"))
    fs.write_table("cf", c.filter(F.col("c_mktsegment").isin(*FS_UPDATE)).select(
        "c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment"), mode="merge")
    return fs


@query("fs_merge", FS_MERGE_SQL, "featurestore")
def fs_merge(spark, sf_dir):
    out = _fs_merged(spark, sf_dir).read_table("cf")
    return out.select("c_custkey", F.round("c_acctbal", 4).alias("c_acctbal"),
                      F.col("c_nationkey").cast("double").alias("c_nationkey"), "c_mktsegment")


@query("fs_read_as_of", f"""SELECT c_custkey, c_acctbal, c_nationkey FROM customer
WHERE {_IN(", ".join(repr(x) for x in FS_FIRST))}""", "featurestore")
def fs_read_as_of(spark, sf_dir):
    fs = _fs_merged(spark, sf_dir)
    ts0 = fs.history("cf").filter(F.col("version") == 0).first()["ts"]
    return fs.read_table("cf", as_of_timestamp=ts0)


FS_TRAIN_SQL = """SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, o.o_totalprice AS label, c.c_acctbal, c.c_nationkey
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""


def _training_set(spark, sf_dir):
    fs = _fs_with_table(spark, sf_dir)
    labels = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderpriority",
                                                 F.col("o_totalprice").alias("label"))
    lookups = [FeatureLookup("customer_features", ["o_custkey"], ["c_acctbal", "c_nationkey"])]
    return fs, lookups, fs.create_training_set(labels, lookups, label="label")


@query("fs_training_set", FS_TRAIN_SQL, "featurestore")
def fs_training_set(spark, sf_dir):
    return _training_set(spark, sf_dir)[2].load_df()


@query("fs_score_pinned", """SELECT o.o_orderkey, round(0.5 * c.c_acctbal, 6) AS prediction_v1,
       round(0.5 * (c.c_acctbal + 100) + 2 * c.c_nationkey, 6) AS prediction_v2
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""", "featurestore")
def fs_score_pinned(spark, sf_dir):
    """Two models scored from keys alone: the first goes on with the features it was trained on
    after the table has changed and grown a column."""
    fs = FeatureStore(spark, work_dir(spark, "featurestore"))
    c = Tables(spark, sf_dir).customer
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey")
    fs.create_table("cf", ["c_custkey"], df=c.select("c_custkey", "c_acctbal"))
    for name, formula in (("v1", "0.5 * c_acctbal"), ("v2", "0.5 * c_acctbal + 2 * c_nationkey")):
        trained = fs.create_training_set(orders, [FeatureLookup("cf", ["o_custkey"])], label=None)
        fs.log_model(name, SQLTransformer(statement=f"SELECT *, {formula} AS prediction FROM __THIS__"), trained)
        if name == "v1":
            fs.write_table("cf", c.select("c_custkey", (F.col("c_acctbal") + 100).alias("c_acctbal"), "c_nationkey"), mode="merge")
    one, two = (fs.score_batch(m, orders).select("o_orderkey", F.col("prediction").alias(f"prediction_{m}")) for m in ("v1", "v2"))
    return round_doubles(one.join(two, "o_orderkey"), 6)


@query("fs_score_batch", """SELECT o.o_orderkey, round(0.5 * c.c_acctbal + 2 * c.c_nationkey, 6) AS prediction
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""", "featurestore")
def fs_score_batch(spark, sf_dir):
    fs, lookups, _ = _training_set(spark, sf_dir)
    model = SQLTransformer(statement="SELECT *, 0.5 * c_acctbal + 2 * c_nationkey AS prediction FROM __THIS__")
    keys = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey")
    scored = fs.score_batch(model, keys, lookups, result_type="double")
    return round_doubles(scored.select("o_orderkey", "prediction"), 6)
