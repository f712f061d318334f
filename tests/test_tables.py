"""Versioned tables, feature store, file sinks, catalog tables."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftline.sources import files as FL
from driftline.sources.featurestore import FeatureLookup, FeatureStore
from driftline.sources.versions import VersionedTable, schema_diff
from conftest import SF001


def _orders(spark):
    return spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def test_versions_time_travel_and_modes(spark, tmp_uri):
    o = _orders(spark)
    vt = VersionedTable(spark, f"{tmp_uri}/t")
    assert vt.write(o.filter("o_orderstatus = 'F'")) == 0
    with pytest.raises(FileExistsError):
        vt.write(o)  # default mode refuses an existing table
    assert vt.write(o, mode="overwrite") == 1
    assert vt.write(o.limit(5), mode="append") == 2
    n_f = o.filter("o_orderstatus = 'F'").count()
    assert vt.read(version=0).count() == n_f
    assert vt.read().count() == o.count() + 5
    ts1 = vt.history().filter("version = 1").first()["ts"]
    assert vt.read(timestamp=ts1).count() == o.count()
    with pytest.raises(ValueError):
        vt.write(o.select("o_orderkey"), mode="overwrite")  # schema change needs overwrite_schema
    assert [r["version"] for r in vt.history().collect()] == [2, 1, 0]


def test_expired_versions_follow_the_retention(spark, tmp_uri):
    """Retention runs from when a version was superseded, however old its data are; nothing is deleted."""
    o = _orders(spark)
    vt = VersionedTable(spark, f"{tmp_uri}/r")
    vt.write(o)
    vt.write(o.limit(7), mode="append")
    vt.write(o.limit(5), mode="overwrite")
    soon = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=100)
    assert vt.expired() == [] and vt.expired(now=soon) == [] and vt.expired(retention_hours=0) == [0, 1]
    assert vt.expired(now=soon + dt.timedelta(hours=100)) == [0, 1]
    assert vt.read(version=0).count() == o.count() and vt.read(version=1).count() == o.count() + 7 and vt.read().count() == 5


def test_unfinished_snapshot_is_not_seen(spark, tmp_uri):
    o = _orders(spark)
    vt = VersionedTable(spark, f"{tmp_uri}/u")
    vt.write(o)
    o.write.parquet(f"{tmp_uri}/u/epoch=1/snapshot=1")  # a writer that died before its schema file
    assert vt.version_of() == 0 and vt.read().count() == o.count()
    assert vt.write(o.limit(3), mode="overwrite") == 1 and vt.read().count() == 3


def test_appends_are_one_scan(spark, tmp_uri):
    vt = VersionedTable(spark, f"{tmp_uri}/a")
    for i in range(4):
        vt.write(_orders(spark).limit(10), mode="append" if i else "error")
    plan = vt.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Union" not in plan and vt.read(version=2).count() == 30


def test_changes_between_versions(spark, tmp_uri):
    vt = VersionedTable(spark, f"{tmp_uri}/c")
    vt.write(spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (5, None, None)], "k int, s string, x double"))
    vt.write(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, None, None), (5, None, None)], "k int, s string, x double"), mode="overwrite")
    got = {r["k"]: (r["change"], r["before"] and tuple(r["before"]), r["after"] and tuple(r["after"])) for r in vt.changes(0, 1, ["k"]).collect()}
    assert got == {2: ("updated", ("b", None), ("b", 2.0)), 3: ("removed", ("c", 3.0), None), 4: ("added", None, (None, None))}


def test_partitioned_append_reads_back(spark, tmp_uri):
    o = _orders(spark)
    vt = VersionedTable(spark, f"{tmp_uri}/p")
    vt.write(o, partition_by=["o_orderstatus"])
    vt.write(o, mode="append", partition_by=["o_orderstatus"])
    vt.write(o.withColumn("extra", F.lit(1)), mode="append", merge_schema=True)
    got = vt.read()
    assert got.columns == [*o.columns, "extra"] and got.count() == 3 * o.count()
    per = {r["o_orderstatus"]: r["count"] for r in got.groupBy("o_orderstatus").count().collect()}
    assert per == {r["o_orderstatus"]: 3 * r["count"] for r in o.groupBy("o_orderstatus").count().collect()}


def test_schema_merge_and_diff(spark, tmp_uri):
    c = spark.read.parquet(f"{SF001}/customer.parquet")
    vt = VersionedTable(spark, f"{tmp_uri}/m")
    vt.write(c.select("c_custkey", "c_name"))
    with pytest.raises(ValueError):
        vt.write(c.select("c_custkey", "c_name", "c_acctbal"), mode="append")
    vt.write(c.select("c_custkey", "c_name", "c_acctbal"), mode="append", merge_schema=True)
    r = vt.read()
    assert r.columns == ["c_custkey", "c_name", "c_acctbal"]
    assert r.filter(F.col("c_acctbal").isNull()).count() == c.count()
    d = schema_diff(c.select("c_custkey", "c_name").schema, c.select("c_custkey", F.col("c_name").cast("int"), "c_acctbal").schema)
    assert d == [("c_acctbal", None, "double"), ("c_name", "string", "int")]


def test_feature_store_semantics(spark, tmp_uri):
    c = spark.read.parquet(f"{SF001}/customer.parquet")
    fs = FeatureStore(spark, tmp_uri)
    fs.create_table("cust", ["c_custkey"], df=c.select("c_custkey", "c_acctbal", "c_nationkey"), description="d")
    assert fs.get_table("cust")["primary_keys"] == ["c_custkey"]
    with pytest.raises(ValueError):
        fs.write_table("cust", c.select("c_custkey", "c_acctbal").unionByName(c.select("c_custkey", "c_acctbal").limit(1)))
    # merge: matched rows updated, new column added, explicit null overwrites
    upd = c.filter("c_custkey < 5").select("c_custkey", F.lit(None).cast("double").alias("c_acctbal"),
                                          F.lit("x").alias("c_mktsegment"))
    fs.write_table("cust", upd, mode="merge")
    t = fs.read_table("cust")
    assert t.count() == c.count()
    assert t.filter("c_custkey < 5 AND c_acctbal IS NULL AND c_mktsegment = 'x'").count() == 5
    assert t.filter("c_custkey >= 5 AND c_mktsegment IS NULL").count() == c.count() - 5
    # overwrite keeps dropped columns as nulls
    fs.write_table("cust", c.select("c_custkey", "c_acctbal"), mode="overwrite")
    t2 = fs.read_table("cust")
    assert set(t2.columns) >= {"c_nationkey", "c_mktsegment"} and t2.filter("c_nationkey IS NOT NULL").count() == 0
    # training set: caller columns kept, lookups joined, excluded dropped
    o = _orders(spark)
    ts = fs.create_training_set(o, [FeatureLookup("cust", ["o_custkey"], ["c_acctbal"])], label="o_totalprice",
                                exclude_columns=["o_orderstatus"])
    assert ts.load_df().columns == ["o_custkey", "o_orderkey", "o_totalprice", "c_acctbal"]
    assert ts.load_df().count() == o.count()
    fs.drop_table("cust")


def _files_by_bucket(spark, fs, name):
    rows = fs.read_table(name).select(F.input_file_name().alias("f")).distinct().collect()
    by = {}
    for r in rows:
        by.setdefault(re.search(r"_bucket=(\d+)", r["f"])[1], set()).add(r["f"])
    return by


def test_merge_leaves_untouched_buckets_alone(spark, tmp_uri):
    fs = FeatureStore(spark, tmp_uri)
    base = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 1.5).alias("x"))
    fs.create_table("t", ["k"], df=base, buckets=16)
    before = _files_by_bucket(spark, fs, "t")
    assert len(before) == 16
    fs.write_table("t", spark.createDataFrame([(3, -1.0), (5000, -2.0)], "k bigint, x double"))
    after = _files_by_bucket(spark, fs, "t")
    touched = [b for b in after if after[b] != before.get(b)]
    assert 1 <= len(touched) <= 2 and all(after[b] == before[b] for b in after if b not in touched)
    now = {r["k"]: r["x"] for r in fs.read_table("t").collect()}
    assert now == {i: i * 1.5 for i in range(1000)} | {3: -1.0, 5000: -2.0}
    assert {r["k"]: r["x"] for r in fs.read_table("t", version=0).collect()} == {i: i * 1.5 for i in range(1000)}
    fs.write_table("t", spark.createDataFrame([(7, 0.0)], "k bigint, x double"), mode="overwrite")  # no old bucket comes back
    assert [tuple(r) for r in fs.read_table("t").collect()] == [(7, 0.0)]


def test_merge_refuses_null_and_repeated_keys(spark, tmp_uri):
    fs = FeatureStore(spark, tmp_uri)
    fs.create_table("t", ["a", "b"], df=spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], "a int, b string, v double"), buckets=4)
    for bad in ([(None, "x", 1.0)], [(2, None, 1.0)], [(9, "hot", float(i)) for i in range(500)]):
        with pytest.raises(ValueError):
            fs.write_table("t", spark.createDataFrame(bad, "a int, b string, v double"))
    assert fs.history("t").count() == 1 and fs.read_table("t").count() == 2
    fs.write_table("t", spark.createDataFrame([], "a int, b string, v double"))
    assert fs.read_table("t").count() == 2


def test_merge_into_a_table_declared_by_schema(spark, tmp_uri):
    fs = FeatureStore(spark, tmp_uri)
    rows = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    fs.create_table("t", ["k"], schema=rows.schema)
    fs.write_table("t", rows)
    fs.write_table("t", spark.createDataFrame([(2, 5.0)], "k int, v double"))
    assert sorted(map(tuple, fs.read_table("t").collect())) == [(1, 1.0), (2, 5.0)]


def test_logged_model_scores_from_keys_and_keeps_its_version(spark, tmp_uri):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    c = spark.read.parquet(f"{SF001}/customer.parquet")
    o = _orders(spark)
    fs = FeatureStore(spark, tmp_uri)
    fs.create_table("cust", ["c_custkey"], df=c.select("c_custkey", "c_acctbal"))
    assert any(s.endswith("customer.parquet") for s in fs.get_table("cust")["sources"])
    ts = fs.create_training_set(o.withColumn("rush", F.lit(1.0)), [FeatureLookup("cust", ["o_custkey"])], label="o_totalprice",
                                exclude_columns=["o_orderstatus"])
    stages = [VectorAssembler(inputCols=["c_acctbal", "rush"], outputCol="features"), LinearRegression(labelCol="o_totalprice")]
    model = Pipeline(stages=stages).fit(ts.load_df())
    record = fs.log_model("m1", model, ts)
    assert record["features"] == ["c_acctbal"] and "rush" in record["caller_columns"] and record["label"] == "o_totalprice"
    assert record["lookups"] == [{"table_name": "cust", "lookup_key": ["o_custkey"], "feature_names": ["c_acctbal"], "version": 0}]
    with pytest.raises(FileExistsError):
        fs.log_model("m1", model, ts)
    keys = o.select("o_orderkey", "o_custkey", F.lit(1.0).alias("rush"))
    want = {r["o_orderkey"]: r["prediction"] for r in fs.score_batch("m1", keys).collect()}
    fs.write_table("cust", c.select("c_custkey", F.lit(0.0).alias("c_acctbal"), "c_nationkey"))
    assert {r["o_orderkey"]: r["prediction"] for r in fs.score_batch("m1", keys).collect()} == want
    direct = {r["o_orderkey"]: r["prediction"] for r in model.transform(ts.load_df()).select("o_orderkey", "prediction").collect()}
    assert direct == want


def test_write_exactly_n_files_and_partitions(spark, tmp_uri):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    FL.write_n_files(li, f"{tmp_uri}/n", 8)
    assert FL.file_inventory(spark.read.parquet(f"{tmp_uri}/n")).count() == 8
    FL.write_partitioned(li, f"{tmp_uri}/p", ["l_returnflag"])
    q = spark.read.parquet(f"{tmp_uri}/p").filter("l_returnflag = 'R'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(l_returnflag" in plan
    assert q.count() == li.filter("l_returnflag = 'R'").count()


def test_clustered_rewrite_skips_files(spark, tmp_uri):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    FL.clustered_rewrite(li, f"{tmp_uri}/z", ["l_partkey"], 8)
    back = spark.read.parquet(f"{tmp_uri}/z")
    touched = back.filter("l_partkey < 20").select(F.input_file_name()).distinct().count()
    assert back.count() == li.count() and touched <= 2


def test_managed_table_and_ddl(spark, tmp_uri):
    spark.sql("CREATE DATABASE IF NOT EXISTS dl_test")
    spark.sql("USE dl_test")
    _orders(spark).write.mode("overwrite").saveAsTable("orders_managed")
    assert "orders_managed" in [t.name for t in spark.catalog.listTables("dl_test")]
    _orders(spark).write.mode("overwrite").parquet(f"{tmp_uri}/ext")
    spark.sql(f"CREATE TABLE orders_ext USING parquet LOCATION '{tmp_uri}/ext'")
    assert spark.table("orders_ext").count() == spark.table("orders_managed").count()
    spark.sql("DROP TABLE orders_ext")
    spark.sql("DROP TABLE orders_managed")
    spark.sql("USE default")
    spark.sql("DROP DATABASE dl_test CASCADE")


def test_csv_with_ddl_schema(spark, tmp_uri):
    p = f"{tmp_uri}/c"
    FL.write_csv(_orders(spark), p)
    df = FL.read_csv(spark, p, schema="o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")
    assert isinstance(df.schema, StructType) and df.count() == _orders(spark).count()
