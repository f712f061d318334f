"""Type-driven column lists, bounded pulls, pandas API, version ordering, evolving features."""

import pandas as pd
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from driftline.functions.columns import columns_of_type, ints_to_double
from driftline.operators.runlog import latest_version
from driftline.sources.featurestore import FeatureLookup, FeatureStore
from driftline.sources.tables import from_pandas, head_pandas
from conftest import SF001


def test_columns_by_type(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    assert columns_of_type(li, "string") == ["l_returnflag", "l_linestatus"]
    nums = columns_of_type(li, "double", exclude=("l_extendedprice",))
    assert nums == ["l_quantity", "l_discount", "l_tax"]
    assert set(columns_of_type(ints_to_double(li), "integral")) == set()


def test_bounded_pull_and_local_frames(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    assert len(head_pandas(li, 7)) == 7
    df = from_pandas(spark, pd.DataFrame({"name": ["a", "b"], "value": [1.0, 2.0]}), "name string, value double")
    assert df.schema.simpleString() == "struct<name:string,value:double>"


def test_pandas_api_roundtrip(spark):
    import pyspark.pandas as ps
    psdf = ps.read_parquet(f"{SF001}/orders.parquet", columns=["o_orderpriority", "o_totalprice"])
    vc = psdf["o_orderpriority"].value_counts()
    assert int(vc.sum()) == psdf.shape[0]
    out = ps.sql("SELECT o_orderpriority, count(*) AS n FROM {t} GROUP BY o_orderpriority", t=psdf)
    assert sorted(out.to_pandas()["n"].tolist()) == sorted(vc.to_pandas().tolist())
    back = psdf.to_spark().pandas_api()
    assert back.shape == psdf.shape


def test_versions_compare_as_ints(spark):
    v = spark.createDataFrame([("m", "9"), ("m", "10"), ("m", "2")], "name string, version string")
    assert latest_version(v).first()["latest_version"] == 10


def test_models_pin_their_feature_version(spark, tmp_uri):
    """Retrain on evolved features while the first model keeps scoring on the version it used."""
    c = spark.read.parquet(f"{SF001}/customer.parquet")
    fs = FeatureStore(spark, tmp_uri)
    fs.create_table("cf", ["c_custkey"], df=c.select("c_custkey", "c_acctbal"))
    ts_v1 = fs.history("cf").first()["ts"]
    fs.write_table("cf", c.select("c_custkey", (F.col("c_nationkey") * 1.0).alias("nation_f")), mode="merge")
    keys = spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey", "o_custkey")
    m1 = SQLTransformer(statement="SELECT *, c_acctbal * 2 AS prediction FROM __THIS__")
    m2 = SQLTransformer(statement="SELECT *, c_acctbal * 2 + nation_f AS prediction FROM __THIS__")
    v1 = fs.create_training_set(keys, [FeatureLookup("cf", ["o_custkey"], ["c_acctbal"])], None, as_of_timestamp=ts_v1)
    s1 = m1.transform(v1.load_df())
    s2 = fs.score_batch(m2, keys, [FeatureLookup("cf", ["o_custkey"], ["c_acctbal", "nation_f"])])
    assert s1.count() == s2.count() == keys.count()
    assert s2.filter("prediction IS NULL").count() == 0


def test_materialize_writes_under_checkpoint_dir(spark):
    from driftline.session import ensure_checkpoint_dir, materialize
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    back = materialize(df, "t")
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    import re

    def norm(u):  # file:/a, file:///a and /a name the same local path
        return re.sub(r"^file:/+", "/", u)
    root = norm(ensure_checkpoint_dir(spark).rstrip("/"))
    files = back.inputFiles()
    assert files and all(norm(p).startswith(root) for p in files)


def test_no_local_checkpoint_fallback_on_a_cluster():
    """Without spark.checkpoint.dir, a non-local master must not get a driver-local folder."""
    import pytest
    from driftline.session import ensure_checkpoint_dir

    class _SC:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class _Executors(_SC):
        master = "local-cluster[2,1,1024]"

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Spark:
        sparkContext = _SC()
        conf = _Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark())
    _Spark.sparkContext = _Executors()
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark())


def test_scratch_scope_deletes_its_folders_alone(spark, tmp_uri):
    from driftline.session import materialize, scratch
    from driftline.sources.versions import path_exists
    kept = materialize(spark.range(5).toDF("id"), "kept")
    made = []
    with scratch(spark):
        made.append(materialize(spark.range(10).toDF("id"), "t"))
        with scratch(spark):
            made.append(materialize(spark.range(3).toDF("id"), "t"))
            made[1].write.parquet(f"{tmp_uri}/out")
        assert not path_exists(spark, made[1].inputFiles()[0]) and path_exists(spark, made[0].inputFiles()[0])
    assert not path_exists(spark, made[0].inputFiles()[0]) and kept.count() == 5 and spark.read.parquet(f"{tmp_uri}/out").count() == 3
    try:
        with scratch(spark):
            made.append(materialize(spark.range(3).toDF("id"), "t"))
            raise KeyError
    except KeyError:
        pass
    assert not path_exists(spark, made[2].inputFiles()[0])


def test_segments_follow_the_size(spark, monkeypatch):
    from driftline.operators import ecdf
    df = spark.range(100_000).withColumn("v", F.col("id") * 1.0)
    few = ecdf._num_segments(df)
    assert few == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(ecdf, "SEGMENT_BYTES", 10_000)
    assert ecdf._num_segments(df) >= 100_000 * 8 // 10_000


def test_stream_session_keeps_the_batch_setting(spark):
    from driftline.streaming import files as SF
    before = spark.conf.get("spark.sql.shuffle.partitions")
    s = SF.stream_session(spark, 3)
    assert s.conf.get("spark.sql.shuffle.partitions") == "3" and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_runs_keep_the_data_they_read(spark):
    from driftline.operators.runlog import RunLog
    from driftline.session import work_dir
    log = RunLog(spark, work_dir(spark, "runlog-data"))
    schema = "run_id string, parent_run_id string, experiment string, start_time timestamp, end_time timestamp"
    bare = spark.createDataFrame([("a", None, "e", None, None)], schema)
    log.log(bare, data_path="/data/x", data_version=2)
    own = spark.createDataFrame([("b", None, "e", None, None, {"data_version": "9", "k": "v"}), ("c", None, "e", None, None, None)], schema + ", params map<string,string>")
    log.log(own, data_path="/data/x", data_version=3)
    got = {r["run_id"]: r["params"] for r in log.runs().collect()}
    assert got == {"a": {"data_path": "/data/x", "data_version": "2"}, "b": {"data_path": "/data/x", "data_version": "9", "k": "v"},
                   "c": {"data_path": "/data/x", "data_version": "3"}}
    assert [r["run_id"] for r in log.runs_on("/data/x", 3).collect()] == ["c"] and log.runs_on("/data/x").count() == 3
