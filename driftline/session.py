"""Session helpers: a tuned local session for tests/bench and a shared work folder.

On a cluster the caller owns the session; nothing here overrides settings it already carries.
Lineage cuts and scratch tables go under ``spark.checkpoint.dir`` (a shared folder on a
cluster); only when it is unset (tests, local runs) do we create one.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "driftline",
                  extra: dict | None = None) -> SparkSession:
    """Local session used by tests and the benchmark (never on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("DRIFTLINE_DRIVER_MEMORY", "16g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a local one only if none is configured."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        # a folder on the driver's disk is invisible to executors and lost with the driver
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this cluster")
    local = tempfile.mkdtemp(prefix="driftline-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def work_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh folder (URI) for tables a job writes, under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/driftline/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Work folders that are made inside this scope are deleted at its end, also after an error. For
    callers that write an operator's result: ``with scratch(spark): op(df).write.parquet(path)``. A
    frame that reads such a folder cannot be used after the scope; what is to stay is written
    elsewhere. Scopes nest; folders of the outer one stay until it ends."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``driftline`` importable in the Python workers (pandas UDFs pickle references to
    its functions): zip the package once per application and ``addPyFile`` it, which Spark
    distributes to every executor."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="driftline-py-"), "driftline.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as a parquet table in a fresh folder under the shared checkpoint
    folder and return a reader over it: a lineage cut that survives executor loss, costs one
    job (an eager ``checkpoint`` runs its input twice: once to count, once to write), and is
    read back columnar with column pruning."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_small(df: DataFrame) -> DataFrame:
    """Lineage cut for a table with a known small bound (one row per feature, per category,
    per day): a reliable eager ``checkpoint`` under ``spark.checkpoint.dir``. Running its small
    input twice costs less than a table commit; data-sized tables use :func:`materialize`."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
