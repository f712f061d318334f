"""Experiment run log as a plain table (the data side of experiment tracking).

Jobs append long rows ``(run_id, parent_run_id, experiment, start_time, end_time, kind, key,
value_str, value_num)``; readers pivot them back to one row per run with ``params`` /
``metrics`` / ``tags`` maps. Appends are idempotent per run id only by convention (a run is
written once); readers take the last value per (run, kind, key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG_COLS = ["run_id", "parent_run_id", "experiment", "start_time", "end_time", "kind", "key", "value_str", "value_num"]


class RunLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def log(self, runs: DataFrame, data_path: str | None = None, data_version: str | int | None = None) -> None:
        """Append runs given as rows with ``params`` / ``tags`` (map<string,string>) and
        ``metrics`` (map<string,double>) columns. ``data_path`` and ``data_version`` say what the runs
        read and become params of each; a run's own params of these names go first."""
        data = {"data_path": data_path, "data_version": None if data_version is None else str(data_version)}
        known = [F.lit(x) for k, v in data.items() if v is not None for x in (k, v)]
        if known:
            given = F.coalesce("params", F.create_map().cast("map<string,string>")) if "params" in runs.columns else F.create_map().cast("map<string,string>")
            fresh = F.map_filter(F.create_map(*known), lambda k, _: ~F.map_contains_key(given, k))
            runs = runs.withColumn("params", F.map_concat(given, fresh))
        base = ["run_id", "parent_run_id", "experiment", "start_time", "end_time"]
        # a row for the run itself, so that one without entries is kept
        parts = [runs.select(*base, F.lit("run").alias("kind"), F.lit("").alias("key"), F.lit(None).cast("string").alias("value_str"),
                             F.lit(None).cast("double").alias("value_num"))]
        for kind, col in (("param", "params"), ("tag", "tags"), ("metric", "metrics")):
            if col not in runs.columns:
                continue
            e = runs.select(*base, F.explode(col).alias("key", "v"))
            parts.append(e.select(*base, F.lit(kind).alias("kind"), "key",
                                  (F.col("v").cast("string") if kind != "metric" else F.lit(None).cast("string")).alias("value_str"),
                                  (F.col("v").cast("double") if kind == "metric" else F.lit(None).cast("double")).alias("value_num")))
        long = parts[0]
        for p in parts[1:]:
            long = long.unionByName(p)
        long.select(*LONG_COLS).write.mode("append").parquet(self.path)

    def long(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def runs(self) -> DataFrame:
        """One row per run, also of one without entries: params, tags, metrics maps (bounded by
        the keys of a run). Of a key logged again the value of the latest end time, then the
        largest value, counts."""
        run = ["run_id", "parent_run_id", "experiment", "start_time", "end_time"]
        lg = self.long()
        order = F.struct("end_time", F.coalesce("value_str", F.lit("")), F.coalesce("value_num", F.lit(float("-inf"))))
        last = lg.groupBy("run_id", "kind", "key").agg(F.max_by(F.struct("value_str", "value_num"), order).alias("v"))
        heads = lg.groupBy("run_id").agg(F.max(F.struct("end_time", "start_time", "experiment", "parent_run_id")).alias("h"))
        lg = last.select("run_id", "kind", "key", "v.*").join(heads.select("run_id", "h.*"), "run_id").select(*run, "kind", "key", "value_str", "value_num")
        entry = F.struct("key", F.coalesce("value_str", F.col("value_num").cast("string")).alias("v"))
        g = lg.groupBy("run_id", "parent_run_id", "experiment", "start_time", "end_time").agg(
            F.map_from_entries(F.collect_list(F.when(F.col("kind") == "param", entry))).alias("params"),
            F.map_from_entries(F.collect_list(F.when(F.col("kind") == "tag", entry))).alias("tags"),
            F.map_from_entries(F.collect_list(F.when(F.col("kind") == "metric",
                                                     F.struct("key", F.col("value_num").alias("v"))))).alias("metrics"))
        return g

    def search_runs(self, filter_expr: str | None = None, order_by: list | None = None,
                    max_results: int | None = None) -> DataFrame:
        """Filter (SQL over ``params['k']``, ``metrics['m']``, ``tags['t']``), order (default
        newest first) and cap the number of runs returned (the cap is the feature here)."""
        r = self.runs()
        if filter_expr:
            r = r.filter(F.expr(filter_expr))
        r = r.orderBy(*(order_by or [F.desc("end_time"), F.asc("run_id")]))
        return r.limit(max_results) if max_results else r

    def latest_per_tag(self, tag: str) -> DataFrame:
        """For each value of a tag, the run that ended last (ties -> largest run id)."""
        r = self.runs().filter(F.col("tags")[tag].isNotNull())
        g = r.groupBy(F.col("tags")[tag].alias(tag)).agg(
            F.max_by(F.struct("end_time", "run_id", "metrics", "params"), F.struct("end_time", "run_id")).alias("_s"))
        return g.select(tag, F.col("_s.run_id").alias("run_id"), F.col("_s.end_time").alias("end_time"),
                        F.col("_s.metrics").alias("metrics"), F.col("_s.params").alias("params"))

    def runs_on(self, data_path: str, data_version: str | int | None = None) -> DataFrame:
        """Runs that read a data set, or one version of it."""
        r = self.runs().filter(F.col("params")["data_path"] == data_path)
        return r if data_version is None else r.filter(F.col("params")["data_version"] == str(data_version))

    def best_run(self, metric: str, ascending: bool = True, group_by: str | None = None) -> DataFrame:
        """Run with the smallest (or largest) metric, optionally per param value."""
        r = self.runs().filter(F.col("metrics")[metric].isNotNull())
        m = F.col("metrics")[metric]
        key = m if ascending else -m
        grp = [F.col("params")[group_by].alias(group_by)] if group_by else []
        g = r.groupBy(*grp).agg(F.min_by(F.struct("run_id", m.alias(metric)), F.struct(key, F.col("run_id"))).alias("_b"))
        return g.select(*([group_by] if group_by else []), F.col("_b.run_id").alias("run_id"), F.col(f"_b.{metric}").alias(metric))

    def tree(self, metric: str) -> DataFrame:
        """Parent runs with their number of children and the children's mean metric."""
        r = self.runs()
        parents = r.filter(F.col("parent_run_id").isNull()).select("run_id", "experiment")
        kids = r.filter(F.col("parent_run_id").isNotNull()).groupBy("parent_run_id").agg(
            F.count(F.lit(1)).alias("n_children"), F.avg(F.col("metrics")[metric]).alias(f"avg_child_{metric}"))
        return parents.join(kids, parents.run_id == kids.parent_run_id, "left").drop("parent_run_id")


def latest_version(versions: DataFrame, name_col: str = "name", version_col: str = "version") -> DataFrame:
    """Max version per name, compared as integers (string versions sort "10" < "9")."""
    return versions.groupBy(name_col).agg(F.max(F.col(version_col).cast("int")).alias("latest_version"))
