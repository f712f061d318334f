"""Keyed feature tables on top of :mod:`driftline.sources.versions`.

A feature table is a versioned table with primary-key columns, a description, its data sources and
optional partition columns. Keys must be unique and non-null (checked with one grouped aggregate).
Rows are stored by a bucket of their key's hash; a merge upserts the buckets that its rows meet and
leaves the files of all others as they are. Overwrite keeps columns that disappeared as NULL
columns. Training sets and batch scoring are left joins of a caller frame to one or more feature
tables. A logged model carries its lookups: the tables, their keys and the versions it was trained
on, so a caller scores with keys alone, and an old model goes on as the tables grow.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftline.operators.keys import upsert
from driftline.sources.versions import VersionedTable, delete_path, path_exists, read_text, write_text

BUCKET_ROWS = 1_000_000  # rows a bucket is planned for
MIN_BUCKETS, MAX_BUCKETS = 8, 4096


@dataclass
class FeatureLookup:
    table_name: str
    lookup_key: list[str]
    feature_names: list[str] | None = None
    version: int | None = None  # of the table; the newest where it is not given


@dataclass
class TrainingSet:
    df: DataFrame
    label: str | None
    feature_columns: list[str] = field(default_factory=list)
    lookups: list[FeatureLookup] = field(default_factory=list)  # with names and versions filled in
    exclude_columns: list[str] = field(default_factory=list)

    def load_df(self) -> DataFrame:
        return self.df


def check_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One-row frame: n_rows, n_null_keys, n_duplicate_keys (all from one grouped count)."""
    null_any = F.lit(False)
    for k in keys:
        null_any = null_any | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(null_any.cast("int")).alias("_null"))
    return per_key.agg(F.sum("_n").alias("n_rows"),
                       F.coalesce(F.sum(F.when(F.col("_null") == 1, F.col("_n"))), F.lit(0)).alias("n_null_keys"),
                       F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).alias("n_duplicate_keys"))


class FeatureStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _vt(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name}")

    def _meta_path(self, name: str) -> str:
        return f"{self.root}/{name}/_table.json"

    def _validate(self, df: DataFrame, keys: list[str]) -> int:
        """Number of rows; raises where a key is null or repeated."""
        r = check_keys(df, keys).first()
        if r["n_null_keys"] or r["n_duplicate_keys"]:
            raise ValueError(f"primary key {keys} has {r['n_null_keys']} null and {r['n_duplicate_keys']} duplicate rows")
        return r["n_rows"] or 0

    # ------------------------------------------------------------------ tables
    def create_table(self, name: str, primary_keys: list[str], df: DataFrame | None = None,
                     schema: StructType | None = None, description: str = "",
                     partition_columns: list[str] | None = None, sources: list[str] | None = None,
                     buckets: int | None = None) -> dict:
        """``sources`` defaults to the folders or files behind ``df``. ``buckets`` of the key hash
        defaults to the number of rows by ``BUCKET_ROWS``; an overwrite sets it anew."""
        if path_exists(self.spark, self._meta_path(name)):
            raise FileExistsError(f"feature table {name} exists")
        if df is None and schema is None:
            raise ValueError("need df or schema")
        schema = schema or df.schema
        if sources is None:
            sources = [] if df is None else source_folders(df)
        meta = {"name": name, "primary_keys": list(primary_keys), "description": description, "sources": sources,
                "partition_columns": list(partition_columns or []), "buckets": buckets, "schema": schema.jsonValue()}
        rows = None if df is None else self._validate(df, primary_keys)
        write_text(self.spark, self._meta_path(name), json.dumps(meta))
        if df is not None:
            self._overwrite(meta, df, rows)
        return meta

    def get_table(self, name: str) -> dict:
        return json.loads(read_text(self.spark, self._meta_path(name)))

    def drop_table(self, name: str) -> None:
        delete_path(self.spark, f"{self.root}/{name}")

    def _overwrite(self, meta: dict, df: DataFrame, rows: int | None) -> int:
        planned = -(-rows // BUCKET_ROWS) if rows is not None else MIN_BUCKETS
        vt = self._vt(meta["name"])
        return vt.write(df, mode="overwrite" if vt.exists() else "error", partition_by=meta["partition_columns"], overwrite_schema=True,
                        buckets=meta["buckets"] or min(max(planned, MIN_BUCKETS), MAX_BUCKETS), keys=meta["primary_keys"])

    def write_table(self, name: str, df: DataFrame, mode: str = "merge", validate: bool = True) -> int:
        """``validate`` checks key uniqueness with one grouped count (an extra pass over
        ``df``); callers that guarantee unique keys can skip it."""
        if mode not in ("merge", "overwrite"):
            raise ValueError(f"unknown mode {mode}")
        meta = self.get_table(name)
        keys = meta["primary_keys"]
        rows = self._validate(df, keys) if validate else None
        vt = self._vt(name)
        if not vt.exists():
            return self._overwrite(meta, df, rows)
        if mode == "merge":
            return vt.merge(df, lambda current, updates: upsert(current, updates, keys))
        # columns that disappeared stay as all-NULL columns
        missing = [f for f in vt.read().schema.fields if f.name not in df.columns]
        return self._overwrite(meta, df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]), rows)

    def read_table(self, name: str, as_of_timestamp=None, version: int | None = None) -> DataFrame:
        return self._vt(name).read(version=version, timestamp=as_of_timestamp)

    def history(self, name: str) -> DataFrame:
        return self._vt(name).history()

    # ------------------------------------------------------------------ training / scoring
    def create_training_set(self, df: DataFrame, feature_lookups: list[FeatureLookup], label: str | None,
                            exclude_columns: list[str] | None = None, as_of_timestamp=None) -> TrainingSet:
        """Left-join ``df`` to every lookup's table on its key; caller columns (inference-time
        features) are kept; excluded columns dropped."""
        out = df
        feats: list[str] = []
        pinned = []
        for lk in feature_lookups:
            tkeys = self.get_table(lk.table_name)["primary_keys"]
            version = lk.version if lk.version is not None else self._vt(lk.table_name).version_of(as_of_timestamp)
            table = self.read_table(lk.table_name, version=version)
            names = lk.feature_names or [c for c in table.columns if c not in tkeys]
            ft = table.select(*[F.col(t).alias(l) for t, l in zip(tkeys, lk.lookup_key)], *names)
            out = out.join(ft, lk.lookup_key, "left")
            feats += names
            pinned.append(FeatureLookup(lk.table_name, list(lk.lookup_key), list(names), version))
        excl = set(exclude_columns or [])
        out = out.select(*[c for c in out.columns if c not in excl])
        return TrainingSet(out, label, [f for f in feats if f not in excl], pinned, sorted(excl))

    def score_batch(self, model, df: DataFrame, feature_lookups: list[FeatureLookup] | None = None,
                    result_type: str = "double", prediction_col: str = "prediction") -> DataFrame:
        """Look up the model's features for the rows of ``df`` and score them. ``model`` is a fitted
        transformer with its lookups, or the name of a logged model, which brings its own."""
        if isinstance(model, str):
            record = self.get_model(model)
            feature_lookups = [FeatureLookup(**lk) for lk in record["lookups"]]
            model = DefaultParamsReader.loadParamsInstance(f"{self._model_path(model)}/model", self.spark)
        ts = self.create_training_set(df, feature_lookups, label=None)
        scored = model.transform(ts.df)
        return scored.withColumn(prediction_col, F.col(prediction_col).cast(result_type))

    # ------------------------------------------------------------------ models
    def _model_path(self, name: str) -> str:
        return f"{self.root}/_models/{name}"

    def log_model(self, name: str, model, training_set: TrainingSet) -> dict:
        """Store a fitted model with what it takes to score from keys alone: lookups with feature names
        and the table versions they were read at, the caller's own feature columns, the label, and
        the data sources of the tables."""
        if path_exists(self.spark, self._model_path(name)):
            raise FileExistsError(f"model {name} exists")
        tables = {lk.table_name: self.get_table(lk.table_name) for lk in training_set.lookups}
        looked_up = set(training_set.feature_columns) | {k for lk in training_set.lookups for k in lk.lookup_key}
        record = {"name": name, "label": training_set.label, "features": training_set.feature_columns,
                  "caller_columns": [c for c in training_set.df.columns if c not in looked_up and c != training_set.label],
                  "exclude_columns": training_set.exclude_columns, "lookups": [asdict(lk) for lk in training_set.lookups],
                  "sources": sorted({s for t in tables.values() for s in t["sources"]})}
        model.write().save(f"{self._model_path(name)}/model")
        write_text(self.spark, f"{self._model_path(name)}/_record.json", json.dumps(record))  # last: then it is whole
        return record

    def get_model(self, name: str) -> dict:
        return json.loads(read_text(self.spark, f"{self._model_path(name)}/_record.json"))


def source_folders(df: DataFrame) -> list[str]:
    """What lies behind a frame (names only; no file is opened): files, or the folder of part files."""
    return sorted({f.rsplit("/", 1)[0] if f.rsplit("/", 1)[1].startswith("part-") else f for f in df.inputFiles()})
