"""Snapshots of a table as partitions: ``<path>/epoch=E/snapshot=N[/bucket=B][/<column>=..]``.

Every write is one snapshot, numbered on; an overwrite starts a new epoch. A version is then a filter
on partitions and nothing else: the snapshots of its epoch up to its number, or for keyed tables, per
bucket of the key hash, the newest of them. Rows are never rewritten in place, so older versions
stay readable, and a reader sees a snapshot only once its schema file, written last, is there.

There is no commit log, no conflict check between writers (one writer per table) and no vacuum: how
long folders are kept is a rule of the store; :meth:`VersionedTable.expired` says which versions a
retention would allow to go. What changed between two versions is a join of the two.
"""

from __future__ import annotations

import datetime as dt
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

MIN_RETENTION_HOURS = 168
BUCKET = "_bucket"
HISTORY = "version int, ts timestamp, operation string, mode string, epoch int, n_rows bigint"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def glob(spark: SparkSession, pattern: str) -> list[tuple[str, dt.datetime]]:
    """Paths that fit ``pattern`` with their modification times (UTC)."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p) or []
    return [(f.getPath().toString(), dt.datetime.fromtimestamp(f.getModificationTime() / 1000, dt.timezone.utc).replace(tzinfo=None))
            for f in found]


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class VersionedTable:
    """A table of numbered snapshots. Nothing is cached: every call lists the folders that exist."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # ------------------------------------------------------------------ what is there
    def _folder(self, epoch: int, number: int) -> str:
        return f"{self.path}/epoch={epoch}/snapshot={number}"

    def _listed(self) -> list[tuple[int, int, dt.datetime]]:
        """(number, epoch, time) of every whole snapshot, in order: one listing, a row per write."""
        found = []
        for path, ts in glob(self.spark, f"{self.path}/epoch=*/snapshot=*/_schema.json"):
            epoch, number = map(int, re.search(r"epoch=(\d+)/snapshot=(\d+)", path).groups())
            found.append((number, epoch, ts))
        return sorted(found)

    def _about(self, epoch: int, number: int) -> dict:
        about = json.loads(read_text(self.spark, f"{self._folder(epoch, number)}/_schema.json"))
        return about | {"schema": StructType.fromJson(about["schema"])}

    def exists(self) -> bool:
        return bool(self._listed())

    def _resolve(self, version: int | None = None, timestamp: str | dt.datetime | None = None) -> tuple[int, int]:
        """(epoch, number) of a version: the newest, ``version``, or the newest at ``timestamp``."""
        if isinstance(timestamp, str):
            timestamp = dt.datetime.fromisoformat(timestamp)
        fits = [(e, n) for n, e, ts in self._listed()
                if (version is None or n == version) and (timestamp is None or ts <= timestamp)]
        if not fits:
            raise ValueError(f"no version of {self.path} matches version={version} timestamp={timestamp}")
        return fits[-1]

    def version_of(self, timestamp=None) -> int:
        return self._resolve(timestamp=timestamp)[1]

    def history(self) -> DataFrame:
        """version, ts, operation, mode, epoch, n_rows (rows it wrote), newest first. Counts come from a
        scan that reads partition values only."""
        listed = self._listed()
        rows = []
        for i, (n, e, ts) in enumerate(listed):
            first = i == 0 or listed[i - 1][1] != e
            mode = "error" if i == 0 else "overwrite" if first else "append"
            rows.append((n, ts, {"error": "WRITE"}.get(mode, mode.upper()), mode, e))
        frame = self.spark.createDataFrame(rows, HISTORY.rsplit(",", 1)[0])
        if not rows:
            return frame.withColumn("n_rows", F.lit(None).cast("bigint"))
        folders = [self._folder(e, n) for n, e, _ in listed]
        counts = (self._scan(folders, StructType([StructField("epoch", frame.schema["epoch"].dataType),
                                                  StructField("snapshot", frame.schema["version"].dataType)]))
                  .groupBy(F.col("snapshot").alias("version")).agg(F.count(F.lit(1)).alias("n_rows")))
        return (frame.join(F.broadcast(counts), "version", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
                .orderBy(F.desc("version")))

    def expired(self, retention_hours: float = MIN_RETENTION_HOURS, now: dt.datetime | None = None) -> list[int]:
        """Versions superseded by an overwrite longer ago than the retention."""
        now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        listed = self._listed()
        ended = {e: min(ts for _, e2, ts in listed if e2 > e) for _, e, _ in listed if any(e2 > e for _, e2, _ in listed)}
        return [n for n, e, _ in listed if e in ended and ended[e] <= now - dt.timedelta(hours=retention_hours)]

    # ------------------------------------------------------------------ writes
    def write(self, df: DataFrame, mode: str = "error", partition_by: list[str] | None = None,
              overwrite_schema: bool = False, merge_schema: bool = False, buckets: int = 0, keys: list[str] | None = None) -> int:
        """Write a snapshot and return its number. ``error`` (default) fails if the table exists;
        ``overwrite`` starts an epoch (another schema needs ``overwrite_schema``); ``append`` adds rows
        (new columns need ``merge_schema``) and keeps the epoch's partitioning."""
        listed = self._listed()
        if listed and mode in ("error", "errorifexists"):
            raise FileExistsError(f"table {self.path} already exists")
        number, epoch, schema = 0, 0, df.schema
        if listed:
            last, epoch, _ = listed[-1]
            number, old = last + 1, self._about(epoch, last)
            same = sorted(old["schema"].names) == sorted(df.columns)
            if mode == "overwrite":
                epoch += 1
                if not same and not overwrite_schema:
                    raise ValueError("schema mismatch: pass overwrite_schema=True to replace the schema")
            else:
                if not same and not merge_schema:
                    raise ValueError("schema mismatch: pass merge_schema=True to add columns")
                names = set(old["schema"].names)
                schema = StructType(old["schema"].fields + [f for f in df.schema.fields if f.name not in names])
                partition_by, buckets, keys = old["partition_by"], old["buckets"], old["keys"]
        folder, by = self._folder(epoch, number), [BUCKET] * bool(buckets) + list(partition_by or [])
        out = df.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(BUCKET) if buckets else df
        out.write.mode("overwrite").partitionBy(*by).parquet(folder)
        about = {"schema": schema.jsonValue(), "partition_by": list(partition_by or []), "buckets": buckets, "keys": keys}
        write_text(self.spark, f"{folder}/_schema.json", json.dumps(about))
        return number

    def merge(self, updates: DataFrame, combine, merge_schema: bool = True) -> int:
        """Rewrite the buckets that ``updates`` meets: ``combine(current rows of them, updates)`` becomes
        a snapshot of these buckets alone; the files of all others stay as they are. Which buckets
        are met is one grouped aggregate with at most as many rows as there are buckets."""
        epoch, number = self._resolve()
        about = self._about(epoch, number)
        if not about["buckets"]:
            raise ValueError(f"table {self.path} is not stored by key buckets")
        met = updates.select(bucket_of(about["keys"], about["buckets"]).alias(BUCKET)).distinct().collect()
        current = self._read(epoch, number, {r[0] for r in met})
        return self.write(combine(current, updates), mode="append", merge_schema=merge_schema)

    # ------------------------------------------------------------------ reads
    def _scan(self, folders: list[str], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders)

    def _read(self, epoch: int, number: int, buckets: set[int] | None = None) -> DataFrame:
        about = self._about(epoch, number)
        if not about["buckets"]:
            folders = [self._folder(e, n) for n, e, _ in self._listed() if e == epoch and n <= number]
        else:
            newest: dict[int, tuple[int, str]] = {}
            whole = {n for n, e, _ in self._listed() if e == epoch and n <= number}
            for path, _ in glob(self.spark, f"{self.path}/epoch={epoch}/snapshot=*/{BUCKET}=*"):
                n, b = map(int, re.search(rf"snapshot=(\d+)/{BUCKET}=(\d+)", path).groups())
                if n in whole and (buckets is None or b in buckets):
                    newest[b] = max(newest.get(b, (-1, "")), (n, path))
            folders = [p for _, p in newest.values()]
        names = about["schema"].names
        if not folders:
            return self.spark.createDataFrame([], about["schema"])
        return self._scan(folders, about["schema"]).select(*[F.col(f"`{c}`") for c in names])

    def read(self, version: int | None = None, timestamp: str | dt.datetime | None = None) -> DataFrame:
        """The newest version, or the one named by number or time: one scan of its folders with its
        schema (columns that older files lack are null)."""
        return self._read(*self._resolve(version, timestamp))

    def changes(self, old: int, new: int, keys: list[str]) -> DataFrame:
        """Rows of either version whose key is not in the other or whose values differ: ``keys``,
        ``change`` (added, removed, updated) and ``before`` / ``after`` structs."""
        a, b = self.read(old), self.read(new)
        shared = [c for c in b.columns if c in a.columns and c not in keys]
        rest = lambda df: F.struct(F.lit(True).alias("_there"), *[F.col(c) for c in df.columns if c not in keys])
        j = (a.select(*keys, rest(a).alias("before")).join(b.select(*keys, rest(b).alias("after")), keys, "full_outer"))
        same = F.lit(True)
        for c in shared:
            same = same & F.col(f"before.`{c}`").eqNullSafe(F.col(f"after.`{c}`"))
        kind = (F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(~same, "updated"))
        out = j.withColumn("change", kind).filter(F.col("change").isNotNull())
        return out.select(*keys, "change", *[F.when(F.col(s).isNotNull(), F.col(s).dropFields("_there")).alias(s) for s in ("before", "after")])


def schema_diff(left: StructType, right: StructType) -> list[tuple[str, str | None, str | None]]:
    """Symmetric difference of two schemas: (column, left type, right type) where they differ."""
    lt = {f.name: f.dataType.simpleString() for f in left.fields}
    rt = {f.name: f.dataType.simpleString() for f in right.fields}
    return sorted((c, lt.get(c), rt.get(c)) for c in set(lt) | set(rt) if lt.get(c) != rt.get(c))
