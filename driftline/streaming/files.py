"""Structured Streaming over a parquet file folder: declared schema, bounded micro-batches,
stateless scoring, append sink with checkpoint (exactly-once restart), feature-table upserts
via ``foreachBatch``.

``availableNow`` triggers process every file present at start in micro-batches of
``maxFilesPerTrigger`` and stop, which makes batch-equality tests deterministic; the same
query with a processing-time trigger runs continuously.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def write_chunks(df: DataFrame, folder: str, n_files: int, order_col: str) -> None:
    """Land a table as ``n_files`` parquet files cut in ``order_col`` order (a file per
    arrival), the way an upstream job would drop files into a stream folder."""
    df.repartitionByRange(n_files, order_col).sortWithinPartitions(order_col).write.mode("append").parquet(folder)


def read_stream(spark: SparkSession, folder: str, schema: str, max_files_per_trigger: int = 1,
                drop: list[str] | None = None) -> DataFrame:
    """File stream with a declared schema (streams cannot infer), one file per trigger."""
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder))
    # session timestamps (not NTZ) so a watermark can be declared downstream if needed
    s = s.select([F.col(c).cast("timestamp").alias(c) if c == "ts" else F.col(c) for c in s.columns])
    return s.drop(*(drop or []))


def stream_session(spark: SparkSession, shuffle_partitions: int) -> SparkSession:
    """A session of the same application for streams, with their own number of shuffle partitions: a
    stateful query keeps one state store per partition for its whole life (the number is fixed by
    its first checkpoint), so it is set for the keys it holds, not for the size of batch jobs."""
    s = spark.newSession()
    s.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    s.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return s


def windowed_counts(stream: DataFrame, time_col: str, keys: list[str], width: str = "1 day", late: str = "1 hour",
                    aggs: dict | None = None) -> DataFrame:
    """Counts (and ``aggs``) per tumbling event-time window and key; state older than the watermark goes."""
    w = F.window(time_col, width)
    out = stream.withWatermark(time_col, late).groupBy(w.alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n"), *[e.alias(k) for k, e in (aggs or {}).items()])
    return out.select(F.col("w.start").alias("window_start"), *keys, "n", *(aggs or {}))


def start_append(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                 name: str | None = None, available_now: bool = True, interval: str = "5 seconds") -> StreamingQuery:
    w = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .option("path", path))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def start_foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                        available_now: bool = True, output_mode: str = "append") -> StreamingQuery:
    w = stream.writeStream.outputMode(output_mode).foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def run_until_done(q: StreamingQuery, timeout_s: float | None = None) -> list[dict]:
    """Wait for an availableNow query to finish; returns its latest progress reports. There is no
    limit unless the caller sets one; past it the query is stopped and ``TimeoutError`` raised,
    since its sink holds only part of the input."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream had not finished after {timeout_s} s; its sink is incomplete")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return [p for p in q.recentProgress]


def wait_for_progress(q: StreamingQuery, n: int, timeout_s: float = 600, poll_s: float = 0.5) -> list[dict]:
    """Block until a continuously running query has finished ``n`` batches, counted by batch
    id since only the latest reports are kept (or fail)."""
    import time
    deadline = time.monotonic() + timeout_s

    def done() -> int:
        last = q.lastProgress
        return 0 if last is None else int(last["batchId"]) + 1

    while done() < n:
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        if time.monotonic() > deadline:
            raise TimeoutError(f"{done()} of {n} batches after {timeout_s}s")
        time.sleep(poll_s)
    return list(q.recentProgress)


def stop_all(spark: SparkSession) -> int:
    n = 0
    for q in spark.streams.active:
        q.stop()
        n += 1
    return n
