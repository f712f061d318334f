"""Streaming queries: the ``events`` table lands as several files in a
stream folder; each query streams them, writes an append sink, and reads it back as a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.operators import models as MD
from driftline.operators import scoring as S
from driftline.plans.ml_fixtures import grouped_facts
from driftline.plans.registry import query
from driftline.session import work_dir
from driftline.sources.featurestore import FeatureStore
from driftline.sources.tables import Tables
from driftline.streaming import files as SF

CHUNK_BYTES = 64 << 20


def _landed(spark, sf_dir, at_least=4):
    """The events as files of about CHUNK_BYTES each (``at_least`` so that small inputs stream too)."""
    folder = work_dir(spark, "stream-in")
    events = Tables(spark, sf_dir).events
    files = events.select(F.col("_metadata.file_path"), F.col("_metadata.file_size").alias("size")).distinct()
    size = files.agg(F.sum("size")).first()[0] or 0
    SF.write_chunks(events, folder, max(at_least, -(-size // CHUNK_BYTES)), "ts")
    return folder


@query("stream_sink_counts", """SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""",
       "stream")
def stream_sink_counts(spark, sf_dir):
    """File source (declared schema, one file per trigger, label column dropped) -> partitioned
    parquet append sink with checkpoint -> batch read of the output."""
    src = _landed(spark, sf_dir)
    out, ckpt = work_dir(spark, "stream-out"), work_dir(spark, "stream-ckpt")
    stream = SF.read_stream(spark, src, SF.EVENTS_SCHEMA, 1, drop=["props"])
    SF.run_until_done(SF.start_append(stream, out, ckpt, ["event_type"], name="events_sink"))
    back = spark.read.parquet(out)
    if (got := back.count()) != (sent := spark.read.schema(SF.EVENTS_SCHEMA).parquet(src).count()):
        raise RuntimeError(f"the sink holds {got} of {sent} rows")
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("stream_scan", "SELECT event_id, ts, user_id, event_type, value FROM events", "stream")
def stream_scan(spark, sf_dir):
    src = _landed(spark, sf_dir)
    out, ckpt = work_dir(spark, "stream-out"), work_dir(spark, "stream-ckpt")
    stream = SF.read_stream(spark, src, SF.EVENTS_SCHEMA, 1, drop=["props"]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    SF.run_until_done(SF.start_append(stream, out, ckpt))
    return spark.read.parquet(out)


@query("stream_score", """WITH f AS (SELECT event_id, CAST(user_id % 12 AS INTEGER) AS user_group, value,
       round(value * 2 + (event_id % 100) / 10.0, 6) AS label FROM events),
c AS (SELECT regr_slope(label, value) AS b, regr_intercept(label, value) AS a FROM f)
SELECT event_id, round(a + b * value, 4) AS prediction FROM f, c""", "stream")
def stream_score(spark, sf_dir):
    """Stateless model scoring on the stream: a pandas UDF over each micro-batch."""
    facts = grouped_facts(Tables(spark, sf_dir)).withColumn("_g", F.lit(0))
    model = S.model_from_row(MD.grouped_linear_fit(facts, "_g", ["value"], "label").first(), ["value"])
    src = _landed(spark, sf_dir)
    out, ckpt = work_dir(spark, "stream-out"), work_dir(spark, "stream-ckpt")
    stream = SF.read_stream(spark, src, SF.EVENTS_SCHEMA, 1)
    scored = stream.select(F.col("event_id").alias("event_id"),
                           F.round(S.scalar_udf(model)(F.col("value")), 4).alias("prediction"))
    SF.run_until_done(SF.start_append(scored, out, ckpt))
    return spark.read.parquet(out)


@query("stream_restart", "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_ids FROM events", "stream")
def stream_restart(spark, sf_dir):
    """Stop after the first files, land the rest, restart on the same checkpoint: every row is
    written exactly once."""
    ev = Tables(spark, sf_dir).events
    src = work_dir(spark, "stream-in")
    cut = ev.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    SF.write_chunks(ev.filter(F.col("event_id") <= cut), src, 2, "ts")
    out, ckpt = work_dir(spark, "stream-out"), work_dir(spark, "stream-ckpt")
    SF.run_until_done(SF.start_append(SF.read_stream(spark, src, SF.EVENTS_SCHEMA, 1), out, ckpt))
    SF.write_chunks(ev.filter(F.col("event_id") > cut), src, 2, "ts")
    SF.run_until_done(SF.start_append(SF.read_stream(spark, src, SF.EVENTS_SCHEMA, 1), out, ckpt))
    back = spark.read.parquet(out)
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_ids"))


@query("stream_feature_merge", """SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""",
       "stream")
def stream_feature_merge(spark, sf_dir):
    """Stream rows into a keyed feature table (unique id = event_id) with foreachBatch upserts."""
    src = _landed(spark, sf_dir, 3)
    fs = FeatureStore(spark, work_dir(spark, "stream-fs"))
    schema = spark.createDataFrame([], "event_id long, event_type string, value double").schema
    fs.create_table("event_features", ["event_id"], schema=schema, description="events streamed in")

    def upsert_batch(batch, epoch_id):
        fs.write_table("event_features", batch.select("event_id", "event_type", "value"), mode="merge")

    stream = SF.read_stream(spark, src, SF.EVENTS_SCHEMA, 1)
    SF.run_until_done(SF.start_foreach_batch(stream, upsert_batch, work_dir(spark, "stream-ckpt")))
    t = fs.read_table("event_features")
    return t.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("stream_windowed_counts", """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total
FROM events GROUP BY 1, 2""", "stream")
def stream_windowed_counts(spark, sf_dir):
    """Event-time windows with a watermark, kept up to date in a keyed table: the windows a micro-batch
    changes are merged by (day, type). The stream has its own number of shuffle partitions."""
    src = _landed(spark, sf_dir)
    streams = SF.stream_session(spark, 4)
    fs = FeatureStore(spark, work_dir(spark, "stream-windows"))
    schema = spark.createDataFrame([], "day string, event_type string, n long, total double").schema
    fs.create_table("daily", ["day", "event_type"], schema=schema, description="daily counts, streamed")
    stream = SF.read_stream(streams, src, SF.EVENTS_SCHEMA, 1)
    counts = SF.windowed_counts(stream, "ts", ["event_type"], late="60 days", aggs={"total": F.sum("value")})  # the files land in any order

    def keep(batch, epoch_id):
        rows = batch.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n", "total")
        fs.write_table("daily", rows, mode="merge")

    SF.run_until_done(SF.start_foreach_batch(counts, keep, work_dir(spark, "stream-ckpt"), output_mode="update"))
    return fs.read_table("daily").withColumn("total", F.round("total", 4))
