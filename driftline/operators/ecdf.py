"""Distributed running sums over an ordered column (the ECDF building block).

A plain ``sum(..) OVER (PARTITION BY feature ORDER BY value)`` sends every value of a feature
to one task. Instead we use a two-level prefix sum:

1. ``repartitionByRange(keys, order)`` lets Spark's sampling range partitioner cut the
   (already de-duplicated) values into balanced, ordered segments. A hot value cannot skew
   it: callers aggregate to one row per distinct value first.
2. The segment id (the range partition) is written with the rows as a parquet table under
   ``spark.checkpoint.dir`` (:func:`driftline.session.materialize`), so it is stable across
   the two passes and across executor loss.
3. Per-(key, segment) totals form a table bounded by ``#segments + #keys`` rows; a window over
   it gives each segment's offset. It is broadcast only when the caller can bound ``#keys``
   (features of a schema, say); otherwise the join is left to AQE, which broadcasts it at run
   time only if its measured size is under the threshold and sort-merges it beyond.
4. Inside each (key, segment) a window running sum adds the offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.operators.joins import join_bounded
from driftline.session import ensure_checkpoint_dir, materialize


def _bound(nseg: int, keys: list[str], n_keys: int | None) -> int | None:
    """Rows of the per-(key, segment) table: at most #segments + #keys - 1."""
    if not keys:
        return nseg
    return None if n_keys is None else nseg + n_keys


SEGMENT_BYTES = 256 << 20  # planned size of a segment


def _num_segments(df: DataFrame) -> int:
    """Segments by the planner's estimate of the input's size (no job), and not fewer than the session's
    shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(n, 1, min(-(-size // SEGMENT_BYTES), MAX_SEGMENTS))


MAX_SEGMENTS = 100_000  # an estimate without statistics can be absurd


def segmented(df: DataFrame, keys: list[str], order_col: str, segments: int | None = None) -> DataFrame:
    """``df`` range-cut by (keys, order), written once with its segment id ``_seg``."""
    ensure_checkpoint_dir(df.sparkSession)
    return materialize(df.repartitionByRange(segments or _num_segments(df), *keys, order_col)
                       .withColumn("_seg", F.spark_partition_id()), "segments")


def scan_segments(tagged: DataFrame, keys: list[str], order_col: str, sum_cols: list[str], lift, running, out: str) -> DataFrame:
    """A two-stage prefix scan over one :func:`segmented` table, for a running minimum of something that
    itself depends on running sums.

    The sums of earlier segments give each segment's offsets, so ``cum_<c>`` is known inside it;
    ``lift`` maps a row (with its sums) to a value, whose minima per segment are scanned the same way;
    ``running`` combines (smallest value of earlier segments, smallest so far in this one) to
    ``out``. Both steps read the one written table; only rows per (keys, segment) are shuffled."""
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy(*keys, "_seg").orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = [*keys, "_seg"]
    sums = tagged.groupBy(*at).agg(*[F.sum(c).alias(f"_s_{c}") for c in sum_cols])
    sums = sums.select(*at, *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols])
    known = tagged.join(sums, at).withColumns({f"cum_{c}": F.col(f"_o_{c}") + F.sum(c).over(so_far) for c in sum_cols})
    known = known.drop(*[f"_o_{c}" for c in sum_cols]).withColumn("_lift", lift)
    least = known.groupBy(*at).agg(F.min("_lift").alias("_l")).select(*at, F.min("_l").over(before).alias("_prev"))
    return known.join(least, at).withColumn(out, running(F.col("_prev"), F.min("_lift").over(so_far))).drop("_prev", "_lift", "_seg")


def prefix_sums(df: DataFrame, keys: list[str], order_col: str, sum_cols: list[str],
                with_next: bool = False, segments: int | None = None, n_keys: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum ordered by ``order_col`` within ``keys``) and
    ``total_<c>`` for each column ``c`` in ``sum_cols``; optionally ``next_<order_col>``, the
    next larger ``order_col`` within the key (null for the last one).

    ``df`` must hold one row per (keys, order_col) for the running sums to be well defined.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    nseg = segments or _num_segments(df)
    # the segment id is stored with the rows, so it cannot change when a task is retried later
    tagged = materialize(df.repartitionByRange(nseg, *keys, order_col)
                         .withColumn("_seg", F.spark_partition_id()), "segments")

    seg = tagged.groupBy(*keys, "_seg").agg(
        *[F.sum(c).alias(f"_seg_{c}") for c in sum_cols],
        F.min(order_col).alias("_seg_lo"))
    wk = Window.partitionBy(*keys)
    wseg = wk.orderBy("_seg")
    before = wseg.rowsBetween(Window.unboundedPreceding, -1)
    seg_cols = [*keys, "_seg"]
    for c in sum_cols:
        seg_cols.append(F.coalesce(F.sum(f"_seg_{c}").over(before), F.lit(0)).alias(f"_off_{c}"))
        seg_cols.append(F.sum(f"_seg_{c}").over(wk).alias(f"total_{c}"))
    if with_next:
        seg_cols.append(F.lead("_seg_lo").over(wseg).alias("_next_seg_lo"))
    offsets = seg.select(*seg_cols)

    out = join_bounded(tagged, offsets, [*keys, "_seg"], max_rows=_bound(nseg, keys, n_keys))
    w = Window.partitionBy(*keys, "_seg").orderBy(order_col)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.col(c) for c in df.columns]
    for c in sum_cols:
        cols.append((F.col(f"_off_{c}") + F.sum(c).over(running)).alias(f"cum_{c}"))
        cols.append(F.col(f"total_{c}"))
    if with_next:
        cols.append(F.coalesce(F.lead(order_col).over(w), F.col("_next_seg_lo")).alias(f"next_{order_col}"))
    return out.select(*cols)


def exact_quantiles(ranked: DataFrame, keys: list[str], value_col: str, count_col: str,
                    probs: list[float], names: list[str]) -> DataFrame:
    """Exact quantiles with linear interpolation (``percentile`` / ``quantile_cont``) from the
    output of :func:`prefix_sums` (needs ``cum_<count_col>`` and ``total_<count_col>``).

    Each distinct value checks whether it holds rank floor(h) or ceil(h), h = (n-1)p, and a
    grouped ``max`` picks them up: no collect, no single-task sort.
    """
    aggs, finals = quantile_aggs(value_col, count_col, probs, names)
    return ranked.groupBy(*keys).agg(*aggs).select(*[F.col(k) for k in keys], *finals)


def quantile_aggs(value_col: str, count_col: str, probs: list[float], names: list[str]):
    """(aggregate expressions, final expressions) of :func:`exact_quantiles`, so callers can
    fold the quantiles into a grouped aggregate that computes other statistics too."""
    cum = F.col(f"cum_{count_col}")
    before = cum - F.col(count_col)
    n = F.col(f"total_{count_col}")
    aggs, finals = [], []
    for p, name in zip(probs, names):
        h = (n - 1) * F.lit(float(p))
        lo_r, hi_r = F.floor(h), F.ceil(h)
        aggs.append(F.max(F.when((before <= lo_r) & (lo_r < cum), F.col(value_col))).alias(f"_{name}_lo"))
        aggs.append(F.max(F.when((before <= hi_r) & (hi_r < cum), F.col(value_col))).alias(f"_{name}_hi"))
        aggs.append(F.max(h - lo_r).alias(f"_{name}_frac"))
        lo, hi, fr = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_frac")
        finals.append((lo + fr * (hi - lo)).alias(name))
    return aggs, finals


def value_statistics(long: DataFrame, keys: list[str], value_col: str = "value",
                     probs: list[float] = (0.25, 0.5, 0.75), names: list[str] = ("p25", "p50", "p75"),
                     n_keys: int | None = None) -> DataFrame:
    """Every per-key statistic of a long ``(keys..., value)`` frame (nulls allowed):

    keys, n (non-null values), n_null, n_distinct, min, max, mean, std (sample), the exact
    quantiles ``names`` and mode (most frequent value, ties -> smallest).

    Two passes over ``long``, each with map-side combine: a plain aggregate for the counts and
    moments (one small buffer per key and task), and the distinct-value table (keys, value,
    count) that :func:`prefix_sums` range-cuts and writes once; distinct counts, mode and
    quantiles are read off that written table. Keeping the moments out of the distinct-value
    pass keeps its shuffle rows narrow: that shuffle is the one that grows with the data.
    """
    v = F.col(value_col)
    moments = long.groupBy(*keys).agg(
        F.count(v).alias("n"), F.count_if(v.isNull()).alias("n_null"), F.min(v).alias("min"),
        F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))
    vc = long.filter(v.isNotNull()).groupBy(*keys, value_col).agg(F.count(F.lit(1)).alias("c"))
    r = prefix_sums(vc, keys, value_col, ["c"], n_keys=n_keys)
    q_aggs, q_finals = quantile_aggs(value_col, "c", list(probs), list(names))
    per = r.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_distinct"),
        F.min(F.struct((-F.col("c")).alias("neg"), v.alias("v"))).alias("_m"), *q_aggs)
    per = per.select(*keys, "n_distinct", F.col("_m.v").alias("mode"), *q_finals)
    out = moments.join(per, keys, "left")
    return out.select(*keys, "n", "n_null", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "min", "max",
                      "mean", "std", *list(names), "mode")


def prefix_min(df: DataFrame, keys: list[str], order_col: str, min_col: str, out: str,
               segments: int | None = None, n_keys: int | None = None) -> DataFrame:
    """Running minimum of ``min_col`` (any orderable type, e.g. a struct; nulls ignored) in
    ``order_col`` order within ``keys`` -- the same two-level scheme as :func:`prefix_sums`:
    per-segment minima, a small window over segments, then a window inside each segment."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    nseg = segments or _num_segments(df)
    tagged = materialize(df.repartitionByRange(nseg, *keys, order_col)
                         .withColumn("_seg", F.spark_partition_id()), "segments")
    seg = tagged.groupBy(*keys, "_seg").agg(F.min(min_col).alias("_segmin"))
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = seg.select(*keys, "_seg", F.min("_segmin").over(before).alias("_prevmin"))
    j = join_bounded(tagged, offsets, [*keys, "_seg"], max_rows=_bound(nseg, keys, n_keys))
    w = Window.partitionBy(*keys, "_seg").orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.min(min_col).over(w)
    best = F.when(F.col("_prevmin").isNull(), run).when(run.isNull(), F.col("_prevmin")).otherwise(
        F.least(run, F.col("_prevmin")))
    return j.select(*[F.col(c) for c in df.columns], best.alias(out))
