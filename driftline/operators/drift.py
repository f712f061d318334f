"""Drift tests between two windows of the same table, all features at once.

Both windows are stacked with a window id ``_w`` (1 = baseline, 2 = current) and unpivoted to
``(keys..., _w, value)``; every test is then a grouped aggregate keyed by ``keys`` (the feature,
or (pair, feature) for rolling windows). Partial aggregation happens map-side, so neither the
number of rows nor a hot value concentrates work in one task. One Spark job answers a test
for every column, instead of one pass per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.columns import missing, present
from driftline.functions.stats import chi2_sf, ks_pvalue_sql, xlogy_ratio
from driftline.operators.ecdf import prefix_sums
from driftline.operators.joins import join_bounded
from driftline.operators.quantiles import statistics_frame
from driftline.session import materialize, materialize_small

W = "_w"


def stack(base: DataFrame, current: DataFrame) -> DataFrame:
    """Union two windows with the same columns, tagged ``_w`` = 1 / 2."""
    if sorted(base.columns) != sorted(current.columns):
        raise ValueError("the two windows have different columns")
    return (base.withColumn(W, F.lit(1))
            .unionByName(current.select(*base.columns).withColumn(W, F.lit(2))))


def tag_windows(df: DataFrame, baseline_cond) -> DataFrame:
    """One scan instead of two: tag rows of a single table as baseline (1) or current (2)."""
    tagged = df.withColumn(W, F.when(baseline_cond, F.lit(1)).when(~baseline_cond, F.lit(2)))
    return tagged.filter(F.col(W).isNotNull())  # where the condition is null a row is in neither window


def to_long(stacked: DataFrame, cols: list[str], keys: tuple[str, ...] = (),
            cast: str | None = "double", keep_nulls: bool = False) -> DataFrame:
    """Unpivot ``cols`` to ``(keys..., _w, feature, value)``; NaN is a null, and nulls are dropped
    unless asked."""
    ids = [*keys, W]
    src = stacked.select(*ids, *[(present(F.col(c).cast(cast), cast) if cast else F.col(c)).alias(c) for c in cols])
    long = src.unpivot(ids, cols, "feature", "value")
    return long if keep_nulls else long.filter(F.col("value").isNotNull())


def _n(w: int) -> F.Column:
    return F.count_if(F.col(W) == w)


# ---------------------------------------------------------------- Jensen-Shannon / histograms
def histogram_counts(long: DataFrame, keys: list[str], bins: int = 20, n_tests: int | None = None,
                     rng: DataFrame | None = None) -> DataFrame:
    """Fixed-width histogram of both windows over their joint [lo, hi], last bin closed.

    Returns keys, bin, c1, c2, n1, n2, lo, hi (every bin 0..bins-1 present, zero-filled).
    The per-key range table has one row per test: broadcast when ``n_tests`` bounds it.
    ``rng`` (keys, lo, hi, n1, n2) may be given when an earlier pass already computed it.
    """
    if rng is None:
        # one row per key, used twice below (bin edges, zero-filled grid): materialise it once
        # so the table is scanned by this pass and the counting pass only
        rng = materialize_small(long.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                                        _n(1).alias("n1"), _n(2).alias("n2")))
    b = (F.when(F.col("hi") == F.col("lo"), F.lit(0))
         .otherwise(F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins),
                            F.lit(bins - 1))).cast("int"))
    counts = (join_bounded(long, rng.select(*keys, "lo", "hi"), keys, max_rows=n_tests)
              .groupBy(*keys, b.alias("bin")).agg(_n(1).alias("c1"), _n(2).alias("c2")))
    grid = rng.select(*keys, "lo", "hi", "n1", "n2",
                      F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    cells = None if n_tests is None else n_tests * bins
    return (join_bounded(grid, counts, [*keys, "bin"], "left", max_rows=cells)
            .select(*keys, "bin", F.coalesce("c1", F.lit(0)).alias("c1"),
                    F.coalesce("c2", F.lit(0)).alias("c2"), "n1", "n2", "lo", "hi"))


def js_distance(long: DataFrame, keys: list[str], bins: int = 20, n_tests: int | None = None,
                rng: DataFrame | None = None) -> DataFrame:
    """Jensen-Shannon distance (base 2) of the two windows' histograms: keys, n1, n2, js_distance."""
    h = histogram_counts(long, keys, bins, n_tests, rng)
    p = F.try_divide(F.col("c1"), F.col("n1"))
    q = F.try_divide(F.col("c2"), F.col("n2"))
    m = (p + q) / 2
    g = h.groupBy(*keys).agg(F.first("n1").alias("n1"), F.first("n2").alias("n2"),
                             F.sum(xlogy_ratio(p, m) + xlogy_ratio(q, m)).alias("_div"))
    js = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.sqrt(F.greatest(F.col("_div") / 2, F.lit(0.0))))
    return g.select(*keys, "n1", "n2", js.alias("js_distance"))


def kl_divergence(long: DataFrame, keys: list[str], bins: int = 20, n_tests: int | None = None) -> DataFrame:
    """KL(baseline || current) in nats over the shared histogram; null where it is infinite."""
    h = histogram_counts(long, keys, bins, n_tests)
    p = F.try_divide(F.col("c1"), F.col("n1"))
    q = F.try_divide(F.col("c2"), F.col("n2"))
    g = h.groupBy(*keys).agg(
        F.sum(F.when((F.col("c1") > 0) & (F.col("c2") > 0), p * F.log(p / q)).otherwise(0.0)).alias("_kl"),
        F.max(F.when((F.col("c1") > 0) & (F.col("c2") == 0), 1).otherwise(0)).alias("_inf"))
    return g.select(*keys, F.when(F.col("_inf") == 0, F.col("_kl")).alias("kl_divergence"))


# ---------------------------------------------------------------- ECDF based tests
def value_counts_by_window(long: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (keys, distinct value) with per-window counts (map-side combined)."""
    return (long.groupBy(*keys, "value")
            .agg(_n(1).alias("c1"), _n(2).alias("c2"))
            .withColumn("c", F.col("c1") + F.col("c2")))


def ranked(long: DataFrame, keys: list[str], with_next: bool = False, n_tests: int | None = None) -> DataFrame:
    """Distinct values with running counts per window (two-level prefix sums)."""
    return prefix_sums(value_counts_by_window(long, keys), keys, "value", ["c1", "c2", "c"],
                       with_next=with_next, n_keys=n_tests)


def ks_test(long: DataFrame, keys: list[str], alpha: float = 0.05,
            n_tests: int | None = None, correct: bool = True) -> DataFrame:
    """Two-sample KS: D = max |F1 - F2|, asymptotic p; drift when p <= alpha / #tests, or when
    p <= alpha without ``correct``. ``n_tests`` is the number of keys, where it is known."""
    r = ranked(long, keys, n_tests=n_tests)
    d = F.abs(F.try_divide(F.col("cum_c1"), F.col("total_c1")) - F.try_divide(F.col("cum_c2"), F.col("total_c2")))
    g = r.groupBy(*keys).agg(F.first("total_c1").alias("n1"), F.first("total_c2").alias("n2"),
                             F.max(d).alias("ks_stat"))
    z = "ks_stat * sqrt(cast(n1 as double) * n2 / (n1 + n2))"
    out = g.withColumn("p_value", F.expr(ks_pvalue_sql(z)))
    if not correct:
        a = F.lit(alpha)
    elif n_tests is None:
        a = F.lit(alpha) / F.count(F.lit(1)).over(Window.partitionBy(*[k for k in keys if k != "feature"]))
    else:
        a = F.lit(alpha / n_tests)
    return out.withColumn("alpha_corrected", a).withColumn("drift", F.col("p_value") <= F.col("alpha_corrected"))


def wasserstein1(long: DataFrame, keys: list[str], n_tests: int | None = None) -> DataFrame:
    """Wasserstein-1 distance = integral of |F1 - F2| over the value axis."""
    r = ranked(long, keys, with_next=True, n_tests=n_tests)
    d = F.abs(F.try_divide(F.col("cum_c1"), F.col("total_c1")) - F.try_divide(F.col("cum_c2"), F.col("total_c2")))
    gap = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    return r.groupBy(*keys).agg(F.sum(d * gap).alias("wasserstein1"))


def mann_whitney(long: DataFrame, keys: list[str], n_tests: int | None = None) -> DataFrame:
    """Mann-Whitney U of the baseline sample (= Wilcoxon rank-sum), average ranks for ties,
    plus the tie-corrected normal score with continuity correction."""
    r = ranked(long, keys, n_tests=n_tests)
    avg_rank = F.col("cum_c") - F.col("c") + (F.col("c") + 1) / 2.0
    g = r.groupBy(*keys).agg(F.first("total_c1").alias("n1"), F.first("total_c2").alias("n2"),
                             F.sum(F.col("c1") * avg_rank).alias("r1"),
                             F.sum(F.pow(F.col("c").cast("double"), 3) - F.col("c")).alias("ties"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u = F.col("r1") - n1 * (n1 + 1) / 2
    mu = n1 * n2 / 2
    sigma = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    z = F.try_divide(u - mu - F.signum(u - mu) * 0.5, sigma)
    return g.select(*keys, "n1", "n2", u.alias("u_stat"), z.alias("z_score"))


# ---------------------------------------------------------------- chi-squared
def category_counts(stacked: DataFrame, cols: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Contingency counts (keys, feature, value, o1, o2), nulls dropped, missing cells = 0.

    One grouped count replaces the full outer join of two value-count tables. The table (a row per
    feature and category: as many as the data have distinct values) is read twice by the tests,
    so it is written once instead of scanning the source twice.
    """
    long = to_long(stacked, cols, keys, cast="string")
    return materialize(long.groupBy(*keys, "feature", "value").agg(_n(1).alias("o1"), _n(2).alias("o2")))


def chi2_test(counts: DataFrame, keys: list[str], alpha: float = 0.05,
              n_tests: int | None = None) -> DataFrame:
    """Two-way chi-squared contingency test per key (Yates correction when dof = 1)."""
    tot = counts.groupBy(*keys).agg(F.sum("o1").alias("n1"), F.sum("o2").alias("n2"),
                                    F.count(F.lit(1)).alias("k"))
    j = join_bounded(counts, tot, keys, max_rows=n_tests)
    big_n = (F.col("n1") + F.col("n2")).cast("double")
    row = (F.col("o1") + F.col("o2")).cast("double")
    dof = F.col("k") - 1

    def term(o, n):
        e = row * F.col(n) / big_n
        dev = F.abs(F.col(o) - e)
        dev = F.when(dof == 1, dev - F.least(F.lit(0.5), dev)).otherwise(dev)
        return F.try_divide(dev * dev, e)

    g = j.groupBy(*keys).agg(F.sum(term("o1", "n1") + term("o2", "n2")).alias("_chi2"),
                             F.first("k").alias("k"))
    out = g.select(*keys, F.when(F.col("k") > 1, F.col("_chi2")).otherwise(0.0).alias("chi2"),
                   (F.col("k") - 1).cast("long").alias("dof"))
    out = out.withColumn("p_value", chi2_sf(F.col("chi2"), F.col("dof")))
    if n_tests is None:
        a = F.lit(alpha) / F.count(F.lit(1)).over(Window.partitionBy(*[k for k in keys if k != "feature"]))
    else:
        a = F.lit(alpha / n_tests)
    return out.withColumn("alpha_corrected", a).withColumn("drift", F.col("p_value") < F.col("alpha_corrected"))


def chi2_goodness(counts: DataFrame, keys: list[str], n_tests: int | None = None) -> DataFrame:
    """One-way chi-squared: current counts against baseline proportions (scaled to n2)."""
    tot = counts.groupBy(*keys).agg(F.sum("o1").alias("n1"), F.sum("o2").alias("n2"),
                                    F.count(F.lit(1)).alias("k"))
    j = join_bounded(counts, tot, keys, max_rows=n_tests)
    e = F.try_divide(F.col("o1").cast("double") * F.col("n2"), F.col("n1"))
    g = j.groupBy(*keys).agg(
        F.sum(F.when(e > 0, (F.col("o2") - e) * (F.col("o2") - e) / e).otherwise(0.0)).alias("chi2"),
        F.max(F.when((e == 0) & (F.col("o2") > 0), 1).otherwise(0)).alias("_unseen"),
        F.first("k").alias("k"))
    return g.select(*keys, F.when(F.col("_unseen") == 0, F.col("chi2")).alias("chi2"),
                    (F.col("k") - 1).cast("long").alias("dof"))


# ---------------------------------------------------------------- nulls and summaries
def null_rates(base: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """Percent nulls per column in each window: one aggregate over the stacked frame."""
    return null_rates_stacked(stack(base.select(*cols), current.select(*cols)), cols)


def null_rates_stacked(st: DataFrame, cols: list[str]) -> DataFrame:
    agg = st.groupBy(W).agg(F.count(F.lit(1)).alias("_n"),
                            *[F.count_if(missing(st, c)).alias(c) for c in cols])
    long = agg.unpivot([W, "_n"], cols, "feature", "nulls")
    g = long.groupBy("feature").agg(
        F.sum(F.when(F.col(W) == 1, 100.0 * F.col("nulls") / F.col("_n"))).alias("null_pct_1"),
        F.sum(F.when(F.col(W) == 2, 100.0 * F.col("nulls") / F.col("_n"))).alias("null_pct_2"),
        F.sum(F.when(F.col(W) == 1, F.col("nulls"))).alias("nulls_1"),
        F.sum(F.when(F.col(W) == 2, F.col("nulls"))).alias("nulls_2"))
    return g


SUMMARY_STATS = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]


def summary_pct_change(base: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """100 * |(s1 - s2) / (s1 + 1e-100)| for each summary statistic and column."""
    return summary_pct_change_stacked(stack(base.select(*cols), current.select(*cols)), cols)


def summary_pct_change_stacked(st: DataFrame, cols: list[str]) -> DataFrame:
    s = statistics_frame(st, cols, [0.25, 0.5, 0.75], ["p25", "p50", "p75"], by=W).filter("n > 0")
    s = s.withColumn("count", F.col("n").cast("double"))
    stats = s.unpivot(["feature", W], SUMMARY_STATS, "stat", "v")
    g = stats.groupBy("feature", "stat").agg(F.sum(F.when(F.col(W) == 1, F.col("v"))).alias("s1"),
                                             F.sum(F.when(F.col(W) == 2, F.col("v"))).alias("s2"))
    return g.select("feature", "stat", "s1", "s2",
                    (100 * F.abs((F.col("s1") - F.col("s2")) / (F.col("s1") + F.lit(1e-100)))).alias("pct_change"))


# ---------------------------------------------------------------- the monitor
REPORT_COLUMNS = ["feature", "test", "statistic", "p_value", "threshold", "drift"]


def drift_report(base: DataFrame, current: DataFrame, cat_cols: list[str], num_cols: list[str],
                 alpha: float = 0.05, js_threshold: float = 0.2, with_ks: bool = False) -> DataFrame:
    """One report row per (feature, test): JS for numeric columns (drift if >= threshold),
    chi-squared for categorical ones (drift if p < alpha / #categorical), the total null
    count of each window, and optionally KS (drift if p <= alpha / #numeric)."""
    cols = [*num_cols, *cat_cols]
    return drift_report_stacked(stack(base.select(*cols), current.select(*cols)), cat_cols, num_cols,
                                alpha, js_threshold, with_ks)


def window_ranges(st: DataFrame, num_cols: list[str], cat_cols: list[str]) -> DataFrame:
    """One wide aggregate per window, no unpivot of rows: (feature, _w, lo, hi, n, nulls), at most two
    rows per column; ranges of numeric columns, counts of all. Checkpointed, as three steps read it."""
    cols = [*num_cols, *cat_cols]
    src = st.select(W, *[present(F.col(c).cast("double"), "double").alias(c) for c in num_cols], *cat_cols)
    per = src.groupBy(W).agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
                             *[f(c).alias(f"{name}_{i}") for i, c in enumerate(num_cols) for name, f in (("lo", F.min), ("hi", F.max))])
    none = F.lit(None).cast("double")
    each = [F.struct(F.lit(c).alias("feature"), (F.col(f"lo_{i}") if i < len(num_cols) else none).alias("lo"),
                     (F.col(f"hi_{i}") if i < len(num_cols) else none).alias("hi"), F.col(f"n_{i}").alias("n"),
                     (F.col("rows") - F.col(f"n_{i}")).alias("nulls")) for i, c in enumerate(cols)]
    return materialize_small(per.select(W, F.explode(F.array(*each)).alias("c")).select(W, "c.*"))


def drift_report_stacked(st: DataFrame, cat_cols: list[str], num_cols: list[str], alpha: float = 0.05,
                         js_threshold: float = 0.2, with_ks: bool = False) -> DataFrame:
    """:func:`drift_report` over one frame already tagged with ``_w`` (see :func:`tag_windows`).

    Three narrow scans of ``st`` for any number of columns: :func:`window_ranges`, the histogram pass
    over the numeric columns, which joins the broadcast range table (one row per numeric feature),
    and the contingency counts of the categorical ones."""
    prof = window_ranges(st, num_cols, cat_cols)
    parts = []
    if num_cols:
        rng = prof.filter(F.col("feature").isin(num_cols)).groupBy("feature").agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.coalesce(F.sum(F.when(F.col(W) == w, F.col("n"))), F.lit(0)).alias(f"n{w}") for w in (1, 2)])
        js = js_distance(to_long(st, num_cols), ["feature"], n_tests=len(num_cols), rng=rng)
        parts.append(js.select("feature", F.lit("js_distance").alias("test"),
                               F.col("js_distance").alias("statistic"),
                               F.lit(None).cast("double").alias("p_value"),
                               F.lit(float(js_threshold)).alias("threshold"),
                               (F.col("js_distance") >= js_threshold).alias("drift")))
    if with_ks and num_cols:
        ks = ks_test(to_long(st, num_cols), ["feature"], alpha, len(num_cols))
        parts.append(ks.select("feature", F.lit("ks").alias("test"), F.col("ks_stat").alias("statistic"),
                               "p_value", F.col("alpha_corrected").alias("threshold"), "drift"))
    if cat_cols:
        ch = chi2_test(category_counts(st, cat_cols), ["feature"], alpha, len(cat_cols))
        parts.append(ch.select("feature", F.lit("chi2").alias("test"), F.col("chi2").alias("statistic"),
                               "p_value", F.col("alpha_corrected").alias("threshold"), "drift"))
    nulls = prof.groupBy(W).agg(F.sum("nulls").alias("nulls"))  # empty windows get no row
    parts.append(nulls.select(F.lit("*").alias("feature"),
                              F.concat(F.lit("total_nulls_"), F.col(W).cast("string")).alias("test"),
                              F.col("nulls").cast("double").alias("statistic"),
                              F.lit(None).cast("double").alias("p_value"),
                              F.lit(None).cast("double").alias("threshold"),
                              F.lit(False).alias("drift")))
    return reduce(DataFrame.unionByName, parts)


def alerts(report: DataFrame, run_label: str | None = None) -> DataFrame:
    """``on_drift`` as data: the drifted rows of a report, ready to append to an alert table."""
    out = report.filter(F.col("drift")).select("feature", "test", "statistic", "p_value", "threshold")
    out = out.withColumn("message", F.concat(F.lit("distribution change: "), F.col("feature")))
    if run_label is not None:
        out = out.withColumn("run", F.lit(run_label))
    return out


# ---------------------------------------------------------------- rolling windows
def consecutive_pairs(df: DataFrame, period_col: str, cols: list[str], cast: str | None = "double") -> DataFrame:
    """Long frame keyed by (pair, feature): period k is the current window of pair k and the
    baseline of pair k+1 (each row is emitted twice; no self-join)."""
    dup = df.select(period_col, *cols).withColumn(
        "_role", F.explode(F.array(F.lit(1), F.lit(2))))
    pair = F.when(F.col("_role") == 2, F.col(period_col)).otherwise(F.col(period_col) + 1)
    st = dup.select(pair.alias("pair"), F.col("_role").alias(W), *cols)
    return st


BROADCAST_RANGES = 100_000  # rows of a range table that is still sent to every task


def rolling_js(df: DataFrame, period_col: str, cols: list[str], bins: int = 20) -> DataFrame:
    """JS distance of every period against the previous one (integer period ids). Periods come from
    the data, so the range table (a row per pair and feature) is broadcast only after it has been
    counted; beyond ``BROADCAST_RANGES`` rows it is a shuffle join."""
    keys = ["pair", "feature"]
    long = to_long(consecutive_pairs(df, period_col, cols), cols, keys=("pair",))
    # both ranges and counts come from one row per period, not from the doubled rows
    per = to_long(df.withColumn(W, F.lit(2)), cols, keys=(period_col,)).groupBy(period_col, "feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count(F.lit(1)).alias("n"))
    twice = per.select(F.explode(F.array(*[F.struct((F.col(period_col) + k).alias("pair"), F.lit(2 - k).alias(W)) for k in (0, 1)])).alias("r"),
                       "feature", "lo", "hi", "n")
    rng = materialize(twice.groupBy("r.pair", "feature").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        *[F.coalesce(F.sum(F.when(F.col(f"r.{W}") == w, F.col("n"))), F.lit(0)).alias(f"n{w}") for w in (1, 2)]), "ranges")
    n = rng.count()
    js = js_distance(long, keys, bins, n if n <= BROADCAST_RANGES else None, rng)
    return js.filter((F.col("n1") > 0) & (F.col("n2") > 0))
