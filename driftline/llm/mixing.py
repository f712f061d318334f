"""Mixing sources to target weights by entropy balancing.

Each source gets a target number of words: sources in code-point order (null last) have the weights
WEIGHTS in turn and share BUDGET times all words; a target stops at MAX_COPIES times the source's
own words and the excess is shared again among the others.

* *Dual.* Document rates between 0 and MAX_COPIES that stay as close as possible (in bounded
  entropy) to one copy and meet the word target of their source are
  ``rate = MAX_COPIES / (1 + exp(-tilt * size / mean size))``. The convex dual has one tilt per
  source; Newton steps solve all sources at once. Every step is one grouped aggregate over the
  (source, size) histogram, not over documents.
* *Rounding.* Rates become whole copies by systematic rounding: cells of equal source, size and
  salt are ordered by size, fractions are summed up along them, and a cell gives an extra copy to
  as many of its documents, in hash order, as whole numbers are passed. The error of a source stays
  below about one largest document; of OFFSETS starting points the one nearest the target is used.
  Salts keep a cell of equal sizes (a large group of copies) to about CELL_ROWS rows per group.

Cases: null and wordless texts have size 0 and are never taken; a null source is a source of its own;
repeated rows are rounded each, on their own; ties in the hash are equal documents; other columns
are ignored (``mix`` hands them on); an empty table gives an empty result. All is deterministic: a rerun takes
the same copies.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.text import SPACE_SEP, split_words
from driftline.session import materialize

WEIGHTS = (3, 1, 2)
BUDGET = Fraction(3, 2)
MAX_COPIES = 2
CELL_ROWS = 5000
OFFSETS = 32
TOLERANCE = 1e-7
MAX_STEPS = 200


def _key() -> Column:
    """The source as a join key that also tells null."""
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (one row per source: source, source_size) with weight and target. The windows
    run over the table of sources only."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(w) for w in WEIGHTS])
    df = sources.withColumn("weight", F.get(turn, (F.row_number().over(by_name) - 1) % len(WEIGHTS)))
    cap = MAX_COPIES * F.col("source_size")
    df = df.withColumn("_cap", cap).withColumn("_ratio", F.col("_cap") / F.col("weight"))
    # with the sources of smallest cap per weight capped, the others share the rest; the share
    # per weight is largest for the right number of capped ones
    before = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_ratio").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * float(BUDGET)
    left = total - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    df = df.withColumn("_share", left / weight)
    df = df.withColumn("_share", F.max("_share").over(everything))
    target = F.least(F.col("_cap").cast("double"), F.col("_share") * F.col("weight"))
    return df.select("source", "source_size", "weight", target.alias("target"))


def _rate(size: Column) -> Column:
    tilt = F.col("tilt") * size / F.col("mean")
    return F.when(F.col("full"), F.lit(float(MAX_COPIES))).otherwise(MAX_COPIES / (1 + F.exp(-tilt)))


def solve_tilts(hist: DataFrame, goal: DataFrame) -> DataFrame:
    """(k, tilt, mean, full, target) per source. ``hist``: k, size, n; ``goal``: k, source_size,
    target, docs. From tilt 0 the Newton steps approach each solution from one side."""
    full = (F.col("source_size") == 0) | (F.col("target") >= MAX_COPIES * F.col("source_size") * (1 - 1e-9))
    state = goal.select("k", "target", full.alias("full"), F.lit(0.0).alias("tilt"),
                        F.greatest(F.col("source_size") / F.greatest("docs", F.lit(1)), F.lit(1e-9)).alias("mean"))
    state = materialize(state, "tilts")
    for _ in range(MAX_STEPS):
        cells = hist.join(state.filter("NOT full"), "k")
        rate = _rate(F.col("size"))
        words = F.col("n") * F.col("size")
        step = cells.groupBy("k").agg(F.sum(words * rate).alias("f"),
                                      F.sum(words * rate * (1 - rate / MAX_COPIES) * F.col("size") / F.col("mean")).alias("df"))
        miss = F.col("target") - F.col("f")
        state = state.join(step, "k", "left").select(
            "k", "target", "full", (F.col("tilt") + F.when(F.col("df") > 0, miss / F.col("df")).otherwise(0.0)).alias("tilt"), "mean",
            F.coalesce(F.abs(miss) / F.greatest("target", F.lit(1.0)), F.lit(0.0)).alias("error"))
        state = materialize(state, "tilts")
        if (state.agg(F.max("error")).first()[0] or 0.0) <= TOLERANCE:
            return state.drop("error")
    raise RuntimeError("entropy balancing did not converge")


def _sizes(docs: DataFrame) -> DataFrame:
    size = F.size(split_words(F.col("text"), SPACE_SEP)).cast("bigint")
    order = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text"))
    return docs.select("doc_id", "source", _key().alias("k"), size.alias("size"), order.alias("h"), F.xxhash64("text").alias("_th"))


def mix_plan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (needs doc_id, source, text): doc_id, _th, size, source_size,
    target, rate, copies and taken."""
    sized = materialize(_sizes(docs), "sizes")
    hist = materialize(sized.groupBy("k", "size").agg(F.count("*").alias("n"), F.first("source", ignorenulls=True).alias("source")), "histogram")
    total = hist.groupBy("k").agg(F.first("source", ignorenulls=True).alias("source"), F.sum(F.col("n") * F.col("size")).alias("source_size"),
                                  F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("docs"))
    total = materialize(total, "sources")
    goal = total.drop("source_size").join(targets(total.select("source", "source_size")).withColumn("k", _key()).drop("source"), "k")
    goal = materialize(goal, "targets")
    tilts = solve_tilts(hist.select("k", "size", "n"), goal)

    # cells of at most about CELL_ROWS documents of one source and size
    rate = hist.join(tilts, "k").select("k", "size", F.when(F.col("size") > 0, _rate(F.col("size"))).otherwise(0.0).alias("rate"),
                                        F.ceil(F.col("n") / CELL_ROWS).alias("salts"))
    rate = rate.withColumn("base", F.floor("rate")).withColumn("part", F.col("rate") - F.floor("rate"))
    rated = materialize(sized.join(rate, ["k", "size"]).withColumn("salt", F.pmod("h", "salts")), "rated")
    cells = rated.groupBy("k", "size", "salt").agg(F.count("*").alias("n"), F.min("base").alias("base"), F.min("part").alias("part"))
    along = Window.partitionBy("k").orderBy("size", "salt").rowsBetween(Window.unboundedPreceding, 0)
    cells = materialize(cells.withColumn("upto", F.sum(F.col("n") * F.col("part")).over(along)), "cells")

    def extra(start: Column) -> Column:
        return F.floor(F.col("upto") + start) - F.floor(F.col("upto") - F.col("n") * F.col("part") + start)

    starts = F.explode(F.array(*[F.lit((i + 0.5) / OFFSETS) for i in range(OFFSETS)])).alias("start")
    tried = cells.select("k", "size", "n", "base", "part", "upto", starts)
    tried = tried.groupBy("k", "start").agg(F.sum(F.col("size") * (F.col("n") * F.col("base") + extra(F.col("start")))).alias("words"))
    best = (tried.join(goal.select("k", "target"), "k").groupBy("k")
            .agg(F.min(F.struct(F.abs(F.col("words") - F.col("target")).alias("miss"), "start")).alias("b")).select("k", "b.start"))
    lots = cells.join(best, "k").select("k", "size", "salt", extra(F.col("start")).alias("extra"))

    rank = F.row_number().over(Window.partitionBy("k", "size", "salt").orderBy("h", "doc_id"))
    out = rated.withColumn("rank", rank).join(lots, ["k", "size", "salt"])
    copies = (F.col("base") + F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)).cast("bigint")
    out = out.withColumn("copies", F.least(copies, F.lit(MAX_COPIES)))
    out = out.join(goal.select("k", "source_size", "target"), "k")
    return out.select("doc_id", "_th", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes: all columns of ``docs`` and copies, taken and target, each with
    underscores before it until its name is free. Rows equal in doc_id and text come out as one, with their copies
    added up."""
    plan = mix_plan(docs).groupBy("doc_id", "_th").agg(F.sum("copies").alias("copies"), F.sum("taken").alias("taken"),
                                                       F.first("target").alias("target")).filter("copies > 0")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.select("_row", F.col("_row.doc_id").alias("doc_id"), F.xxhash64("_row.text").alias("_th"))
    same = F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("r._th") == F.col("p._th"))
    out = rows.alias("r").join(plan.alias("p"), same).select("_row", "r.doc_id", "r._th", "copies", "taken", "target")
    out = out.dropDuplicates(["doc_id", "_th"])
    own = {c: c for c in ("copies", "taken", "target")}
    for c in own:
        while own[c] in docs.columns:
            own[c] = f"_{own[c]}"
    return out.select("_row.*", *[F.col(c).alias(name) for c, name in own.items()])
