"""Connected components of a large edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.session import materialize


def _star(e: DataFrame, small: bool) -> DataFrame:
    """One star step on edges (u, v). Only grouped minima and joins: a vertex with very many
    neighbours is a partially aggregated group and a join key that adaptive execution splits."""
    both = e.select("u", "v") if small else e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    if small:
        hooked = both.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = hooked.union(low.select("u", F.col("m").alias("v")))
    else:
        low = low.withColumn("m", F.least("u", "m"))
        out = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(v, c): every vertex of ``edges`` (long columns u, v) with the smallest vertex of its
    component. Each round is written to the shared folder, so a lost executor only costs its
    own tasks. Raises if the rounds do not suffice (they grow with the logarithm of the
    longest chain)."""
    e = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        e = materialize(_star(_star(e, small=False), small=True), "edges")
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            roots = e.select(F.col("v").alias("u"), "v")
            return e.union(roots).distinct().select(F.col("u").alias("v"), F.col("v").alias("c"))
        seen = state
    raise RuntimeError(f"components did not converge in {max_rounds} rounds")
