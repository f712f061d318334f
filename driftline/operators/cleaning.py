"""Imputation with exact statistics (MLlib's Imputer median is sketch-approximate)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.profile import quantiles


def impute_exact_median(df: DataFrame, cols: list[str], flag_suffix: str = "_na") -> DataFrame:
    """Fill nulls with each column's exact median and add ``<c>_na`` indicator columns.

    The medians (one scalar per column, bounded by the schema) are computed distributed and
    applied as literals, like a fitted imputer's surrogate values."""
    med = {r["feature"]: r["median"] for r in quantiles(df, cols, [0.5], ["median"]).collect()}
    out = df.select("*", *[F.when(F.col(c).isNull(), 1.0).otherwise(0.0).alias(c + flag_suffix) for c in cols])
    return out.select([F.coalesce(F.col(c), F.lit(med.get(c)).cast("double")).alias(c) if c in cols else F.col(c)
                       for c in out.columns])
