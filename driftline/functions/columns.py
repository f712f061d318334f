"""Column-level cleaning helpers: every one returns Columns or a single ``select``.

All of them compile to JVM expressions (whole-stage codegen), no Python per row.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, FloatType, IntegerType, LongType, NumericType,
                               ShortType, StringType)


def columns_of_type(df: DataFrame, kind: str, exclude: tuple[str, ...] = ()) -> list[str]:
    """Column names picked by type: ``string`` -> categorical, ``double`` -> numeric, etc."""
    kinds = {"string": (StringType,), "double": (DoubleType,), "float": (FloatType, DoubleType),
             "integral": (IntegerType, LongType, ShortType), "numeric": (NumericType,)}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude]


def ints_to_double(df: DataFrame) -> DataFrame:
    """Cast every integral column to double in one projection."""
    ints = set(columns_of_type(df, "integral"))
    return df.select([F.col(c).cast("double").alias(c) if c in ints else F.col(c) for c in df.columns])


def clean_money(c: str | Column) -> Column:
    """'$1,234.00' -> 1234.0 (strip currency symbol and thousands separators)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.translate(col, "$,", "").cast("double")


def null_flags(df: DataFrame, cols: list[str], suffix: str = "_na") -> DataFrame:
    """Add ``<c>_na`` = 1.0 where ``c`` is null else 0.0, for all columns in one select."""
    return df.select("*", *[F.when(F.col(c).isNull(), 1.0).otherwise(0.0).alias(c + suffix) for c in cols])


def row_sum(cols: list[str]) -> Column:
    """a + b + ... (null if any input is null)."""
    return reduce(add, [F.col(c) for c in cols])


def row_mean(cols: list[str]) -> Column:
    """(a + b + ...) / k, the generated-expression row mean; null if any input is null."""
    return row_sum(cols) / F.lit(float(len(cols)))


def threshold_label(c: str, threshold: float, inclusive: bool = True) -> Column:
    """Integer class label from a threshold (``price >= 150`` -> 1)."""
    cond = F.col(c) >= threshold if inclusive else F.col(c) > threshold
    return cond.cast("int")


def threshold_text(c: str, threshold: float, above: str, below: str) -> Column:
    return F.when(F.col(c) > threshold, F.lit(above)).otherwise(F.lit(below))


def null_out(c: str, value) -> Column:
    """Replace one value by null (pandas ``map(lambda)`` re-expressed)."""
    return F.nullif(F.col(c), F.lit(value))


def fill_missing_category(c: str, token: str = "missing") -> Column:
    return F.coalesce(F.col(c), F.lit(token))


def modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, mode) for several columns in one job: unpivot, count per value, min struct."""
    long = (df.select([F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], cols, "feature", "value").filter(F.col("value").isNotNull()))
    vc = long.groupBy("feature", "value").count()
    return (vc.groupBy("feature")
            .agg(F.min(F.struct((-F.col("count")).alias("neg"), F.col("value").alias("v"))).alias("m"))
            .select("feature", F.col("m.v").alias("mode")))


def fill_with_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """coalesce(c, mode(c)) for categorical columns.

    Like an imputer's fit, the modes (one scalar per column, so bounded by the schema) are
    fetched to the driver and applied as literals.
    """
    found = {r["feature"]: r["mode"] for r in modes(df, cols).collect()}
    return df.select([F.coalesce(F.col(c), F.lit(found.get(c)).cast(df.schema[c].dataType)).alias(c)
                      if c in cols else F.col(c) for c in df.columns])


def present(c: Column, kind: str = "double") -> Column:
    """NaN counts as missing: null in its place for floating columns."""
    return F.when(~F.isnan(c), c) if kind in ("double", "float") else c


def missing(df: DataFrame, name: str) -> Column:
    """True where a column is null or, for floating columns, NaN."""
    c = F.col(name)
    return c.isNull() | F.isnan(c) if df.schema[name].dataType.simpleString() in ("double", "float") else c.isNull()
