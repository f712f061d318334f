"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus optional DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FAMILY: dict[str, str] = {}


def query(name: str, sql: str | None = None, family: str = "misc"):
    """Register a query under ``name``; ``sql`` is its DuckDB oracle (None = rows-only check)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        FAMILY[name] = family
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column so both engines hash the same digits."""
    return df.select([F.round(F.col(f.name), digits).alias(f.name)
                      if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                      for f in df.schema.fields])
