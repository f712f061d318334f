"""Join helper for tables with one row per schema column or per test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def join_bounded(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int | None = None) -> DataFrame:
    """Join with a broadcast hint when the caller passes a bound that follows from the schema or
    the session (columns, tests, segments; never a count of data rows). Without one the plan
    stays a shuffle join and AQE decides at run time from the measured size
    (``spark.sql.adaptive.autoBroadcastJoinThreshold``)."""
    if max_rows is not None:
        small = F.broadcast(small)
    return big.join(small, on, how)
