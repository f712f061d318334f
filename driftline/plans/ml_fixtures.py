"""Model-oriented stand-ins built from the driver tables (FIXTURES.md part B)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.sources.tables import Tables


def grouped_facts(t: Tables) -> DataFrame:
    """Events with a group key (user_id % 12), two more numbers taken from them, and a label that depends on these."""
    ev = t.events
    return ev.select(F.col("event_id").alias("event_id"), (F.col("user_id") % 12).cast("int").alias("user_group"),
                     F.col("value").alias("value"), ((F.col("event_id") % 100).cast("double") / 10).alias("tail"),
                     F.get_json_object("props", "$.k").cast("double").alias("k"),
                     F.round(F.col("value") * 2 + (F.col("event_id") % 100) / 10.0, 6).alias("label"))


def listings(t: Tables) -> DataFrame:
    """Listings stand-in: lineitem joined to part (label l_extendedprice; categoricals
    l_returnflag, l_linestatus, p_brand, p_type; numerics quantity, discount, tax, size)."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax",
                           "l_returnflag", "l_linestatus", "l_extendedprice")
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type",
                      F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return li.join(p, "l_partkey")
