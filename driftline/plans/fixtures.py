"""Stand-ins for the reference's inputs, derived from the driver tables (FIXTURES.md part B).

Each builder is a lazy DataFrame over the given tables, so its work grows with them. The
matching SQL text (same rule, DuckDB dialect) sits next to it for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.sources.tables import Tables

# Fixed values of the drift fixture: split date and the column roles.
SPLIT_DATE = "1998-06-01"
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_CAT = ["l_returnflag", "l_linestatus"]


def lineitem_tagged(t: Tables, shifted: bool = False) -> DataFrame:
    """Both windows from a single scan, tagged ``_w`` (1 before the split date, else 2)."""
    li = t.lineitem.select(*LI_NUM, *LI_CAT, "l_shipdate")
    w = F.when(F.col("l_shipdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz"), F.lit(1)).otherwise(F.lit(2))
    out = li.withColumn("_w", w).drop("l_shipdate")
    if shifted:
        cur = F.col("_w") == 2
        out = out.withColumns({c: F.when(cur, e).otherwise(F.col(c)) for c, e in _shifts().items()})
    return out


def _shifts() -> dict:
    """Drift for tests: prices move by an offset, large quantities swap their discount for the
    tax, and flag N is missing where the quantity divides by three."""
    big = F.col("l_quantity") > 25
    return {"l_extendedprice": F.col("l_extendedprice") + 20000,
            "l_tax": F.when(big, F.col("l_discount") + 0.05).otherwise(F.col("l_tax")),
            "l_returnflag": F.when((F.col("l_returnflag") == "N") & (F.col("l_quantity") % 3 == 0), F.lit(None)).otherwise(F.col("l_returnflag"))}


LINEITEM_W_SQL = (f"SELECT CASE WHEN l_shipdate < TIMESTAMP '{SPLIT_DATE}' THEN 1 ELSE 2 END AS w, "
                  "l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem")


def shifted_current(cur: DataFrame) -> DataFrame:
    """The same shifts on one window."""
    return cur.withColumns(_shifts())


SHIFTED_W_SQL = (f"SELECT w, l_quantity, CASE WHEN w = 2 THEN l_extendedprice + 20000 ELSE l_extendedprice END AS l_extendedprice, "
                 "l_discount, CASE WHEN w = 2 AND l_quantity > 25 THEN l_discount + 0.05 ELSE l_tax END AS l_tax, "
                 "CASE WHEN w = 2 AND l_returnflag = 'N' AND l_quantity % 3 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag, l_linestatus "
                 f"FROM ({LINEITEM_W_SQL})")


# Deterministic nulls (the driver tables hold none): fixed rules on l_orderkey.
def lineitem_nulls(t: Tables) -> DataFrame:
    li = t.lineitem
    k = F.col("l_orderkey")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                     F.when(k % 10 != 0, F.col("l_discount")).alias("l_discount"),
                     F.when(k % 7 != 0, F.col("l_tax")).alias("l_tax"),
                     F.when(k % 11 != 0, F.col("l_returnflag")).alias("l_returnflag"),
                     "l_linestatus")


LINEITEM_NULLS_SQL = ("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, "
                      "CASE WHEN l_orderkey % 10 <> 0 THEN l_discount END AS l_discount, "
                      "CASE WHEN l_orderkey % 7 <> 0 THEN l_tax END AS l_tax, "
                      "CASE WHEN l_orderkey % 11 <> 0 THEN l_returnflag END AS l_returnflag, l_linestatus FROM lineitem")


def people(t: Tables) -> DataFrame:
    """People with duplicates: every customer, plus a re-formatted copy (upper-cased name, ssn
    without hyphens) of every third one."""
    c = t.customer
    digits = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    ssn = F.concat_ws("-", F.substring(digits, 1, 3), F.substring(digits, 4, 2), F.substring(digits, 6, 4))
    base = c.select(F.col("c_custkey").alias("src_id"), F.col("c_name").alias("name"), ssn.alias("ssn"),
                    F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("salary"))
    dup = (base.filter(F.col("src_id") % 3 == 0)
           .select("src_id", F.upper("name").alias("name"), F.regexp_replace("ssn", "-", "").alias("ssn"),
                   "segment", "salary"))
    return base.unionByName(dup)


PEOPLE_SQL = """(WITH b AS (SELECT c_custkey AS src_id, c_name AS name,
       substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 1, 3) || '-' || substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 4, 2)
       || '-' || substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 6, 4) AS ssn,
       c_mktsegment AS segment, c_acctbal AS salary FROM customer)
SELECT * FROM b UNION ALL
SELECT src_id, upper(name) AS name, replace(ssn, '-', '') AS ssn, segment, salary FROM b WHERE src_id % 3 = 0)"""
