"""Lazy access to the parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


class Tables:
    """``Tables(spark, dir).lineitem`` -> DataFrame over ``dir/lineitem.parquet``.

    Reads are lazy, so column pruning and filter pushdown reach the scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)


def head_pandas(df: DataFrame, n: int = 20):
    """Bounded pull to the driver: ``limit`` first, then convert (never ``toPandas`` on a whole table)."""
    return df.limit(n).toPandas()


def from_pandas(spark: SparkSession, pdf, schema=None) -> DataFrame:
    """Local rows / pandas -> DataFrame (Arrow path). For small reference inputs only."""
    return spark.createDataFrame(pdf, schema=schema)
