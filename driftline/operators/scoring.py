"""Batch scoring with Arrow-vectorised Python: scalar / iterator pandas UDFs, mapInPandas,
SQL-registered model functions and per-key model bundles.

A "model" here is a small object (coefficients keyed by name). It ships once per Python
worker (captured by the UDF closure / broadcast), never per row, and every UDF works on Arrow
batches (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows at a time).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


@dataclass
class LinearModel:
    features: list[str]
    coef: list[float]
    intercept: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        return x @ np.asarray(self.coef, dtype="float64") + self.intercept


@dataclass
class ModelBundle:
    """Per-key models routed by key (one small model per device, say)."""
    key: str
    features: list[str]
    models: dict = field(default_factory=dict)  # key -> (intercept, [coef...])


def model_from_row(row, features: list[str]) -> LinearModel:
    return LinearModel(features, [float(row[f"coef_{f}"]) for f in features], float(row["intercept"]))


def bundle_from_frame(coefs: DataFrame, key: str, features: list[str], keys: list) -> ModelBundle:
    """Models of the ``keys`` the caller names, as a bundle that is broadcast to the scoring tasks
    (one short row per named key). To score every key of a table use ``models.linear_score``,
    which joins the coefficient table and lets Spark pick the join by its measured size."""
    sel = coefs.filter(F.col(key).isin(keys)).select(key, "intercept", *[f"coef_{f}" for f in features])
    return ModelBundle(key, features, {r[key]: (float(r["intercept"]), [float(r[f"coef_{f}"]) for f in features])
                                       for r in sel.collect()})


def scalar_udf(model: LinearModel):
    """``*Series -> Series`` pandas UDF bound to the model (columns passed by name order)."""
    @F.pandas_udf(DoubleType())
    def predict(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype="float64") for c in cols])
        return pd.Series(model.predict(x))
    return predict


def iterator_udf(spark: SparkSession, model: LinearModel):
    """Iterator pandas UDF: the model is read from a broadcast once per task, then applied to
    each Arrow batch."""
    bc = spark.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        m = bc.value  # loaded once for the whole partition
        for cols in batches:
            cols = (cols,) if isinstance(cols, pd.Series) else cols
            x = np.column_stack([c.to_numpy(dtype="float64") for c in cols])
            yield pd.Series(m.predict(x))
    return predict


def map_in_pandas_score(df: DataFrame, model: LinearModel, out: str = "prediction") -> DataFrame:
    """mapInPandas with the output schema = input schema + prediction column."""
    schema = StructType(df.schema.fields + [StructField(out, DoubleType())])
    feats = list(model.features)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            x = pdf[feats].to_numpy(dtype="float64")
            yield pdf.assign(**{out: model.predict(x)})
    return df.mapInPandas(run, schema)


def register_sql_model(spark: SparkSession, name: str, model: LinearModel) -> None:
    """Make the model callable from SQL: ``SELECT name(col1, col2) FROM t``."""
    spark.udf.register(name, scalar_udf(model))


def bundle_udf(spark: SparkSession, bundle: ModelBundle):
    """Pandas UDF (key, features...) -> prediction that routes each row to its key's model.
    Rows stay where they are (no grouping by key), so a hot key cannot pile up in one task."""
    bc = spark.sparkContext.broadcast(bundle)

    @F.pandas_udf(DoubleType())
    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        b = bc.value
        icpt = pd.Series({k: v[0] for k, v in b.models.items()})
        coefs = pd.DataFrame({k: v[1] for k, v in b.models.items()}, index=b.features).T
        for key, *cols in batches:
            x = np.column_stack([c.to_numpy(dtype="float64") for c in cols])
            w = coefs.reindex(key.to_numpy()).to_numpy()
            c0 = icpt.reindex(key.to_numpy()).to_numpy()
            yield pd.Series((x * w).sum(axis=1) + c0)
    return predict


def apply_bundle(df: DataFrame, spark: SparkSession, bundle: ModelBundle, out: str = "prediction") -> DataFrame:
    udf = bundle_udf(spark, bundle)
    return df.withColumn(out, udf(F.col(bundle.key), *[F.col(f) for f in bundle.features]))
