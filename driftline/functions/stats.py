"""Closed-form statistics shared by the Spark operators and the SQL oracles.

The p-value expressions are plain SQL text so the very same formula runs in Spark and in the
DuckDB oracle. The chi-squared tail needs the regularised incomplete gamma function, which
Spark SQL lacks; it runs as a vectorised pandas UDF over one row per test (not per data row).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.column import Column
from pyspark.sql.types import DoubleType


def ks_pvalue_sql(z: str) -> str:
    """Asymptotic two-sided Kolmogorov tail P(K > z) as SQL over the expression ``z``.

    Uses the theta-function form for small z (fast convergence) and the alternating series
    2*sum((-1)^(k-1) exp(-2 k^2 z^2)) for z >= 1.18; clamped to [0, 1].
    """
    small = " + ".join(f"exp(-{(2 * k - 1) ** 2} * pi() * pi() / (8 * ({z}) * ({z})))" for k in range(1, 7))
    large = " ".join(f"{'+' if k % 2 else '-'} exp(-{2 * k * k} * ({z}) * ({z}))" for k in range(1, 7))
    return (f"CASE WHEN ({z}) IS NULL THEN NULL WHEN ({z}) <= 0 THEN 1.0 "
            f"WHEN ({z}) < 1.18 THEN greatest(0.0, least(1.0, 1.0 - sqrt(2 * pi()) / ({z}) * ({small}))) "
            f"ELSE greatest(0.0, least(1.0, 2 * ({large}))) END")


def _gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x) (series / continued fraction)."""
    if x is None or a is None or (isinstance(x, float) and math.isnan(x)):
        return float("nan")
    if x <= 0:
        return 1.0
    if a > 1e5:  # Wilson-Hilferty: the cube root of a gamma variable is nearly normal
        z = ((x / a) ** (1 / 3) - (1 - 1 / (9 * a))) * 3 * math.sqrt(a)
        return 0.5 * math.erfc(z / math.sqrt(2))
    gln = math.lgamma(a)
    if x < a + 1:
        ap, s, d = a, 1.0 / a, 1.0 / a
        for _ in range(10000):
            ap += 1
            d *= x / ap
            s += d
            if abs(d) < abs(s) * 1e-16:
                break
        else:
            raise ArithmeticError(f"incomplete gamma series did not converge for a={a}, x={x}")
        return max(0.0, 1.0 - s * math.exp(-x + a * math.log(x) - gln))
    tiny = 1e-300
    b = x + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    else:
        raise ArithmeticError(f"incomplete gamma fraction did not converge for a={a}, x={x}")
    return min(1.0, math.exp(-x + a * math.log(x) - gln) * h)


def chi2_sf_values(stat: np.ndarray, dof: np.ndarray) -> np.ndarray:
    out = np.empty(len(stat), dtype="float64")
    for i, (x, k) in enumerate(zip(stat, dof)):
        if pd.isna(x) or pd.isna(k):
            out[i] = np.nan
        elif k <= 0:
            out[i] = 1.0
        else:
            out[i] = _gamma_q(float(k) / 2.0, float(x) / 2.0)
    return out


@F.pandas_udf(DoubleType())
def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of the chi-squared distribution (applied to one row per test)."""
    return pd.Series(chi2_sf_values(stat.to_numpy(dtype="float64", na_value=np.nan),
                                    dof.to_numpy(dtype="float64", na_value=np.nan)))


def chi2_sf_sql_duckdb(x: str, k: str, terms: int = 2000) -> str:
    """DuckDB oracle form of the chi-squared tail: 1 - P(k/2, x/2) by the power series."""
    a, y = f"(({k}) / 2.0)", f"(({x}) / 2.0)"
    series = (f"list_sum(list_transform(range(0, {terms}), lambda n: "
              f"exp((({a}) + n) * ln({y}) - ({y}) - lgamma(({a}) + n + 1))))")
    return (f"CASE WHEN ({k}) <= 0 THEN 1.0 WHEN ({x}) <= 0 THEN 1.0 "
            f"WHEN {y} > {a} + 100 + 15 * sqrt({a}) THEN 0.0 "
            f"ELSE greatest(0.0, 1.0 - {series}) END")


def xlogy_ratio(p: Column, m: Column) -> Column:
    """p * log2(p / m) with the 0 * log 0 = 0 convention."""
    return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))
