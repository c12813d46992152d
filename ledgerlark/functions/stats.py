"""Distribution tails for test statistics (H3, H9).

Spark has no ``erfc`` or Student-t CDF, so these are small vectorised UDFs.
They run on already-aggregated rows (one per test), never on raw data.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's code with the UDFs (pickled by value), so Python workers
# need neither the package installed nor the driver's sys.path.
import sys as _sys  # noqa: E402

from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])


def t_two_sided_p(t: float | None, dof: int | None) -> float | None:
    """Two-sided p-value of Student's t with a whole number of degrees of
    freedom: one minus the finite trigonometric series of A(t | dof)."""
    if t is None or dof is None or dof < 1 or (isinstance(t, float) and math.isnan(t)):
        return None
    if math.isinf(t):
        return 0.0
    dof = int(dof)
    angle = math.atan(abs(t) / math.sqrt(dof))
    cos2 = math.cos(angle) ** 2
    # odd: cos + 2/3 cos^3 + (2 4)/(3 5) cos^5 ..; even: 1 + 1/2 cos^2 + (1 3)/(2 4) cos^4 ..
    odd = dof % 2
    term = math.cos(angle) if odd else 1.0
    parts = [term] if dof > 1 else []
    for k in range(2 + odd, dof - 1, 2):
        term *= cos2 * (k - 1) / k
        parts.append(term)
    series = math.sin(angle) * math.fsum(parts)
    return max(0.0, 1.0 - (2 / math.pi * (angle + series) if odd else series))


def spearman_p(rho: float | None, n: int | None) -> float | None:
    """p-value of a rank correlation via t = rho*sqrt((n-2)/(1-rho^2))."""
    if rho is None or n is None or n < 3 or (isinstance(rho, float) and math.isnan(rho)):
        return None
    if abs(rho) >= 1.0:
        return 0.0
    t = rho * math.sqrt((n - 2) / (1.0 - rho * rho))
    return t_two_sided_p(t, n - 2)


def _none_if_nan(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else v


@F.pandas_udf(T.DoubleType())
def _erfc_udf(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if pd.isna(v) else math.erfc(v)).astype("float64")


@F.pandas_udf(T.DoubleType())
def _spearman_p_udf(rho: pd.Series, n: pd.Series) -> pd.Series:
    out = [spearman_p(_none_if_nan(r), None if pd.isna(k) else int(k)) for r, k in zip(rho, n)]
    return pd.Series(out, dtype="float64")


def pearson(x: str, y: str) -> Column:
    """Correlation of two columns over the rows that have both; NULL where a
    side is constant (``corr`` divides by zero there)."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    sd = [F.stddev_pop(F.when(both, F.col(c))) for c in (x, y)]
    return F.try_divide(F.covar_pop(x, y), sd[0] * sd[1])


def erfc(c: Column) -> Column:
    return _erfc_udf(c)


def two_sided_normal_p(z: Column) -> Column:
    """H3: p = erfc(|z| / sqrt 2)."""
    return _erfc_udf(F.abs(z) / F.lit(math.sqrt(2.0)))


def rank_corr_p(rho: Column, n: Column) -> Column:
    return _spearman_p_udf(rho, n)
