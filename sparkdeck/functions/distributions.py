"""Student-t tail probabilities without scipy.

Regularised incomplete beta by its continued fraction;
used by the pairwise t-test on its k(k-1)/2 result rows only.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def _fraction(a: float, b: float, x: float) -> float:
    """1 / (1 + c1 / (1 + c2 / (1 + ...))), the continued fraction of the incomplete beta
    function, evaluated from its tail; x below the mean needs about sqrt(max(a, b)) terms."""
    value = 1.0
    for k in range(200 + 4 * math.isqrt(int(max(a, b)) + 1), 0, -1):
        m, odd = divmod(k, 2)
        c = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)) if odd else m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        value = 1.0 + c / value
    return 1.0 / value


def betainc_reg(a: float, b: float, x: float) -> float:
    """I_x(a, b), the regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    bt = math.exp(lbt)
    if x < (a + 1.0) / (a + b + 2.0):
        return bt * _fraction(a, b, x) / a
    return 1.0 - bt * _fraction(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom."""
    if t is None or df is None or (isinstance(t, float) and math.isnan(t)) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc_reg(df / 2.0, 0.5, df / (df + t * t))


@pandas_udf(DoubleType())
def t_pvalue_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(float(a), float(b)) if pd.notna(a) and pd.notna(b) else np.nan
                      for a, b in zip(t, df)])
