"""Tail probabilities of test statistics. Called on result rows only, a handful
per test, never on input rows."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, total = 1e-300, 1.0
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 10_000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            total *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return total


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def upper_gamma(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    scale = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1.0:
        term = total = 1.0 / s
        k = s
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= x / k
            total += term
        return max(0.0, 1.0 - scale * total)
    b, c = x + 1.0 - s, 1e300
    d = 1.0 / b
    total = d
    for i in range(1, 10_000):
        step = -i * (i - s)
        b += 2.0
        d = 1.0 / (step * d + b)
        c = b + step / c
        total *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return scale * total


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f)."""
    return incomplete_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def t_tail(t: float, df: float) -> float:
    """P(|T| > |t|)."""
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def chi2_tail(x: float, df: float) -> float:
    """P(X > x)."""
    return upper_gamma(df / 2.0, x / 2.0)


def _column_function(tail, arity: int):
    def apply(*columns: pd.Series) -> pd.Series:
        rows = zip(*columns)
        return pd.Series(
            [None if any(pd.isna(v) for v in row) else tail(*row) for row in rows], dtype="float64"
        )

    if arity == 2:
        def two(a: pd.Series, b: pd.Series) -> pd.Series:
            return apply(a, b)
        return F.pandas_udf(two, DoubleType())

    def three(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return apply(a, b, c)
    return F.pandas_udf(three, DoubleType())


f_p_value = _column_function(f_tail, 3)
t_p_value = _column_function(t_tail, 2)
chi2_p_value = _column_function(chi2_tail, 2)
