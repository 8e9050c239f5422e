"""Closed forms of distribution statistics on moment columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_skewness(g1: Column, n: Column) -> Column:
    return g1 * F.sqrt(n * (n - 1)) / (n - 2)


def sample_kurtosis(g2: Column, n: Column) -> Column:
    return (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)


def k_squared(g1: Column, g2: Column, n: Column) -> Column:
    """D'Agostino-Pearson statistic from population skewness and excess kurtosis."""
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta - 1)) - 1
    z_skew = F.asinh(y / F.sqrt(2 / (w2 - 1))) / F.sqrt(F.log(F.sqrt(w2)))

    expected = 3.0 * (n - 1) / (n + 1)
    variance = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (g2 + 3 - expected) / F.sqrt(variance)
    root = F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    s = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * root
    a = 6 + 8 / s * (2 / s + F.sqrt(1 + 4 / (s * s)))
    d = 1 + x * F.sqrt(2 / (a - 4))
    cube = F.cbrt((1 - 2 / a) / F.abs(d))
    z_kurt = (1 - 2 / (9 * a) - F.signum(d) * cube) / F.sqrt(2 / (9 * a))
    return z_skew * z_skew + z_kurt * z_kurt


def chi2_two_p(statistic: Column) -> Column:
    """Upper tail of the chi-squared distribution with two degrees of freedom."""
    return F.exp(-statistic / 2)


# Coefficients of the rational approximation of the inverse normal.
_A = (-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.357751867269, -30.66479806614716, 2.506628277459239)
_B = (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572)
_C = (-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783)
_D = (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416)


def _poly(coefficients, x: Column) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + c
    return value


def inverse_normal(p: Column) -> Column:
    """Standard normal quantile, relative error below 1.2e-9."""
    q = p - 0.5
    r = q * q
    middle = _poly(_A, r) * q / _poly(_B + (1.0,), r)
    low = F.sqrt(-2 * F.log(F.least(p, 1 - p)))
    tail = _poly(_C, low) / _poly(_D + (1.0,), low)
    return F.when((p >= 0.02425) & (p <= 0.97575), middle).when(p < 0.02425, tail).otherwise(-tail)
