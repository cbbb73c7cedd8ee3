"""Numeric column functions with the rounding, division and missing-value rules of the data model."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def round_half_even(c: Column, digits: int = 2) -> Column:
    """Scale, round half to even, unscale: 0.285 gives 0.28 and 1.005 gives 1.0."""
    scale = 10.0**digits
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def ratio(top: Column, bottom: Column) -> Column:
    """Division whose result is null for a zero or missing divisor."""
    return F.try_divide(top.cast("double"), F.nullif(bottom.cast("double"), F.lit(0.0)))


def clip(c: Column, low=None, high=None) -> Column:
    """Bounds on either side; null stays null."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low) if isinstance(low, int | float) else low)
    if high is not None:
        out = F.least(out, F.lit(high) if isinstance(high, int | float) else high)
    return F.when(c.isNotNull(), out)


def share(condition: Column) -> Column:
    """Aggregate: mean of a condition, unknown counting as false."""
    return F.avg(F.when(F.coalesce(condition, F.lit(False)), F.lit(1.0)).otherwise(F.lit(0.0)))


#: Digits of a sum after the point: the order of additions doesn't reach so far, so equal sums compare as equal.
SUM_DIGITS = 6


def number(c: Column | str) -> Column:
    """A column as a double, NaN being missing: else it would be above every number in comparisons and spoil every sum."""
    return nan_to_null((F.col(c) if isinstance(c, str) else c).cast("double"))


def missing(c: Column | str) -> Column:
    """Null or NaN."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | F.coalesce(F.isnan(c.cast("double")), F.lit(False))


def total(c: Column) -> Column:
    """Aggregate: sum of doubles, rounded once at the end; missing values and NaN are skipped, 0.0 where there is none."""
    return F.coalesce(F.round(F.sum(number(c)), SUM_DIGITS), F.lit(0.0))


def equal_total(c: Column) -> Column:
    """Aggregate: sum for comparison with other sums, as decimals of as many digits, which add up exactly in any order."""
    return F.sum(number(c).cast(f"decimal(38,{SUM_DIGITS})"))


def mean(c: Column) -> Column:
    """Aggregate: ``total`` over the count; null where there is none."""
    return ratio(total(c), F.count(number(c)))


def without_nan(df: DataFrame) -> DataFrame:
    """``df`` with NaN of all its floating columns as null."""
    return df.withColumns({f.name: nan_to_null(F.col(f.name)) for f in df.schema if isinstance(f.dataType, DoubleType | FloatType)})


def skewness_corrected(c: Column) -> Column:
    """Aggregate: bias-corrected skewness; null below three values."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


#: W. J. Cody's rational approximations of the error function: numerators with the leading coefficient last, denominators without theirs (1).
_NEAR = (3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3, 1.85777706184603153e-1), (2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3)
_MIDDLE = (
    (5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1, 2.98635138197400131e2, 8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3, 2.15311535474403846e-8),
    (1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3, 3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3),
)
_FAR = (3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4, 1.63153871373020978e-2), (2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3)


def _rational(coefficients, v: np.ndarray) -> np.ndarray:
    top, bottom = coefficients
    n, d = top[-1] * v, v
    for a, b in zip(top[:-2], bottom[:-1], strict=True):
        n, d = (n + a) * v, (d + b) * v
    return (n + top[-2]) / (d + bottom[-1])


def erfc(x: np.ndarray) -> np.ndarray:
    """Complementary error function of whole arrays, to 1e-13 of its value; numpy has none."""
    y = np.abs(x)
    out = np.full_like(y, np.nan)
    for here, f in (
        (y <= 0.46875, lambda v: 1 - v * _rational(_NEAR, v * v)), ((y > 0.46875) & (y <= 4), lambda v: np.exp(-v * v) * _rational(_MIDDLE, v)),
        (y > 4, lambda v: np.exp(-v * v) * (1 / math.sqrt(math.pi) - _rational(_FAR, 1 / (v * v)) / (v * v)) / v),
    ):
        out[here] = f(y[here])
    return np.where(x < 0, 2 - out, out)


def log_normal_cdf(w: np.ndarray) -> np.ndarray:
    """Logarithm of the standard normal distribution function, accurate far into the lower tail."""
    w = np.asarray(w, dtype=np.float64)
    out = np.empty_like(w)
    low = w < -30
    z = w[low]
    out[low] = -0.5 * z * z - np.log(-z * math.sqrt(2 * math.pi)) + np.log1p(-1 / (z * z))
    out[~low] = np.log(0.5 * erfc(-w[~low] / math.sqrt(2)))
    return out


@F.pandas_udf(DoubleType())
def log_normal_cdf_udf(w: pd.Series) -> pd.Series:
    """Spark has no error function; batches go through Arrow."""
    known = w.notna()
    out = pd.Series(np.nan, index=w.index)
    out[known] = log_normal_cdf(w[known].to_numpy())
    return out
