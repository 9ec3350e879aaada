"""Tail probabilities and table formatting for small result tables."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return h


def beta_cdf(x: float, a: float, b: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float | None, df: float | None) -> float | None:
    """Two-sided p-value of a t statistic."""
    if t is None or df is None or df <= 0 or math.isnan(t):
        return None
    return beta_cdf(df / (df + t * t), df / 2.0, 0.5)


def f_upper(f: float | None, df1: float, df2: float) -> float | None:
    """Upper-tail p-value of an F statistic."""
    if f is None or df1 <= 0 or df2 <= 0 or math.isnan(f):
        return None
    return beta_cdf(df2 / (df2 + df1 * f), df2 / 2.0, df1 / 2.0)


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    """p-value column for a result table (a few rows per model)."""
    return pd.Series([None if pd.isna(a) or pd.isna(b) else t_two_sided(a, b) for a, b in zip(t, df)], dtype="float64")


# Significance thresholds of the published tables (fixed values).
STAR_LEVELS = ((0.01, "***"), (0.05, "**"), (0.10, "*"))


def stars(p: Column) -> Column:
    """Significance marks; unknown p gives none."""
    out = None
    for bound, mark in STAR_LEVELS:
        out = F.when(p < bound, mark) if out is None else out.when(p < bound, mark)
    return out.otherwise("")


def fixed(value: Column, digits: int = 3) -> Column:
    """Fixed decimals without thousands separators; missing prints blank."""
    text = F.format_number(value, digits)
    return F.coalesce(F.regexp_replace(text, ",", ""), F.lit(""))


def fixed_comma(value: Column, digits: int = 3) -> Column:
    """Fixed decimals with thousands separators; missing prints blank."""
    return F.coalesce(F.format_number(value, digits), F.lit(""))


def starred(value: Column, p: Column, digits: int = 3) -> Column:
    return F.concat(fixed(value, digits), stars(p))


def parenthesised(value: Column, digits: int = 3) -> Column:
    return F.concat(F.lit("("), fixed(value, digits), F.lit(")"))


def table_line(*cells: Column) -> Column:
    """One body row of a typeset table."""
    return F.concat(F.concat_ws(" & ", *cells), F.lit(r" \\"))
