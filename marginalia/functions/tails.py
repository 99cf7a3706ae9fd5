"""Tail probabilities of the F and t distributions for one-row test results."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def incomplete_beta():
    """The regularised incomplete beta function, as a closure that ships by value."""

    def beta(a: float, b: float, x: float) -> float:
        from math import exp, lgamma, log, log1p

        if x <= 0.0:
            return 0.0
        if x >= 1.0:
            return 1.0
        if x > (a + 1.0) / (a + b + 2.0):
            return 1.0 - beta(b, a, 1.0 - x)
        # Modified Lentz evaluation of the continued fraction.
        front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x)) / a
        tiny = 1e-300
        c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
        d = 1.0 / (d if abs(d) > tiny else tiny)
        value = d
        for m in range(1, 10_000):
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            for numerator in (even, odd):
                d = 1.0 + numerator * d
                d = 1.0 / (d if abs(d) > tiny else tiny)
                c = 1.0 + numerator / c
                c = c if abs(c) > tiny else tiny
                value *= d * c
            if abs(d * c - 1.0) < 1e-15:
                break
        return front * value

    return beta


def beta_probability(a: Column, b: Column, x: Column) -> Column:
    beta = incomplete_beta()

    def evaluate(a: pd.Series, b: pd.Series, x: pd.Series) -> pd.Series:
        triples = zip(a, b, x)
        return pd.Series([None if p != p or r != r else beta(p, q, r) for p, q, r in triples])

    return F.pandas_udf(evaluate, "double")(
        a.cast("double"), b.cast("double"), x.cast("double")
    )


def f_tail(statistic: Column, between_df: Column, within_df: Column) -> Column:
    """P(F > statistic)."""
    x = within_df / (within_df + between_df * statistic)
    return beta_probability(within_df / 2, between_df / 2, x)


def t_two_sided(statistic: Column, df: Column) -> Column:
    """P(|T| > |statistic|)."""
    return beta_probability(df / 2, F.lit(0.5), df / (df + statistic * statistic))
