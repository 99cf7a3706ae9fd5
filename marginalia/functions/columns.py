"""Column expressions shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Band edges and labels of the two discount bandings.
CUT_EDGES = [-0.001, 0.001, 0.10, 0.20, 0.30, 1.0]
CUT_LABELS = ["0%", "1–10%", "11–20%", "21–30%", ">30%"]
CASE_EDGES = [0.0, 0.10, 0.20, 0.30]
CASE_LABELS = ["0%  No discount", "1–10%", "11–20%", "21–30%", "> 30%"]

# Sales channels and their shares in percent.
CHANNEL_SHARES = [("website", 45), ("mobile_app", 30), ("store", 25)]


def one_row(df: DataFrame) -> Column:
    """The single row of ``df`` as a struct: a scalar subquery, run once and shared by all tasks."""
    return df.select(F.struct(*df.columns)).scalar()


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clip(value: Column | str, lower=None, upper=None) -> Column:
    """Bound a value; NULL stays NULL (``greatest`` alone would return the bound)."""
    value = as_column(value)
    bounded = value
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, F.lit(upper))
    return F.when(value.isNotNull(), bounded)


def nan_to_null(name: str) -> Column:
    """NULL in place of NaN: Spark holds NaN to be greater than any number."""
    return F.when(~F.isnan(name), F.col(name)).alias(name)


def double(value: Column | str) -> Column:
    return as_column(value).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL when the denominator is zero."""
    return F.try_divide(double(numerator), double(denominator))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Double division with 0 in place of a zero denominator."""
    numerator, denominator = double(numerator), double(denominator)
    return F.when(denominator != 0, F.try_divide(numerator, denominator)).otherwise(F.lit(0.0))


def divide_or_zero(numerator: Column, denominator: Column) -> Column:
    """Measure-style division: any blank result becomes 0."""
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def mean(value: Column | str) -> Column:
    """Mean as sum over count, so that decimal sums stay exact until the division."""
    value = as_column(value)
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def total(value: Column | str) -> Column:
    """Exact decimal sum, handed out as a double."""
    return F.sum(as_column(value)).cast("double")


def money(value: Column | str, places: int = 2) -> Column:
    """Sum rounded half away from zero while still decimal, then a double."""
    return F.round(F.sum(as_column(value)), places).cast("double")


def cut(value: Column | str, edges: list[float], labels: list[str]) -> Column:
    """Right-closed bins ``(e[i], e[i+1]]``; values outside every bin are NULL."""
    value = as_column(value)
    bins = zip(edges[:-1], edges[1:], labels)
    inside = [((value > lo) & (value <= hi), label) for lo, hi, label in bins]
    return reduce(
        lambda chain, item: chain.when(item[0], item[1]),
        inside[1:],
        F.when(inside[0][0], inside[0][1]),
    )


def case_band(value: Column | str, edges: list[float], labels: list[str]) -> Column:
    """First band whose upper edge holds the value; everything else, NULL too, is the last."""
    value = as_column(value)
    chain = F.when(value == edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1]):
        chain = chain.when(value <= edge, label)
    return chain.otherwise(labels[-1])


def band(value: Column | str, edges: list[float], labels: list[str], style: str = "cut") -> Column:
    return cut(value, edges, labels) if style == "cut" else case_band(value, edges, labels)


def key_mix(first: Column | str, second: Column | str, a: int, b: int, modulus: int) -> Column:
    """A number in [0, modulus) from two keys. Text keys go through a hash first."""
    return F.pmod(as_column(first) * F.lit(a) + as_column(second) * F.lit(b), F.lit(modulus))


def numeric_key(df_types: dict[str, str], name: str) -> Column:
    """The key itself when it is integral, else a stable 31-bit hash of its text."""
    if df_types[name] in ("bigint", "int", "smallint", "tinyint"):
        return F.col(name).cast("bigint")
    return F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(2**31))


def assign_bucket(number: Column, shares: list[tuple[str, int]]) -> Column:
    """Weighted choice by a number in [0, 100): shares are consecutive ranges."""
    upper, chain = 0, None
    for name, share in shares[:-1]:
        upper += share
        chain = (F if chain is None else chain).when(number < upper, name)
    return chain.otherwise(shares[-1][0])


def month_index(year: Column | str, month: Column | str) -> Column:
    return (as_column(year) * 12 + as_column(month) - 1).cast("bigint")


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(as_column(year).cast("int"), as_column(month).cast("int"), F.lit(1))
