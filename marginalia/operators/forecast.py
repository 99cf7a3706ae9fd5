"""Monthly forecast: a trend that may bend times a yearly wave, by least squares.

Products of terms are summed on the executors, so a group is one row of sums whatever its length,
and a task solves a matrix as wide as the terms for each of its groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia import storage
from marginalia.functions.columns import one_row
from marginalia.operators.windows import join_same

# Bends lie evenly in the first part of a series, so that the last slope rests on enough months.
BENDS, BEND_SHARE, HARMONICS = 8, 0.8, 4
# Squared-size penalties, for a series of mean 1 over a time span of 1. They keep short series solvable.
PLAIN_PENALTY, BEND_PENALTY, SEASON_PENALTY = 1e-9, 0.01, 0.01


def _attach(rows: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """``found``, one row per group, next to the rows of its group."""
    if by:
        return join_same(rows, found, by)
    return rows.withColumn("_found", one_row(found)).select("*", "_found.*").drop("_found")


def trend_terms(time: Column, bends: int) -> list[Column]:
    points = [BEND_SHARE * (i + 1) / (bends + 1) for i in range(bends)]
    return [F.lit(1.0), time, *[F.greatest(time - point, F.lit(0.0)) for point in points]]


def season_terms(month: Column, harmonics: int) -> list[Column]:
    """Waves of a year; the sixth has one value a month and its sine is zero."""
    angles = [month * (2 * math.pi * k / 12) for k in range(1, harmonics + 1)]
    return [wave(angle) for k, angle in enumerate(angles, 1) for wave in ((F.sin, F.cos) if k < 6 else (F.cos,))]


def weighted(terms: list[Column], first: int) -> Column:
    return reduce(add, [term * F.col("_weights")[first + i] for i, term in enumerate(terms)])


def least_squares(rows: DataFrame, by: list[str], terms: list[Column], target: Column, penalties: list[float]) -> DataFrame:
    """``_weights`` of the terms per group, with the smallest sum of squared errors and penalties."""
    width = len(terms)
    named = rows.select(*by, target.alias("_y"), *[term.alias(f"_x{i}") for i, term in enumerate(terms)])
    products = [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")) for i in range(width) for j in range(i, width)]
    moments = [F.sum(F.col(f"_x{i}") * F.col("_y")) for i in range(width)]
    sums = named.groupBy(*by).agg(F.array(*products, *moments).alias("_sums"))
    upper = np.triu_indices(width)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            weights = []
            for values in batch["_sums"]:
                values = np.asarray(values, dtype=float)
                matrix = np.zeros((width, width))
                matrix[upper] = values[: len(upper[0])]
                matrix = np.triu(matrix) + np.triu(matrix, 1).T + np.diag(penalties)
                weights.append(np.linalg.lstsq(matrix, values[len(upper[0]) :], rcond=None)[0].tolist())
            yield batch.drop(columns="_sums").assign(_weights=weights)

    keys = [sums.schema[name] for name in by]
    schema = T.StructType([*keys, T.StructField("_weights", T.ArrayType(T.DoubleType()))])
    present = sums.where(F.get("_sums", F.lit(0)).isNotNull())
    return storage.stage(present.mapInPandas(solve, schema), "weights")


def trend_season_forecast(
    series: DataFrame, horizon: int = 12, by: list[str] | None = None, bends: int = BENDS, harmonics: int = HARMONICS
) -> DataFrame:
    """Bending trend times yearly season for the ``horizon`` months after a group's last one.

    ``series`` has month_no (year * 12 + month - 1) and revenue, one row per month and group. The first
    solution takes the season as added; its trend then scales the waves of the second, so that the
    season is a share of the trend. Months without revenue are ignored, gaps are allowed; a missing
    group is a group; a single month is repeated; an empty series has no forecast. The forecast is
    ``trend * season``, and may fall below zero with its trend.
    """
    by = by or []
    rows = series.where(F.col("revenue").isNotNull())
    rows = rows.select(*by, F.col("month_no").cast("bigint").alias("_month"), F.col("revenue").cast("double").alias("_revenue"))
    # Read for the spans and both solutions; short, as it has a row per month.
    rows = storage.stage(rows, "series")
    spans = rows.groupBy(*by).agg(
        F.min("_month").alias("_from"), F.max("_month").alias("_to"), F.avg(F.abs("_revenue")).alias("_scale")
    )
    spans = storage.stage(spans, "spans")
    month = F.col("_month")
    time = F.coalesce(F.try_divide(month - F.col("_from"), F.col("_to") - F.col("_from")), F.lit(0.0))
    trend, waves = trend_terms(time, bends), season_terms(month, harmonics)
    target = F.coalesce(F.try_divide(F.col("_revenue"), F.col("_scale")), F.lit(0.0))
    penalties = [PLAIN_PENALTY] * 2 + [BEND_PENALTY] * bends + [SEASON_PENALTY] * len(waves)
    rows = _attach(rows, spans, by)
    first = least_squares(rows, by, trend + waves, target, penalties)
    levels = _attach(rows, first, by)
    scaled = [wave * weighted(trend, 0) for wave in waves]
    second = least_squares(levels, by, trend + scaled, target, penalties)
    ahead = F.explode(F.sequence(F.col("_to") + 1, F.col("_to") + horizon))
    future = _attach(spans.where(F.col("_from").isNotNull()).withColumn("_month", ahead), second, by)
    level = weighted(trend, 0) * F.col("_scale")
    season = 1 + weighted(waves, len(trend))
    year = F.floor(month / 12).cast("int")
    period = F.make_date(year, (F.pmod(month, F.lit(12)) + 1).cast("int"), F.lit(1))
    return future.select(
        *by, period.alias("period"), level.alias("trend"), season.alias("season"), (level * season).alias("forecast")
    )
