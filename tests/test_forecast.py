"""The bending forecast against a plain least-squares solution and against the straight one."""

from __future__ import annotations

import math

import numpy as np
import pytest

from marginalia.operators import features, forecast

SCHEMA = "g string, month_no bigint, order_month int, revenue double"


def bending(months, start=24000):
    """A trend that turns after half of the months, times a wave of a fifth."""
    turn = months // 2
    return [
        (start + i, (1000 + 40 * min(i, turn) - 25 * max(i - turn, 0)) * (1 + 0.2 * math.sin(2 * math.pi * i / 12)))
        for i in range(months)
    ]


def plain_forecast(points, horizon):
    months = np.array([m for m, _ in points], dtype=float)
    values = np.array([v for _, v in points])
    scale, first, span = np.abs(values).mean(), months.min(), np.ptp(months) or 1.0
    bends = forecast.BEND_SHARE * np.arange(1, forecast.BENDS + 1) / (forecast.BENDS + 1)

    def trend(m):
        t = (m - first) / span
        return np.column_stack([np.ones_like(t), t, *[np.maximum(t - b, 0) for b in bends]])

    def waves(m):
        angles = [2 * np.pi * k * m / 12 for k in range(1, forecast.HARMONICS + 1)]
        return np.column_stack([f(a) for a in angles for f in (np.sin, np.cos)])

    wide = 2 * forecast.HARMONICS
    penalty = [forecast.PLAIN_PENALTY] * 2 + [forecast.BEND_PENALTY] * len(bends) + [forecast.SEASON_PENALTY] * wide

    def fit(x):
        # Penalties as further rows of the system.
        return np.linalg.lstsq(np.vstack([x, np.diag(np.sqrt(penalty))]), np.append(values / scale, np.zeros(x.shape[1])), rcond=None)[0]

    known = trend(months).shape[1]
    level = trend(months) @ fit(np.hstack([trend(months), waves(months)]))[:known]
    weights = fit(np.hstack([trend(months), waves(months) * level[:, None]]))
    ahead = months.max() + 1 + np.arange(horizon)
    return scale * (trend(ahead) @ weights[:known]) * (1 + waves(ahead) @ weights[known:])


def test_forecast_against_plain_least_squares(spark):
    rng = np.random.default_rng(3)
    groups = {"bend": bending(60), None: [(24000 + 2 * i, float(v)) for i, v in enumerate(rng.random(30) * 50)]}
    rows = [(g, m, m % 12 + 1, v) for g, points in groups.items() for m, v in points]
    rows += [("bend", 24061, 2, None), ("void", 24000, 1, None), ("single", 24005, 6, 70.0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = forecast.trend_season_forecast(df, 6, ["g"]).orderBy("period").collect()
    for group, points in groups.items():
        values = [row.forecast for row in found if row.g == group]
        assert values == pytest.approx(list(plain_forecast(points, 6)), rel=1e-4)
    assert [str(row.period) for row in found if row.g == "bend"][0] == "2005-01-01"
    assert [row.trend * row.season for row in found] == pytest.approx([row.forecast for row in found])
    assert len([row for row in found if row.g == "single"]) == 6
    assert {row.g for row in found} == {"bend", "single", None}
    one = forecast.trend_season_forecast(df.where("g = 'bend'"), 6).orderBy("period").collect()
    assert [row.forecast for row in one] == pytest.approx([row.forecast for row in found if row.g == "bend"])
    assert forecast.trend_season_forecast(df.limit(0), 6).count() == 0


def test_a_bend_is_followed_better_than_by_a_line(spark):
    points = bending(84)
    rows = [("a", m, m % 12 + 1, v) for m, v in points[:72]]
    df = spark.createDataFrame(rows, SCHEMA)
    truth = np.array([v for _, v in points[72:]])

    def error(frame):
        values = np.array([row.forecast for row in frame.orderBy("period").collect()])
        return np.abs(values / truth - 1).mean()

    straight, bent = error(features.seasonal_forecast(df)), error(forecast.trend_season_forecast(df))
    assert bent < 0.1 and bent < straight / 3
