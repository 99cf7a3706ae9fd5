from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.functions import tails
from marginalia.operators import evaluate, features, measures, models, stats


def one(spark, column):
    return spark.range(1).select(column.alias("p")).first().p


@pytest.mark.parametrize("t", [0.0, 0.5, 2.0, 12.7])
def test_t_tail_has_the_closed_forms_of_low_degrees(spark, t):
    cauchy = 1 - 2 / math.pi * math.atan(t)
    assert one(spark, tails.t_two_sided(F.lit(t), F.lit(1.0))) == pytest.approx(cauchy, abs=1e-12)
    two = 1 - t / math.sqrt(2 + t * t)
    assert one(spark, tails.t_two_sided(F.lit(t), F.lit(2.0))) == pytest.approx(two, abs=1e-12)


@pytest.mark.parametrize("f, d2", [(0.3, 7.0), (3.2, 20.0), (5.0, 5000.0)])
def test_f_tail_has_the_closed_form_of_two_degrees(spark, f, d2):
    exact = (1 + 2 * f / d2) ** (-d2 / 2)
    assert one(spark, tails.f_tail(F.lit(f), F.lit(2.0), F.lit(d2))) == pytest.approx(exact, rel=1e-9)


def test_f_of_one_degree_is_t_squared(spark):
    f = one(spark, tails.f_tail(F.lit(2.5**2), F.lit(1.0), F.lit(13.0)))
    t = one(spark, tails.t_two_sided(F.lit(2.5), F.lit(13.0)))
    assert f == pytest.approx(t, rel=1e-10)
    # Tabled value: the two-sided 5 % point of t with 13 degrees of freedom is 2.160.
    assert one(spark, tails.t_two_sided(F.lit(2.1604), F.lit(13.0))) == pytest.approx(0.05, abs=1e-4)


def test_anova_by_hand(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 2.0), ("b", 4.0), ("b", 6.0)]
    row = stats.anova(spark.createDataFrame(rows, "g string, v double"), "v", "g").first()
    assert (row.ss_between, row.ss_within) == (pytest.approx(6.0), pytest.approx(10.0))
    assert row.f_statistic == pytest.approx(2.4) and not row.significant


def test_welch_by_hand(spark):
    rows = [(0, 1.0), (0, 2.0), (0, 3.0), (1, 2.0), (1, 4.0), (1, 6.0), (1, 8.0)]
    df = spark.createDataFrame(rows, "g int, v double")
    row = stats.welch(df, "v", F.col("g") == 0, F.col("g") == 1).first()
    a, b = 1 / 3, (20 / 3) / 4
    assert row.t_statistic == pytest.approx(-3 / math.sqrt(a + b))
    assert row.df == pytest.approx((a + b) ** 2 / (a * a / 2 + b * b / 3))
    assert (row.n_1, row.n_2) == (3, 4)


def test_histogram_is_numpy_histogram(spark):
    values = np.random.default_rng(3).normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    counts, edges = np.histogram(values, bins=20)
    rows = stats.histogram(df, "v", 20).collect()
    assert {r.bin: r["count"] for r in rows} == {i: c for i, c in enumerate(counts) if c}
    for row in rows:
        assert row.lower == pytest.approx(edges[row.bin])


def test_normality_rejects_a_skewed_sample_only(spark):
    rng = np.random.default_rng(5)
    for values, normal in ((rng.normal(size=2000), True), (rng.exponential(size=2000), False)):
        df = spark.createDataFrame([(float(v),) for v in values], "m double")
        moments = df.agg(
            F.count("m").alias("n"), F.skewness("m").alias("skewness"), F.kurtosis("m").alias("kurtosis")
        )
        row = stats.normality(moments).first()
        assert row.normal is normal and row.p_value == pytest.approx(math.exp(-row.k2 / 2))


def test_curves_on_tied_scores(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.4), (0, 0.4), (0, 0.1)]
    scored = spark.createDataFrame(rows, "label int, score double")
    # Pairs (positive, negative): 9, of which 7 are right and 2 tied.
    right = sum((p > n) + 0.5 * (p == n) for p in (0.9, 0.8, 0.4) for n in (0.8, 0.4, 0.1))
    assert evaluate.roc_auc(scored).first().auc == pytest.approx(right / 9)
    precision = 1 / 3 * 1.0 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 5
    assert evaluate.average_precision(scored).first().average_precision == pytest.approx(precision)
    # Four scores and the origin.
    assert evaluate.roc_curve(scored).count() == 5


def test_fold_metrics_agree_with_the_single_set_forms(spark):
    rng = np.random.default_rng(1)
    rows = [(int(f), int(y), round(float(s), 2)) for f, y, s in zip(
        rng.integers(0, 3, 400), rng.integers(0, 2, 400), rng.random(400))]
    scored = spark.createDataFrame(rows, "fold int, label int, score double")
    for row in models.fold_metrics(scored).collect():
        mine = scored.where(F.col("fold") == row.fold)
        assert row.auc == pytest.approx(evaluate.roc_auc(mine).first().auc)
        said = mine.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
        report = {r["class"]: r for r in evaluate.classification_report(said).collect()}
        assert row.f1 == pytest.approx(report["1"].f1)
        assert row.precision == pytest.approx(report["1"].precision)
        assert row.recall == pytest.approx(report["1"].recall)


def test_one_bin_lift_when_all_scores_are_equal(spark):
    scored = spark.createDataFrame([(i % 2, 0.3) for i in range(20)], "label int, score double")
    rows = evaluate.lift_table(scored).collect()
    assert [(r.decile, r.n, r.churned, r.lift) for r in rows] == [(0, 20, 10, 1.0)]


def test_regression_metrics_by_hand(spark):
    df = spark.createDataFrame([(2.0, 1.0), (4.0, 6.0), (0.5, 1.0)], "actual double, predicted double")
    row = evaluate.regression_metrics(df).first()
    assert row.mae == pytest.approx(3.5 / 3) and row.rmse == pytest.approx(math.sqrt(5.25 / 3))
    assert row.mape == pytest.approx((0.5 + 0.5 + 0.5) / 3 * 100)


def test_forecast_of_a_clean_seasonal_line(spark):
    rows = [(m, m % 12 + 1, 100.0 + 2 * m) for m in range(24000, 24036)]
    series = spark.createDataFrame(rows, "month_no bigint, order_month int, revenue double")
    forecast = features.seasonal_forecast(series, 3).orderBy("period").collect()
    assert [r.forecast for r in forecast] == pytest.approx([100.0 + 2 * m for m in range(24036, 24039)])
    assert str(forecast[0].period) == "2003-01-01"


def test_split_keeps_class_shares_exact(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    split = features.stratified_split(df, ["id"], "y")
    counts = {(r.y, r.is_test): r["count"] for r in split.groupBy("y", "is_test").count().collect()}
    assert counts == {(0, 0): 720, (0, 1): 180, (1, 0): 80, (1, 1): 20}
    again = features.stratified_split(df.repartition(5), ["id"], "y")
    assert split.orderBy("id").collect() == again.orderBy("id").collect()


def test_elasticity_needs_points_and_movement(spark):
    rows = [("ok", m, 10.0 * m, m) for m in range(1, 7)]
    rows += [("flat", m, 10.0, 1) for m in range(1, 7)] + [("few", m, 10.0 * m, 1) for m in (1, 2, 3)]
    df = spark.createDataFrame(rows, "sub_category string, order_month int, sales double, quantity int")
    # Unit price is constant at 10 in "ok" too unless quantity is fixed, so vary it.
    df = df.withColumn("sales", F.when(F.col("sub_category") == "ok", F.col("sales") * F.col("order_month")).otherwise(F.col("sales")))
    found = {r.sub_category: r.elasticity for r in features.elasticity(df).collect()}
    assert set(found) == {"ok"} and found["ok"] == pytest.approx(1.0)


def test_growth_is_blank_without_an_earlier_period(spark):
    rows = [(2020, 1, 100.0, -50.0), (2020, 2, 80.0, 0.0), (2020, 3, 90.0, 5.0), (2021, 1, 150.0, 1.0)]
    df = spark.createDataFrame(rows, "order_year int, order_month int, sales double, profit double")
    found = {(r.order_year, r.order_month): r for r in measures.growth(df).collect()}
    assert found[2020, 1].profit_growth_mom_pct is None
    assert found[2020, 2].profit_growth_mom_pct == pytest.approx(100.0)
    assert found[2020, 3].profit_growth_mom_pct is None
    assert found[2021, 1].revenue_growth_yoy_pct == pytest.approx(50.0)
    flags = {(r.order_year, r.order_month): r for r in measures.flags(df).collect()}
    assert flags[2020, 2].trend_arrow == "▲ 100.0%" and flags[2020, 1].trend_arrow == "▼ %"
    assert flags[2020, 1].margin_colour == "#FF3A5C" and flags[2020, 3].margin_colour == "#FFB703"


def test_activity_windows_are_inclusive(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, DATE'2020-01-02'), (2, DATE'2020-01-31'), (3, DATE'2020-03-31'),"
        " (3, DATE'2020-03-31') AS t(customer_id, order_date)"
    )
    # 2 January is day 90 of the days up to 31 March; 1 January would be too old.
    active = {(r.order_year, r.order_month): r.active_customers for r in measures.active_customers(df).collect()}
    assert active == {(2020, 1): 2, (2020, 2): 2, (2020, 3): 3}
    kept = {(r.order_year, r.order_month): (r.active_now, r.active_previous) for r in measures.retention(df, days=60).collect()}
    assert kept[2020, 3] == (1, 2)
