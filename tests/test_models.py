from __future__ import annotations

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marginalia.operators import aggregates, attributions, evaluate, models


@pytest.fixture(scope="module")
def churn(lines):
    return models.fit_churn(aggregates.customer_features(lines), rounds=4, depth=3)


def test_only_the_test_split_is_scored(churn):
    counts = {(r.is_test, r.s): r["count"] for r in churn.scored.groupBy(
        "is_test", F.col("churn_prob").isNotNull().alias("s")).count().collect()}
    assert set(counts) == {(0, False), (1, True)}


def test_scores_beat_chance_and_repeat(lines, churn):
    scored = churn.scored.where("is_test = 1").select("churned", "churn_prob", "customer_id")
    auc = evaluate.roc_auc(scored, "churned", "churn_prob").first().auc
    assert auc > 0.5
    again = models.fit_churn(aggregates.customer_features(lines), rounds=4, depth=3)
    repeat = again.scored.where("is_test = 1").select("churned", "churn_prob", "customer_id")
    assert sorted(scored.collect()) == sorted(repeat.collect())


def test_recency_can_be_left_out(lines):
    customers = aggregates.customer_features(lines)
    fitted = models.fit_churn(customers, rounds=2, depth=2, exclude_recency=True, score_all=True)
    assert "recency" not in fitted.features
    assert fitted.scored.where("churn_prob IS NULL").count() == 0


def test_a_loaded_model_scores_alike(spark, churn, tmp_path):
    path = str(tmp_path / "model")
    models.save_model(churn.model, path)
    rows = churn.scored.select("customer_id", *churn.features)
    probability = vector_to_array("probability")[1]
    before = churn.model.transform(rows).select("customer_id", probability).collect()
    after = models.load_model(path).transform(rows).select("customer_id", probability).collect()
    assert sorted(before) == sorted(after)


def test_attributions_add_up_to_the_margin(churn):
    explained = attributions.attributions(churn, "customer_id")
    margin = vector_to_array("rawPrediction")[1].alias("raw")
    raw = churn.model.transform(churn.scored.select("customer_id", *churn.features))
    for row in explained.join(raw.select("customer_id", margin), "customer_id").collect():
        parts = sum(row[f"phi_{name}"] for name in churn.features)
        assert row.base_value + parts == pytest.approx(row.margin, abs=1e-9)
        assert row.margin == pytest.approx(row.raw, abs=1e-9)


def test_attributions_are_the_shapley_values(churn):
    """Against the definition: the value of a coalition averages absent features by cover."""
    leaves = attributions.leaf_rules(churn)
    names = churn.features
    rows = attributions.attributions(churn, "customer_id").orderBy("customer_id").limit(3).collect()
    inputs = churn.scored.select("customer_id", *names).orderBy("customer_id").limit(3).collect()

    def value(x, present):
        worth = 0.0
        for leaf, rules in leaves:
            for feature, lo, hi, share in rules:
                leaf *= float(lo < x[feature] <= hi) if feature in present else share
            worth += leaf
        return worth

    width = len(names)
    for row, given in zip(rows, inputs):
        x = np.array([float(given[name]) for name in names])
        for j, name in enumerate(names):
            others = [i for i in range(width) if i != j]
            phi = 0.0
            for size in range(width):
                weight = factorial(size) * factorial(width - size - 1) / factorial(width)
                for chosen in combinations(others, size):
                    phi += weight * (value(x, {*chosen, j}) - value(x, set(chosen)))
            assert row[f"phi_{name}"] == pytest.approx(phi, abs=1e-9)


def test_importances_sum_to_one(churn):
    table = models.feature_importance(churn).collect()
    assert len(table) == len(churn.features)
    assert sum(r.importance for r in table) == pytest.approx(1.0)


def test_demand_with_a_yearly_rhythm_is_predicted(spark):
    """Held-out error on a series that has a signal; the given tables are drawn at random."""
    rows = [
        (f"item{item}", 2015 + month // 12, month % 12 + 1, 100 * item + 10 * abs(month % 12 - 6), 1.0, 0.1)
        for item in range(1, 7)
        for month in range(48)
    ]
    lines = spark.createDataFrame(
        rows, "sub_category string, order_year int, order_month int, quantity int, sales double, profit double"
    )
    row = evaluate.regression_metrics(models.fit_demand(lines, rounds=40).scored).first()
    assert row.n > 30 and row.r2 > 0.5


def test_returns_forest_in_cross_validation_has_no_depth():
    # The reference sets none.
    assert models.returns_estimator().depth is None


def test_monthly_fits_read_the_lines_once(lines):
    for fit in (models.fit_revenue, models.fit_residuals):
        fitted = fit(lines, rounds=1)
        assert not set(fitted.scored.inputFiles()) & set(lines.inputFiles())


def test_attributions_are_looked_up_per_leaf(spark, monkeypatch):
    """What a leaf gives to its features depends on which of them allow it: few ways, not rows."""
    rules = [[(0, -np.inf, 1.0, 0.5), (1, 2.0, np.inf, 0.25)], [(0, 1.0, 3.0, 0.3)], []]
    leaves = [(1.5, rules[0]), (-2.0, rules[1]), (0.5, rules[2])]
    rows = [(1, 1.0, 2.0), (2, 0.5, 2.5), (3, 3.0, 9.0), (4, 3.5, -1.0), (5, None, 5.0)]
    scored = spark.createDataFrame(rows, "id long, a double, b double")
    monkeypatch.setattr(attributions, "leaf_rules", lambda fitted: leaves)
    given = models.Fitted(None, ["a", "b"], scored)
    looked_up = attributions.attributions(given, "id").orderBy("id").collect()
    _, found = attributions.tabulated(leaves, 2)
    assert [table.shape for *_, table in found] == [(2, 4), (1, 2), (0, 1)]
    monkeypatch.setattr(attributions, "TABLED", 0)
    assert attributions.attributions(given, "id").orderBy("id").collect() == looked_up
    for row, (_, a, b) in zip(looked_up, rows, strict=True):
        low, high, mid = (a is not None and a <= 1), b > 2, (a is not None and 1 < a <= 3)
        # Two features: the mean of both orders of adding them.
        assert row.phi_b == pytest.approx(1.5 * (high - 0.25) * (low + 0.5) / 2)
        assert row.phi_a == pytest.approx(1.5 * (low - 0.5) * (high + 0.25) / 2 - 2.0 * (mid - 0.3))
