from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marginalia.operators import actions

NAN = float("nan")


def actions_of(df, *names):
    return [tuple(row[name] for name in names) for row in df.collect()]


def test_marketing_rules_in_order(spark):
    rows = [
        (1, "Champions", 0.9, 400), (2, "Loyal", 0.9, 400), (3, "At Risk", 0.71, 10),
        (4, "At Risk", 0.7, 400), (5, "Lost", 0.1, 121), (6, "Lost", 0.41, 120), (7, "Lost", None, 5),
    ]
    df = spark.createDataFrame(rows, "id int, segment_label string, churn_prob double, recency int")
    found = actions_of(actions.marketing_rules(df), "recommended_action", "priority")
    texts = actions.MARKETING
    assert found == [
        (texts["champions"], "HIGH"),
        (texts["loyal"], "HIGH"),
        (texts["win_back"], "HIGH"),
        (texts["at_risk"], "MEDIUM"),
        (texts["dormant"], "LOW"),
        (texts["standard"], "MEDIUM"),
        (texts["standard"], "LOW"),
    ]


def test_missing_or_nan_scores_pass_no_threshold(spark, lines):
    ids = [r.customer_id for r in lines.select("customer_id").distinct().orderBy("customer_id").limit(2).collect()]
    churn = spark.createDataFrame([(ids[0], NAN), (ids[1], 0.9)], "customer_id bigint, churn_prob double")
    segments = spark.createDataFrame([(i, "Lost") for i in ids], "customer_id bigint, segment_label string")
    found = {r.customer_id: r for r in actions.rec_marketing(lines, churn, segments).collect()}
    assert found[ids[0]].churn_prob is None and found[ids[0]].priority == "LOW"
    assert found[ids[1]].priority == "HIGH"
    assert len(found) == lines.select("customer_id").distinct().count()
    assert sum(r.segment_label is None for r in found.values()) == len(found) - 2


@pytest.mark.parametrize(
    "margin, discount, slope, action, urgency",
    [
        (-0.01, 0.5, -2.0, "stop", "CRITICAL"),
        (0.0, 0.26, None, "reduce", "HIGH"),
        (0.09, 0.26, None, "reduce", "NORMAL"),
        (0.21, 0.1, -1.6, "cut", "NORMAL"),
        (0.20, 0.1, -1.6, "hold", "NORMAL"),
        (0.16, 0.1, -0.4, "raise", "NORMAL"),
        (0.15, 0.1, -0.4, "hold", "NORMAL"),
        (0.30, 0.1, None, "hold", "NORMAL"),
        (0.04, 0.1, 0.0, "hold", "HIGH"),
        (0.30, 0.1, -1.5, "hold", "NORMAL"),
    ],
)
def test_pricing_rules(spark, margin, discount, slope, action, urgency):
    df = spark.createDataFrame(
        [(margin, discount, slope)], "avg_margin double, avg_discount double, elasticity double"
    )
    found = actions_of(actions.pricing_rules(df), "pricing_action", "urgency")
    assert found == [(actions.PRICING[action], urgency)]


@pytest.mark.parametrize(
    "margin, quantity, action",
    [(-0.1, 10, "liquidate"), (0.26, 10, "increase"), (0.25, 49, "low_volume"), (0.0, 50, "maintain")],
)
def test_inventory_rules(spark, margin, quantity, action):
    df = spark.createDataFrame([(margin, quantity)], "avg_margin double, total_qty int")
    assert actions_of(actions.inventory_rules(df), "inventory_action") == [(actions.INVENTORY[action],)]


@pytest.mark.parametrize(
    "profit, revenue, margin, discount, action",
    [
        (56.0, 50.0, 0.3, 0.3, "scale_up"),
        (55.0, 50.0, 0.04, 0.3, "review"),
        (40.0, 50.0, 0.05, 0.21, "reduce"),
        (40.0, 50.0, 0.05, 0.20, "maintain"),
    ],
)
def test_channel_rules(spark, profit, revenue, margin, discount, action):
    df = spark.createDataFrame(
        [(profit, revenue, margin, discount)],
        "`profit_share_%` double, `revenue_share_%` double, avg_margin double, avg_discount double",
    )
    assert actions_of(actions.channel_rules(df), "channel_action") == [(actions.CHANNEL[action],)]


def test_modelled_reorder_point_wins(spark):
    rule = spark.createDataFrame([("a", 5.0), ("b", 6.0), ("c", 7.0)], "sub_category string, reorder_point double")
    model = spark.createDataFrame([("a", 9.0), ("b", NAN)], "sub_category string, reorder_point double")
    found = {r.sub_category: r.reorder_point for r in actions.override_reorder(rule, model).collect()}
    assert found == {"a": 9.0, "b": 6.0, "c": 7.0}


def test_priorities_sort_by_letter(spark, lines):
    shown = [r.priority for r in actions.rec_marketing(lines).collect()]
    assert shown == sorted(shown)
    assert actions.rec_pricing(lines).where(F.col("elasticity").isNotNull()).count() == 0
