"""Exact distinct counts without a copy of each line per counted column."""

from __future__ import annotations

import pytest

from marginalia.operators import aggregates
from marginalia.plans.catalog import QUERIES
from tests.conftest import SMALL

COUNTED = [
    "summary_totals", "customer_features", "mart_customer", "exec_snapshot", "kpi_core", "kpi_core_year_region",
    "kpi_core_quarter_segment", "rec_marketing", "rec_channel",
]


@pytest.mark.parametrize("name", COUNTED)
def test_no_line_is_copied(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_facts_with_a_wide_dimension_and_missing_values(spark):
    """More values than one long has bits; missing keys and values count nowhere."""
    rows = []
    for line in range(2000):
        customer = line % 7
        kind = None if line % 11 == 0 else f"kind{line * customer % 150}"
        order = None if line % 13 == 0 else line // 3
        rows.append((customer, order, kind, float(line % 5), None if line % 4 == 0 else float(line)))
    lines = spark.createDataFrame(rows, "customer_id long, order_id long, kind string, sales double, discount double")
    lines = lines.selectExpr("*", "date_add(date'2020-01-01', cast(customer_id as int)) AS order_date")
    found = aggregates.customer_facts(lines, {"spent": "sales"}, {"off": "discount"}, {"kinds": "kind"})
    for row in found.collect():
        own = [r for r in rows if r[0] == row.customer_id]
        known = [r[4] for r in own if r[4] is not None]
        assert row.orders == len({r[1] for r in own if r[1] is not None})
        assert row.kinds == len({r[2] for r in own if r[2] is not None})
        assert row.spent == sum(r[3] for r in own) and row.off == pytest.approx(sum(known) / len(known))
    assert found.count() == 7


def test_counts_per_missing_group(spark):
    lines = spark.createDataFrame([(None, 1), (None, 2), (None, 2), ("a", 1), ("a", None)], "region string, order_id long")
    groups = lines.groupBy("region").count()
    found = aggregates.add_distinct(groups, lines, ["region"], {"orders": "order_id"})
    assert {(row.region, row["count"], row.orders) for row in found.collect()} == {(None, 3, 2), ("a", 2, 1)}
