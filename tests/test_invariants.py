"""Totals that must agree between reports over the same lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.operators import actions, aggregates, measures, models


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_monthly_kpis_add_up_to_the_channel_table(lines):
    kpi = {
        r.channel: (round(r.revenue, 2), round(r.profit, 2))
        for r in aggregates.mart_monthly_kpi(lines)
        .groupBy("channel")
        .agg(F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"))
        .collect()
    }
    channels = {r.channel: (round(r.revenue, 2), round(r.profit, 2)) for r in actions.rec_channel(lines).collect()}
    assert kpi == channels


def test_quantities_agree(lines):
    assert total(aggregates.mart_monthly_kpi(lines), "qty") == total(actions.rec_inventory(lines), "total_qty")
    assert total(lines, "quantity") == total(actions.rec_pricing(lines), "total_qty")


def test_customer_sums_are_the_totals(lines):
    customers = aggregates.customer_features(lines, monetary_col="profit")
    summary = aggregates.exec_snapshot(lines).first()
    assert round(total(customers, "monetary"), 2) == round(summary.total_profit, 2)
    assert total(customers, "frequency") == summary.total_orders
    assert customers.count() == summary.total_customers


def test_running_revenue_ends_at_the_total(lines):
    last = measures.running_revenue(lines).agg(F.max("running_revenue")).first()[0]
    assert round(last, 2) == round(float(total(lines, "sales")), 2)


def test_new_customers_cover_everyone_once(lines):
    first = total(measures.new_customers(lines), "first_time_customers")
    assert first == lines.select("customer_id").distinct().count()


def test_slicers_split_the_measures(lines):
    by_region = measures.operations(lines, ["region"], "year")
    assert total(by_region, "loss_lines") == lines.where("is_profitable = 0").count()


def test_clusters_are_named_by_falling_value(lines):
    base = aggregates.customer_features(lines, monetary_col="profit")
    clusters = models.rfm_clusters(base, restarts=3)
    means = {r.segment_label: r.monetary for r in models.cluster_means(clusters).collect()}
    ordered = [means[name] for name in models.CLUSTER_LABELS]
    assert ordered == sorted(ordered, reverse=True)
    assert clusters.count() == base.count()
