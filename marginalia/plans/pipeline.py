"""The whole pipeline: a raw order-line CSV in, every report, mart and action table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia import storage
from marginalia.operators import (
    actions,
    aggregates,
    attributions,
    clean,
    evaluate,
    features,
    forecast,
    measures,
    models,
    recommend,
    star,
    stats,
)
from marginalia.plans import warehouse
from marginalia.sources import files


def ingest(spark: SparkSession, path: str) -> DataFrame:
    """Clean lines from a raw CSV, staged once as the input of every later step."""
    return storage.stage(clean.clean(files.read_csv(spark, path)), "lines")


def warehouse_reports(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    reports = {name: warehouse.ask(spark, name, tables) for name in warehouse.QUESTIONS}
    reports["rfm_scores"] = warehouse.rfm_scores(tables["fact_sales"], tables["dim_customer"])
    return reports


def statistics(lines: DataFrame) -> dict[str, DataFrame]:
    return {
        "correlations": stats.corr_matrix(lines),
        "profit_drivers": stats.profit_drivers(lines),
        "anova_channel": stats.anova(lines, "profit_margin", "channel"),
        "anova_segment": stats.anova(lines, "profit_margin", "segment"),
        "margin_by_segment": stats.margin_by_segment(lines),
        "discount_test": stats.welch_discount(lines),
        "discount_bins": stats.discount_bins(lines),
        "margin_histogram": stats.margin_histogram(lines),
        "margin_normality": stats.margin_normality(lines),
        "box_channel": stats.box_summary(lines, "profit_margin", "channel"),
        "box_category": stats.box_summary(lines, "profit_margin", "category"),
        "monthly_trend": aggregates.monthly_series(lines),
    }


def measure_tables(
    lines: DataFrame, customers: DataFrame, by: list[str] | None = None, period: str = "month"
) -> dict[str, DataFrame]:
    """All measures by period and slicer. ``customers`` carries segments and churn scores."""
    return {
        "core": measures.core(lines, by, period),
        "growth": measures.growth(lines, by, period),
        "running_revenue": measures.running_revenue(lines, by, period),
        "active_customers": measures.active_customers(lines, by, period=period),
        "new_customers": measures.new_customers(lines, by, period),
        "retention": measures.retention(lines, by, period=period),
        "average_clv": measures.average_clv(lines, by, period),
        "champion_share": measures.segment_share(lines, customers, "Champions", by, period),
        "churn_risk": measures.churn_risk(customers),
        "segment_counts": measures.segment_counts(customers),
        "operations": measures.operations(lines, by, period),
        "category_share": measures.category_share(lines, by, period),
        "turnover": measures.turnover(lines, by, period),
        "flags": measures.flags(lines, by, period),
    }


def build(lines: DataFrame, rounds: int = 300, trees: int = 200) -> dict[str, DataFrame]:
    """Every table of the pipeline by name. Models are fitted here; the rest is lazy."""
    spark = lines.sparkSession
    tables = star.star_schema(lines, lambda name, make: storage.stage(make(), name))
    customers = storage.stage(aggregates.customer_features(lines), "customers")
    bought = storage.stage(aggregates.purchases(lines), "purchases")

    profit_value = customers.withColumn("monetary", F.col("total_profit"))
    segments = storage.stage(models.rfm_clusters(profit_value), "segments")
    churn = models.fit_churn(customers, rounds=rounds)
    tested = models.Fitted(churn.model, churn.features, churn.scored.where("is_test = 1"))
    returns = models.fit_returns(lines, trees=trees)
    demand = models.fit_demand(lines, rounds=rounds)
    revenue = models.fit_revenue(lines, rounds=rounds)
    residuals = models.fit_residuals(lines, rounds=rounds)

    slopes = features.elasticity(lines)
    reorder = features.reorder_points(lines)
    neighbours = storage.stage(recommend.similar_customers(bought), "neighbours")
    marketing = actions.rec_marketing(lines, churn.scored, segments)
    pricing = actions.rec_pricing(lines, slopes)
    inventory = actions.rec_inventory(lines, reorder)
    known = segments.select("customer_id", "segment_label").join(
        churn.scored.select("customer_id", "churn_prob"), "customer_id"
    )
    return_scores = returns.scored.select(
        *models.LINE_KEY, "returned", "return_prob", "prediction"
    )
    result = {
        "validation": clean.validate(lines, clean.CLEAN_RULES),
        "profile": clean.profile_nulls(lines),
        "summary": aggregates.summary_totals(lines),
        "summary_by_dim": aggregates.summary_by_dim(lines),
        **{f"star/{name}": df for name, df in tables.items()},
        **{f"warehouse/{name}": df for name, df in warehouse_reports(spark, tables).items()},
        **{f"statistics/{name}": df for name, df in statistics(lines).items()},
        **{f"measures/{name}": df for name, df in measure_tables(lines, known).items()},
        "models/segments": segments,
        "models/segment_means": models.cluster_means(segments),
        "models/churn_scores": churn.scored,
        "models/churn_importance": models.feature_importance(churn),
        "models/churn_attributions": attributions.attributions(tested, "customer_id"),
        "models/return_scores": return_scores,
        "models/return_importance": models.feature_importance(returns),
        "models/demand": demand.scored,
        "models/demand_importance": models.feature_importance(demand),
        "models/revenue_backtest": revenue.scored,
        "models/revenue_forecast": features.seasonal_forecast(aggregates.monthly_series(lines)),
        "models/revenue_forecast_bends": forecast.trend_season_forecast(aggregates.monthly_series(lines)),
        "models/elasticity": slopes,
        "models/elasticity_overall": features.elasticity_overall(lines),
        "models/reorder_points": reorder,
        "models/neighbours": neighbours,
        "models/recommendations": recommend.recommend(bought, neighbours),
        "models/copurchases": recommend.copurchase_corr(bought),
        "evaluation/residuals": evaluate.with_residuals(residuals.scored),
        "marts/fact": aggregates.mart_fact(lines),
        "marts/calendar": star.dim_calendar(lines),
        "marts/customer": aggregates.mart_customer(lines, segments, churn.scored),
        "marts/product": aggregates.mart_product(lines, slopes),
        "marts/monthly_kpi": aggregates.mart_monthly_kpi(lines),
        "actions/marketing": marketing,
        "actions/pricing": pricing,
        "actions/inventory": inventory,
        "actions/channel": actions.rec_channel(lines),
        "actions/alerts": actions.alerts(marketing, pricing, inventory),
        "actions/snapshot": aggregates.exec_snapshot(lines),
    }
    for name, scored, label, score in (
        ("churn", tested.scored, "churned", "churn_prob"),
        ("returns", return_scores, "returned", "return_prob"),
    ):
        result[f"evaluation/{name}_report"] = evaluate.classification_report(scored, label)
        result[f"evaluation/{name}_roc"] = evaluate.roc_curve(scored, label, score)
        result[f"evaluation/{name}_auc"] = evaluate.roc_auc(scored, label, score)
        result[f"evaluation/{name}_pr"] = evaluate.pr_curve(scored, label, score)
        result[f"evaluation/{name}_ap"] = evaluate.average_precision(scored, label, score)
    result["evaluation/churn_lift"] = evaluate.lift_table(tested.scored, "churned", "churn_prob")
    for name, fit in (("demand", demand), ("revenue", revenue), ("residuals", residuals)):
        result[f"evaluation/{name}_errors"] = evaluate.regression_metrics(fit.scored)
    return result


def run(spark: SparkSession, raw_path: str, output: str, rounds: int = 300, trees: int = 200) -> list[str]:
    """Ingest, compute and write everything below ``output``; returns the table names.

    Marts and action tables go out as CSV for the reporting tools, the rest as parquet.
    """
    tables = build(ingest(spark, raw_path), rounds, trees)
    for name, df in tables.items():
        if name.startswith(("marts/", "actions/")):
            files.write_csv(df, f"{output}/{name}")
        elif name == "star/fact_sales":
            fact = df.withColumn("order_year", F.year("order_date"))
            files.write_table(fact, f"{output}/{name}", ["order_year"])
        else:
            files.write_table(df, f"{output}/{name}")
    return list(tables)
