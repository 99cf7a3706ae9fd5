"""Every registered query: operators bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
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
    windows,
)
from marginalia.plans import warehouse
from marginalia.sources import files
from marginalia.sources.retail import first_lines, once, order_lines, retail_lines

Query = Callable[[SparkSession, str], DataFrame]


# Columns that are one correctly rounded operation on exact sums and counts. They are equal in
# every engine as they stand, while rounding them could meet an exact tie.
EXACT = {
    "sales", "profit", "cost", "revenue", "discount", "profit_margin", "profit_per_unit",
    "total_revenue", "total_profit", "monetary", "avg_discount", "monthly_avg_qty",
    "avg_monthly_demand", "mean_month_qty", "avg_ship_days", "loss_pct", "discount_pct",
    "discount_given", "margin_pct", "avg_order_value", "revenue_per_customer", "turnover",
    "retention_pct", "profit_share_pct", "segment_share_pct", "avg_clv", "profit_per_order",
    "revenue_share_%", "profit_share_%", "running_revenue", "threshold", "score", "fpr", "tpr",
    "precision", "recall", "f1", "churn_rate", "lift",
}


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Inexact doubles rounded, decimals as doubles, integers as bigint: one form to compare."""
    columns = []
    for name, kind in df.dtypes:
        value = F.col(f"`{name}`")
        if kind in ("double", "float") or kind.startswith("decimal"):
            value = value.cast("double")
            if name not in EXACT:
                value = F.round(value, places)
        elif kind in ("int", "smallint", "tinyint"):
            value = value.cast("bigint")
        columns.append(value.alias(name))
    return df.select(*columns)


# ---------------------------------------------------------------- shared inputs


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lines = retail_lines(spark, sf_dir)
    return star.star_schema(lines, lambda name, build: once(spark, sf_dir, name, build))


def customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features, staged once: the input of every customer model and score."""
    lines = retail_lines(spark, sf_dir)
    return once(spark, sf_dir, "customers", lambda: aggregates.customer_features(lines))


def purchase_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per customer and sub-category, staged once for all recommender queries."""
    lines = retail_lines(spark, sf_dir)
    return once(spark, sf_dir, "purchases", lambda: aggregates.purchases(lines))


def scored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reproducible score per customer: mostly a keyed draw, partly the label."""
    draw = F.pmod(F.col("customer_id") * 7919, F.lit(1000))
    score = (7 * draw + 3000 * F.col("churned")).cast("double") / 10000.0
    customers = customer_table(spark, sf_dir)
    return customers.select("customer_id", F.col("churned").alias("label"), score.alias("score"))


def labelled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with rule-based segment and churn probability."""
    lines = retail_lines(spark, sf_dir)

    def build() -> DataFrame:
        return aggregates.rule_segments(aggregates.rule_churn(actions.customer_base(lines)))

    return once(spark, sf_dir, "labelled", build)


def monthly_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per month predicted by the month before."""
    lags = features.residual_lags(retail_lines(spark, sf_dir))
    return lags.select("period", F.col("revenue").alias("actual"), F.col("lag1").alias("predicted"))


# ---------------------------------------------------------------- query builders


def on_lines(build: Callable[[DataFrame], DataFrame], places: int = 6) -> Query:
    return lambda spark, sf_dir: tidy(build(retail_lines(spark, sf_dir)), places)


def on_star(name: str) -> Query:
    return lambda spark, sf_dir: tidy(star_tables(spark, sf_dir)[name])


def on_question(name: str) -> Query:
    return lambda spark, sf_dir: tidy(warehouse.ask(spark, name, star_tables(spark, sf_dir)))


def on_scored(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: tidy(build(scored_customers(spark, sf_dir)))


def raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines written in the raw file's shape and read back as text.

    Some parts are written in Latin-1 with a name that UTF-8 would not read. Text is several times as
    long as the lines, so it is compressed.
    """
    path = storage.new_path(spark, "raw-csv")
    lines = retail_lines(spark, sf_dir)
    old = F.col("order_id") % 9 == 0
    files.export_raw_csv(lines.where(~old), f"{path}/utf8", compression="gzip")
    accented = lines.where(old).withColumn("customer_name", F.concat("customer_name", F.lit("é")))
    files.export_raw_csv(accented, f"{path}/latin1", encoding="ISO-8859-1", compression="gzip")
    return files.read_csv(spark, f"{path}/*")


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_csv(spark, sf_dir)
    keys = {f"{name} ID": F.col(f"{name} ID").cast("bigint") for name in ("Order", "Customer", "Product")}
    return tidy(clean.clean(raw.withColumns(keys)))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart written as CSV and read back with its schema, dates parsed."""
    mart = aggregates.mart_fact(retail_lines(spark, sf_dir))
    path = storage.new_path(spark, "mart-csv")
    files.write_csv(mart, path)
    return tidy(files.read_typed_csv(spark, path, mart.schema))


def dirty_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-item numbers as text, some of them unreadable, through the numeric coercion."""
    key = F.col("l_orderkey") + F.col("l_partkey")
    text = first_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(key % 7 == 0, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.when(key % 11 == 0, "").otherwise(
            F.concat(F.lit(" "), F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
        ).alias("sales"),
        F.when(key % 13 == 0, F.lit(None)).otherwise(F.col("l_discount").cast("decimal(4,2)").cast("string")).alias("discount"),
    )
    return tidy(clean.coerce_numeric(text, {"quantity": 1, "sales": 0, "discount": 0}))


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw text rows with holes, fractions, huge values and dates with times."""
    key = F.col("l_orderkey") + F.col("l_partkey")

    def odd(divisor: int, cases: dict[int, str], rest: Column) -> Column:
        chain = F.when(F.lit(False), rest)
        for remainder, text in cases.items():
            chain = chain.when(key % divisor == remainder, F.lit(text))
        return chain.otherwise(rest)

    day = F.col("l_shipdate").cast("date")
    order = F.col("l_orderkey").cast("string")
    dates = (
        F.when(key % 5 == 0, F.concat(day.cast("string"), F.lit(" 00:00:00")))
        .when(key % 5 == 1, F.date_format(day, "M/d/yyyy"))
        .when(key % 5 == 2, "not a date")
        .when(key % 5 == 3, F.concat(day.cast("string"), F.lit("T10:20:30")))
        .otherwise(day.cast("string"))
    )
    return first_lines(spark, sf_dir).select(
        odd(17, {0: "NULL"}, F.concat_ws("-", "l_orderkey", "l_partkey")).alias("Row ID"),
        order.alias("Order ID"),
        F.col("l_partkey").cast("string").alias("Product ID"),
        dates.alias("Order Date"),
        odd(7, {0: "n/a", 1: "0.5", 2: "3000000000", 3: "-4"}, F.col("l_quantity").cast("int").cast("string")).alias("Quantity"),
        odd(11, {0: "0.3001", 1: "0.305", 2: "1.7", 3: ""}, F.col("l_discount").cast("decimal(4,2)").cast("string")).alias("Discount"),
        odd(13, {0: "1e15", 1: "NULL"}, F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("Sales"),
        odd(19, {0: "0.00004", 1: "-5"}, F.lit("10")).alias("Profit"),
        F.concat(F.lit("C"), key % 3).alias("Country"),
    )


DIRTY_COLUMNS = [
    "row_id", "order_id", "product_id", "order_date", "quantity", "discount", "sales", "profit",
    "is_profitable", "country",
]


def clean_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(clean.clean(dirty_lines(spark, sf_dir)).select(*DIRTY_COLUMNS))


def profile_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiled = clean.profile_nulls(clean.clean(dirty_lines(spark, sf_dir)).select(*DIRTY_COLUMNS))
    return tidy(profiled.select("column_name", "row_count", "null_count"))


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(
        first_lines(spark, sf_dir).select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice"
        )
    )


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four data rules plus key checks of the star schema."""
    tables = star_tables(spark, sf_dir)
    fact = tables["fact_sales"]
    checks = [
        clean.validate(retail_lines(spark, sf_dir), clean.CLEAN_RULES),
        clean.check_unique(fact, ["order_id", "product_id"], "fact_line_unique"),
        clean.check_unique(fact, ["row_id"], "row_id_unique"),
        clean.check_unique(tables["dim_customer"], ["customer_id"], "customer_id_unique"),
        clean.check_unique(tables["dim_product"], ["product_id"], "product_id_unique"),
        clean.check_reference(fact, tables["dim_customer"], "customer_id", "fact_customer_known"),
        clean.check_reference(fact, tables["dim_product"], "product_id", "fact_product_known"),
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return tidy(result)


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiled = clean.profile_nulls(retail_lines(spark, sf_dir))
    return tidy(profiled.select("column_name", "row_count", "null_count"))


def encoded(lines: DataFrame) -> DataFrame:
    """Codes of the four encoded categories with the number of lines they cover."""
    names = ["category", "sub_category", "channel", "segment"]
    coded = clean.encode_ordinal(lines, names)
    keys = [*names, *[f"{name}_enc" for name in names]]
    return coded.groupBy(*keys).agg(F.count("*").alias("lines"))


def star_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse written as tables, the fact split by order year, and counted again."""
    path = storage.new_path(spark, "star")
    # The fact is as long as the lines and has one reader here, so it is written once, at its end.
    tables = star.star_schema(
        retail_lines(spark, sf_dir),
        lambda name, build: build() if name == "fact_sales" else once(spark, sf_dir, name, build),
    )
    star.write_star(tables, path)
    years = spark.read.parquet(f"{path}/fact_sales").groupBy("order_year")
    return tidy(years.agg(F.count("*").alias("rows"), F.sum("sales").alias("sales")))


def null_safe_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per place key where some places have no postal code or city."""
    lines = retail_lines(spark, sf_dir)
    holes = lines.withColumns(
        {
            "postal_code": F.when(F.col("customer_id") % 3 != 0, F.col("postal_code")),
            "city": F.when(F.col("customer_id") % 5 != 0, F.col("city")),
        }
    )
    places = star.dim_geography(holes)
    keyed = star.attach_geo_key(holes, places)
    counts = keyed.groupBy("geo_key", "state").agg(F.count("*").alias("lines"))
    return tidy(counts.where(F.col("geo_key").isNotNull()).groupBy("state").agg(
        F.count("*").alias("places"), F.sum("lines").alias("lines")
    ))


def reorder_override(lines: DataFrame) -> DataFrame:
    inventory = actions.rec_inventory(lines).select("sub_category", "reorder_point", "total_qty")
    modelled = features.reorder_points(lines)
    return actions.override_reorder(inventory, modelled)


def pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = purchase_table(spark, sf_dir)
    # One column per sub-category that occurs: a dimension, not the data, bounds their number.
    wide = aggregates.pivot_purchases(bought)
    return tidy(wide.toDF(*[name.lower().replace("#", "_") for name in wide.columns]))


def two_counts(lines: DataFrame) -> DataFrame:
    """Lines per channel and sub-category as one value-count table."""
    parts = [
        aggregates.value_counts(lines, name).select(
            F.lit(name).alias("dim"), F.col(name).alias("value"), "count"
        )
        for name in ("channel", "sub_category")
    ]
    return parts[0].unionByName(parts[1])


def both_boxes(lines: DataFrame) -> DataFrame:
    parts = [
        stats.box_summary(lines, "profit_margin", name)
        .withColumn("dim", F.lit(name))
        .withColumnRenamed(name, "value")
        for name in ("channel", "category")
    ]
    return parts[0].unionByName(parts[1])


def decile_bins(scored: DataFrame) -> DataFrame:
    return windows.quantile_cut(scored, "score", 10, "bin")


def segment_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = labelled_customers(spark, sf_dir)
    return tidy(labelled.select("customer_id", "segment_label", "churn_prob"))


def rfm_base(lines: DataFrame) -> DataFrame:
    base = aggregates.customer_features(lines, monetary_col="profit")
    return base.select("customer_id", "recency", "frequency", "monetary")


def predicted_class(scored: DataFrame) -> DataFrame:
    return scored.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def residual_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    residuals = evaluate.with_residuals(monthly_prediction(spark, sf_dir))
    return tidy(stats.histogram(residuals, "residual", 20), 3)


def stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_table(spark, sf_dir).select("customer_id", "churned")
    return tidy(features.stratified_split(customers, ["customer_id"], "churned"))


def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_table(spark, sf_dir).select("customer_id", "churned")
    return tidy(features.stratified_folds(customers, ["customer_id"], "churned"))


def demand_split(lines: DataFrame) -> DataFrame:
    demand = features.demand_lags(lines).select("sub_category", "month_no", "quantity")
    return features.hash_split(demand, ["sub_category", "month_no"])


def marts_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = retail_lines(spark, sf_dir)
    segments = labelled_customers(spark, sf_dir).select(
        "customer_id", "recency", "frequency", "monetary", "segment_label"
    )
    return tidy(aggregates.mart_customer(lines, rfm=segments))


def pricing(lines: DataFrame) -> DataFrame:
    return actions.rec_pricing(lines, features.elasticity(lines))


def inventory(lines: DataFrame) -> DataFrame:
    return actions.rec_inventory(lines, features.reorder_points(lines))


def priorities(lines: DataFrame) -> DataFrame:
    return actions.priority_counts(actions.rec_marketing(lines), pricing(lines))


def first_alerts(lines: DataFrame) -> DataFrame:
    return actions.alerts(actions.rec_marketing(lines), pricing(lines), inventory(lines))


def rfm_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star_tables(spark, sf_dir)
    return tidy(warehouse.rfm_scores(tables["fact_sales"], tables["dim_customer"]))


def champion_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = retail_lines(spark, sf_dir)
    return tidy(measures.segment_share(lines, labelled_customers(spark, sf_dir)))


def churn_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(measures.churn_risk(labelled_customers(spark, sf_dir), ["segment"]))


def segment_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(measures.segment_counts(labelled_customers(spark, sf_dir)))


def channel_draw(lines: DataFrame) -> DataFrame:
    """The keyed channel draw applied afresh."""
    drawn = clean.assign_channel(lines.drop("channel"))
    return drawn.select("row_id", "channel")


# Measures that look at earlier periods, by name; each is registered for quarters and years too.
PERIOD_MEASURES = {
    "growth": measures.growth,
    "running_total": measures.running_revenue,
    "active_customers": measures.active_customers,
    "new_customers": measures.new_customers,
    "retention": measures.retention,
    "turnover": measures.turnover,
    "flags": measures.flags,
}


def by_period(measure: Callable, period: str, by: list[str]) -> Callable[[DataFrame], DataFrame]:
    return lambda lines: measure(lines, by, period=period)


QUERIES: dict[str, Query] = {
    # sources, sinks, cleaning
    "csv_ingest": csv_ingest,
    "csv_roundtrip": csv_roundtrip,
    "profile_nulls": profile,
    "clean_lines": lambda spark, sf_dir: tidy(order_lines(spark, sf_dir)),
    "coerce_numeric": dirty_numbers,
    "assign_channel": on_lines(channel_draw),
    "dedup_keep_first": dedup,
    "validate_rules": rules,
    "clean_dirty": clean_dirty,
    "profile_dirty": profile_dirty,
    "encode_ordinal": on_lines(encoded),
    # joins
    "join_semi_top_categories": on_lines(
        lambda lines: features.in_top_categories(lines).select("row_id", "sub_category")
    ),
    "join_anti_unbought": lambda spark, sf_dir: tidy(
        recommend.unbought(purchase_table(spark, sf_dir))
    ),
    "join_nullsafe_geo": null_safe_geography,
    "join_override": on_lines(reorder_override),
    # star schema
    "star_dim_customer": on_star("dim_customer"),
    "star_dim_product": on_star("dim_product"),
    "star_dim_geography": on_star("dim_geography"),
    "star_dim_date": on_star("dim_date"),
    "star_fact": on_star("fact_sales"),
    "star_sink": star_sink,
    "dim_calendar": on_lines(star.dim_calendar),
    # warehouse questions
    "wh_profit_by_channel": on_question("profit_by_channel"),
    "wh_rfm_scores": rfm_top,
    "wh_profit_by_category": on_question("profit_by_category"),
    "wh_discount_impact": on_question("discount_impact"),
    "wh_monthly_trend": on_question("monthly_trend"),
    "wh_top_products": on_question("top_products"),
    "wh_loss_products": on_question("loss_products"),
    "wh_customer_clv": on_question("customer_clv"),
    "wh_region_channel": on_question("region_channel"),
    "wh_shipping": on_question("shipping"),
    # aggregations and marts
    "summary_totals": on_lines(aggregates.summary_totals),
    "summary_by_dim": on_lines(aggregates.summary_by_dim),
    "monthly_series": on_lines(aggregates.monthly_series),
    "customer_features": lambda spark, sf_dir: tidy(customer_table(spark, sf_dir)),
    "mart_customer": marts_customer,
    "mart_product": on_lines(
        lambda lines: aggregates.mart_product(lines, features.elasticity(lines))
    ),
    "mart_monthly_kpi": on_lines(aggregates.mart_monthly_kpi),
    "mart_fact": on_lines(aggregates.mart_fact),
    "exec_snapshot": on_lines(aggregates.exec_snapshot),
    "pivot_purchases": pivot,
    "value_counts": on_lines(two_counts),
    # windows and top lists
    "lag_features_revenue": on_lines(features.revenue_lags, 4),
    "lag_features_demand": on_lines(features.demand_lags),
    "lag_features_residual": on_lines(features.residual_lags, 4),
    "quantile_cut": on_scored(decile_bins),
    "segment_fallback": segment_fallback,
    "top_volume": on_lines(lambda lines: actions.top_volume(inventory(lines))),
    "alerts_top10": on_lines(first_alerts),
    # statistics
    "corr_matrix": on_lines(stats.corr_matrix),
    "profit_drivers": on_lines(stats.profit_drivers),
    "anova_channel": on_lines(lambda lines: stats.anova(lines, "profit_margin", "channel")),
    "anova_segment": on_lines(lambda lines: stats.anova(lines, "profit_margin", "segment")),
    "margin_by_segment": on_lines(stats.margin_by_segment),
    "welch_discount": on_lines(
        lambda lines: stats.welch_discount(lines).drop("p_value", "significant")
    ),
    "welch_discount_test": on_lines(stats.welch_discount),
    "discount_bins": on_lines(stats.discount_bins),
    "margin_moments": on_lines(stats.margin_moments),
    "margin_normality": on_lines(stats.margin_normality, 5),
    "margin_histogram": on_lines(stats.margin_histogram),
    "margin_boxplot": on_lines(both_boxes),
    "rfm_base": on_lines(rfm_base),
    # model inputs
    "revenue_forecast_12m": on_lines(
        lambda lines: features.seasonal_forecast(aggregates.monthly_series(lines)), 2
    ),
    "revenue_forecast_bends": on_lines(
        lambda lines: forecast.trend_season_forecast(aggregates.monthly_series(lines)), 2
    ),
    "category_forecast_bends": on_lines(
        lambda lines: forecast.trend_season_forecast(
            aggregates.monthly_series(lines, ["category"]), by=["category"]
        ),
        2,
    ),
    "stratified_split": stratified,
    "return_label": on_lines(
        lambda lines: features.return_label(lines).select("row_id", "returned")
    ),
    "elasticity_overall": on_lines(features.elasticity_overall),
    "elasticity_by_subcategory": on_lines(features.elasticity),
    "hash_split": on_lines(demand_split),
    "reorder_points": on_lines(features.reorder_points),
    "monthly_demand": on_lines(features.monthly_demand),
    # evaluation on a reproducible score
    "cv_folds": folds,
    "classification_report": on_scored(
        lambda scored: evaluate.classification_report(predicted_class(scored))
    ),
    "roc_curve": on_scored(evaluate.roc_curve),
    "roc_auc": on_scored(evaluate.roc_auc),
    "pr_curve": on_scored(evaluate.pr_curve),
    "average_precision": on_scored(evaluate.average_precision),
    "lift_table": on_scored(evaluate.lift_table),
    "regression_metrics": lambda spark, sf_dir: tidy(
        evaluate.regression_metrics(monthly_prediction(spark, sf_dir)), 4
    ),
    "residual_hist": residual_histogram,
    # measures
    "kpi_core": on_lines(measures.core),
    "kpi_core_year_region": on_lines(lambda lines: measures.core(lines, ["region"], "year")),
    "kpi_core_quarter_segment": on_lines(
        lambda lines: measures.core(lines, ["segment"], "quarter")
    ),
    "kpi_growth": on_lines(measures.growth),
    "kpi_growth_region": on_lines(lambda lines: measures.growth(lines, ["region"])),
    "kpi_running_total": on_lines(measures.running_revenue),
    "kpi_active_customers": on_lines(measures.active_customers),
    "kpi_new_customers": on_lines(measures.new_customers),
    "kpi_retention": on_lines(measures.retention),
    **{f"kpi_{name}_quarter": on_lines(by_period(work, "quarter", [])) for name, work in PERIOD_MEASURES.items()},
    **{f"kpi_{name}_year_region": on_lines(by_period(work, "year", ["region"])) for name, work in PERIOD_MEASURES.items()},
    "kpi_avg_clv": on_lines(measures.average_clv),
    "kpi_champion_share": champion_share,
    "kpi_churn": churn_measure,
    "kpi_segment_counts": segment_measure,
    "kpi_ops": on_lines(measures.operations),
    "kpi_category_share": on_lines(measures.category_share),
    "kpi_turnover": on_lines(measures.turnover),
    "kpi_flags": on_lines(measures.flags),
    # action tables
    "rec_marketing": on_lines(actions.rec_marketing),
    "rec_pricing": on_lines(pricing),
    "rec_inventory": on_lines(inventory),
    "rec_channel": on_lines(actions.rec_channel),
    "rec_priority_counts": on_lines(priorities),
}


# ---------------------------------------------------------------- fitted models

_models: dict[tuple[str, str, str], models.Fitted] = {}


def fitted(spark: SparkSession, sf_dir: str, name: str) -> models.Fitted:
    """A model fitted once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _models:
        lines = retail_lines(spark, sf_dir)
        _models[key] = {
            "churn": lambda: models.fit_churn(customer_table(spark, sf_dir)),
            "returns": lambda: models.fit_returns(lines),
            "revenue": lambda: models.fit_revenue(lines),
            "residuals": lambda: models.fit_residuals(lines),
            "demand": lambda: models.fit_demand(lines),
        }[name]()
    return _models[key]


def fitted_side_by_side(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> None:
    """Fits the models at the same time, as a fit of boosted trees is a chain of small jobs."""
    # What the fits share is staged first, once.
    retail_lines(spark, sf_dir)
    if "churn" in names:
        customer_table(spark, sf_dir)
    with ThreadPool(len(names)) as pool:
        pool.map(inheritable_thread_target(spark)(lambda name: fitted(spark, sf_dir, name)), names)


def churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fitted(spark, sf_dir, "churn").scored
    return tidy(scored.select("customer_id", "churned", "is_test", "churn_prob", "prediction"))


def return_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fitted(spark, sf_dir, "returns").scored
    return tidy(scored.select(*models.LINE_KEY, "returned", "return_prob", "prediction"))


def backtest(name: str, keys: list[str]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = evaluate.with_residuals(fitted(spark, sf_dir, name).scored)
        return tidy(scored.select(*keys, "actual", "predicted", "residual"), 4)

    return query


def model_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error measures of the three regressions on their held-out rows."""
    names = ("revenue", "residuals", "demand")
    fitted_side_by_side(spark, sf_dir, names)
    parts = [
        evaluate.regression_metrics(fitted(spark, sf_dir, name).scored).withColumn(
            "model", F.lit(name)
        )
        for name in names
    ]
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]), 4)


def importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("churn", "returns", "demand")
    fitted_side_by_side(spark, sf_dir, names)
    parts = [
        models.feature_importance(fitted(spark, sf_dir, name)).withColumn("model", F.lit(name))
        for name in names
    ]
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a saved and reloaded model next to those of the original."""
    original = fitted(spark, sf_dir, "churn")
    path = storage.new_path(spark, "model")
    models.save_model(original.model, path)
    customers = customer_table(spark, sf_dir)

    def scores(model, name: str) -> DataFrame:
        scored = model.transform(customers)
        return scored.select("customer_id", vector_to_array("probability")[1].alias(name))

    before = scores(original.model, "fitted_prob")
    return tidy(before.join(scores(models.load_model(path), "loaded_prob"), "customer_id"))


def cv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "cv", lambda: cross_validated(spark, sf_dir))


def cross_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    churn = models.cross_validate(
        customer_table(spark, sf_dir),
        aggregates.CHURN_FEATURES,
        ["customer_id"],
        "churned",
        models.churn_estimator(),
    )
    returns = models.cross_validate(
        models.return_inputs(retail_lines(spark, sf_dir)),
        models.RETURN_FEATURES,
        models.LINE_KEY,
        "returned",
        models.returns_estimator(),
    ).where(F.col("metric").isin("auc", "f1"))
    churn = churn.withColumn("model", F.lit("churn"))
    return tidy(churn.unionByName(returns.withColumn("model", F.lit("returns"))))


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = rfm_base(retail_lines(spark, sf_dir))
    return once(spark, sf_dir, "clusters", lambda: models.rfm_clusters(base))


def close(first: Column, second: Column) -> Column:
    return (F.abs(first - second) < 1e-9).cast("bigint")


def churn_scores_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split and label of each customer, and whether exactly the test rows have a probability."""
    scored = fitted(spark, sf_dir, "churn").scored
    inside = F.coalesce(F.col("churn_prob").between(0, 1), F.lit(False)).cast("bigint")
    agrees = F.coalesce((F.col("churn_prob") >= 0.5).cast("int") == F.col("prediction"), F.lit(True))
    return tidy(
        scored.select("customer_id", "churned", "is_test", inside.alias("scored"), agrees.cast("bigint").alias("agrees"))
    )


def return_scores_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out lines, their label and whether the probability is one."""
    inside = F.coalesce(F.col("return_prob").between(0, 1), F.lit(False)).cast("bigint")
    scored = fitted(spark, sf_dir, "returns").scored
    return tidy(scored.select(*models.LINE_KEY, "returned", inside.alias("scored")))


def backtest_check(name: str, keys: list[str]) -> Query:
    """The held-out rows, their true value and whether residual and prediction add up to it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = evaluate.with_residuals(fitted(spark, sf_dir, name).scored)
        adds_up = (F.abs(F.col("predicted") + F.col("residual") - F.col("actual")) < 1e-6).cast("bigint")
        return tidy(scored.select(*keys, "actual", F.coalesce(adds_up, F.lit(0)).alias("adds_up")), 4)

    return query


def importance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = importances(spark, sf_dir).groupBy("model").agg(
        F.sum("importance").alias("total"), F.min("importance").alias("least")
    )
    fine = ((F.abs(F.col("total") - 1) < 1e-4) & (F.col("least") >= 0)).cast("bigint")
    return sums.select("model", fine.alias("adds_up"))


def roundtrip_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = model_roundtrip(spark, sf_dir)
    return scores.select("customer_id", close(F.col("fitted_prob"), F.col("loaded_prob")).alias("equal"))


def cv_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = (F.col("mean").between(0, 1) & F.col("std").between(0, 0.5)).cast("bigint")
    return cv_scores(spark, sf_dir).select("model", "metric", F.coalesce(inside, F.lit(0)).alias("inside"))


def attribution_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per explained customer, whether base and attributions give the margin, and the margin the
    fitted probability."""
    parts = explained(spark, sf_dir)
    names = [name for name in parts.columns if name.startswith("phi_")]
    total = sum((F.col(name) for name in names), F.col("base_value"))
    probability = 1 / (1 + F.exp(-2 * F.col("margin")))
    scored = fitted(spark, sf_dir, "churn").scored.select("customer_id", "churn_prob")
    return parts.join(scored, "customer_id").select(
        "customer_id",
        close(total, F.col("margin")).alias("adds_up"),
        close(probability, F.col("churn_prob")).alias("gives_score"),
    )


def cluster_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per cluster label in order of mean monetary value: the place each label takes."""
    means = clusters(spark, sf_dir).groupBy("segment_label").agg(F.avg("monetary").alias("mean"))
    # One row per cluster.
    place = F.row_number().over(Window.orderBy(F.col("mean").desc()))
    return means.select("segment_label", place.cast("bigint").alias("place"))


def explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    churn = fitted(spark, sf_dir, "churn")
    tested = models.Fitted(churn.model, churn.features, churn.scored.where("is_test = 1"))
    return attributions.attributions(tested, "customer_id")


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = purchase_table(spark, sf_dir)
    return once(spark, sf_dir, "neighbours", lambda: recommend.similar_customers(bought))


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = purchase_table(spark, sf_dir)
    return tidy(recommend.recommend(bought, neighbours(spark, sf_dir)), 4)


def marketing_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marketing actions from fitted churn scores and clusters instead of the rules."""
    lines = retail_lines(spark, sf_dir)
    churn = fitted(spark, sf_dir, "churn").scored
    return tidy(actions.rec_marketing(lines, churn, clusters(spark, sf_dir)))


QUERIES.update(
    {
        "rfm_clusters": lambda spark, sf_dir: tidy(clusters(spark, sf_dir)),
        "rfm_cluster_means": lambda spark, sf_dir: tidy(
            models.cluster_means(clusters(spark, sf_dir))
        ),
        "churn_scores": churn_scores,
        "return_scores": return_scores,
        "revenue_backtest": backtest("revenue", ["period"]),
        "residual_table": backtest("residuals", ["period"]),
        "demand_backtest": backtest("demand", ["sub_category", "month_no"]),
        "backtest_metrics": model_reports,
        "feature_importance": importances,
        "model_roundtrip": model_roundtrip,
        "cv_scores": cv_scores,
        "churn_scores_check": churn_scores_check,
        "return_scores_check": return_scores_check,
        "revenue_backtest_check": backtest_check("revenue", ["period"]),
        "residual_table_check": backtest_check("residuals", ["period"]),
        "demand_backtest_check": backtest_check("demand", ["sub_category", "month_no"]),
        "importance_check": importance_check,
        "model_roundtrip_check": roundtrip_check,
        "cv_check": cv_check,
        "attribution_check": attribution_check,
        "cluster_check": cluster_check,
        "attributions": lambda spark, sf_dir: tidy(explained(spark, sf_dir)),
        "attribution_summary": lambda spark, sf_dir: tidy(
            attributions.attribution_summary(explained(spark, sf_dir))
        ),
        "similar_customers": lambda spark, sf_dir: tidy(neighbours(spark, sf_dir), 9),
        "recommendations": recommendations,
        "copurchase_corr": lambda spark, sf_dir: tidy(
            recommend.copurchase_corr(purchase_table(spark, sf_dir))
        ),
        "rec_marketing_fitted": marketing_fitted,
    }
)
