"""Business summaries, monthly series, customer features and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia import storage
from marginalia.functions.columns import mean, month_start, one_row, total
from marginalia.operators.clean import encode_ordinal
from marginalia.operators.star import first_present_per_key
from marginalia.operators.windows import average_rank, exact_quantiles, join_same

FACT_MART = [
    "order_id", "order_date", "order_year", "order_month", "order_quarter", "customer_id",
    "segment", "product_id", "category", "sub_category", "region", "state", "city", "channel",
    "ship_mode", "sales", "quantity", "discount", "profit", "profit_margin", "cost",
    "profit_per_unit", "is_profitable", "ship_days",
]

CHURN_FEATURES = [
    "recency", "frequency", "monetary", "total_profit", "avg_discount", "avg_margin",
    "num_categories", "num_channels",
]


def add_distinct(groups: DataFrame, lines: DataFrame, by: list[str], counts: dict[str, str]) -> DataFrame:
    """Groups with exact counts of different values: ``{output: column}``.

    Each column is grouped by itself, from its own bytes and once per value in the map tasks;
    counting several in one grouping would copy every line once per column.
    """
    for name, column in counts.items():
        found = lines.select(*by, column).distinct().groupBy(*by).agg(F.count(column).alias(name))
        groups = join_same(groups, found, by) if by else groups.withColumn(name, found.scalar())
    return groups


def customer_facts(
    lines: DataFrame, sums: dict[str, str], means: dict[str, str], dims: dict[str, str]
) -> DataFrame:
    """One row per customer: orders, first and last order, exact sums, means, and how many different
    values of small dimensions (``{output: column}``) the customer has.

    Lines are reduced to orders and orders to customers. Values of a dimension are bits of a few
    longs, as many as the dimension needs, so nothing is copied per counted column.
    """
    held = storage.stage(lines.select(*dims.values()).distinct(), "dimensions")
    coded = encode_ordinal(lines, list(dims.values()), "_bit", held)
    widths = held.agg(*[F.countDistinct(column).alias(column) for column in dims.values()]).first()
    words = {column: max(1, -(-widths[column] // 63)) for column in dims.values()}
    bits = {}
    for column, many in words.items():
        for word in range(many):
            code = F.col(f"{column}_bit")
            bit = F.expr(f"shiftleft(1L, cast({column}_bit % 63 as int))")
            bits[f"_{column}_{word}"] = F.bit_or(F.when(F.floor(code / 63) == word, bit).otherwise(F.lit(0).cast("bigint")))
    orders = coded.groupBy("customer_id", "order_id").agg(
        F.min("order_date").alias("_first"),
        F.max("order_date").alias("_last"),
        *[F.sum(column).alias(f"_sum_{column}") for column in {*sums.values(), *means.values()}],
        *[F.count(column).alias(f"_n_{column}") for column in set(means.values())],
        *[value.alias(name) for name, value in bits.items()],
    )
    share = {
        name: F.try_divide(F.sum(f"_sum_{column}").cast("double"), F.sum(f"_n_{column}"))
        for name, column in means.items()
    }
    many = {
        name: sum((F.bit_count(F.bit_or(f"_{column}_{word}")) for word in range(words[column])), F.lit(0)).cast("bigint")
        for name, column in dims.items()
    }
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"),
        F.min("_first").alias("first_order"),
        F.max("_last").alias("last_order"),
        *[F.sum(f"_sum_{column}").cast("double").alias(name) for name, column in sums.items()],
        *[value.alias(name) for name, value in {**share, **many}.items()],
    )


def summary_totals(lines: DataFrame) -> DataFrame:
    sums = lines.agg(
        total("sales").alias("total_revenue"),
        total("profit").alias("total_profit"),
        mean("profit_margin").alias("avg_margin"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )
    return add_distinct(sums, lines, [], {"customers": "customer_id", "products": "product_id"})


def summary_by_dim(lines: DataFrame) -> DataFrame:
    """Totals by channel and segment and means by category, in one long table.

    Lines are first reduced to one row per combination of the three dimensions, so the table
    is scanned once and the three views are groupings of that small result.
    """
    dims = ["channel", "segment", "category"]
    cells = lines.groupBy(*dims).agg(
        F.sum("sales").alias("s"),
        F.sum("profit").alias("p"),
        F.sum("profit_margin").alias("m"),
        F.count("*").alias("n"),
    )
    entries = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("value")) for d in dims])
    long = cells.select(F.explode(entries).alias("e"), "s", "p", "m", "n")
    long = long.select("e.dim", "e.value", "s", "p", "m", "n").where("value IS NOT NULL")
    rows = F.sum("n")
    is_mean = F.col("dim") == "category"
    by_dim = long.groupBy("dim", "value").agg(
        F.sum("s").alias("s"), F.sum("p").alias("p"), F.sum("m").alias("m"), rows.alias("n")
    )
    per_line = {c: F.round(F.col(c).cast("double") / F.col("n"), 4) for c in ("s", "p", "m")}
    sums = {c: F.round(c, 2).cast("double") for c in ("s", "p")}
    return by_dim.select(
        "dim",
        "value",
        F.when(is_mean, per_line["s"]).otherwise(sums["s"]).alias("sales"),
        F.when(is_mean, per_line["p"]).otherwise(sums["p"]).alias("profit"),
        F.when(is_mean, per_line["m"]).alias("profit_margin"),
    )


def monthly_series(lines: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Revenue, profit and quantity per month, optionally per further key."""
    by = by or []
    monthly = lines.groupBy(*by, "order_year", "order_month").agg(
        total("sales").alias("revenue"),
        total("profit").alias("profit"),
        F.sum("quantity").alias("quantity"),
    )
    return monthly.withColumns(
        {
            "period": month_start("order_year", "order_month"),
            "month_no": F.expr("CAST(order_year * 12 + order_month - 1 AS BIGINT)"),
        }
    )


def customer_features(
    lines: DataFrame, monetary_col: str = "sales", churn_days: int = 180
) -> DataFrame:
    """One row per customer: recency, frequency, value, habits and the churn label."""
    latest = lines.select(F.max("order_date")).scalar()
    facts = customer_facts(
        lines.where(F.col("customer_id").isNotNull()),
        {"monetary": monetary_col, "total_profit": "profit"},
        {"avg_discount": "discount", "avg_margin": "profit_margin"},
        {"num_categories": "category", "num_channels": "channel"},
    )
    facts = facts.withColumn("recency", F.datediff(latest, "last_order").cast("bigint"))
    features = facts.withColumnRenamed("orders", "frequency").select("customer_id", *CHURN_FEATURES)
    return features.withColumn("churned", (F.col("recency") > churn_days).cast("int"))


def mart_customer(
    lines: DataFrame, rfm: DataFrame | None = None, churn: DataFrame | None = None
) -> DataFrame:
    """Customer mart. Segments and churn scores join when given."""
    known = lines.where(F.col("customer_id").isNotNull())
    names = first_present_per_key(known, "customer_id", ["customer_name", "segment", "region"])
    facts = customer_facts(
        known,
        {"total_revenue": "sales", "total_profit": "profit"},
        {"avg_discount": "discount", "avg_margin": "profit_margin"},
        {"num_categories": "category", "num_channels": "channel"},
    ).withColumnRenamed("orders", "total_orders")
    # Both sides are grouped on customer_id, so this join needs no further shuffle.
    mart = names.join(facts, "customer_id")
    if rfm is not None:
        columns = ["customer_id", "recency", "frequency", "monetary", "segment_label"]
        mart = mart.join(rfm.select(*columns), "customer_id", "left")
    if churn is not None:
        mart = mart.join(churn.select("customer_id", "churn_prob"), "customer_id", "left")
    return mart


def mart_product(lines: DataFrame, elasticity: DataFrame | None = None) -> DataFrame:
    """Product mart with profit rank. Elasticities join when given."""
    keys = ["product_id", "product_name", "category", "sub_category"]
    known = lines.dropna(subset=keys)
    mart = known.groupBy(*keys).agg(
        F.sum("sales").alias("total_revenue"),
        F.sum("profit").alias("total_profit"),
        F.sum("quantity").alias("total_qty"),
        mean("profit_margin").alias("avg_margin"),
        mean("discount").alias("avg_discount"),
        F.count("order_id").alias("times_sold"),
    )
    mart = average_rank(mart, "total_profit", "profit_rank")
    mart = mart.withColumns(
        {name: F.col(name).cast("double") for name in ("total_revenue", "total_profit")}
    )
    if elasticity is not None:
        mart = mart.join(elasticity, "sub_category", "left")
    return mart


def mart_monthly_kpi(lines: DataFrame) -> DataFrame:
    keys = ["order_year", "order_month", "channel", "category"]
    return lines.dropna(subset=keys).groupBy(*keys).agg(
        total("sales").alias("revenue"),
        total("profit").alias("profit"),
        F.countDistinct("order_id").alias("orders"),
        F.sum("quantity").alias("qty"),
    )


def mart_fact(lines: DataFrame) -> DataFrame:
    return lines.select(*FACT_MART)


def exec_snapshot(lines: DataFrame) -> DataFrame:
    """Headline totals and the profit that could be recovered.

    ``combined_recovery`` adds two overlapping sets, as the figure is defined;
    ``distinct_recovery`` takes their union, each line once.
    """
    profit, deep = F.col("profit"), F.col("discount") > 0.30
    loss = F.sum(F.when(profit < 0, profit).otherwise(0))
    drain = F.sum(F.when(deep, profit).otherwise(0))
    union = F.sum(F.when((profit < 0) | deep, profit).otherwise(0))
    snapshot = lines.agg(
        F.count("*").alias("transactions"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        total("sales").alias("total_revenue"),
        total("profit").alias("total_profit"),
        mean("profit_margin").alias("avg_margin"),
        F.abs(loss).alias("recoverable"),
        F.abs(F.least(drain, F.lit(0).cast("decimal(18,4)"))).alias("over_discount_drain"),
        F.abs(F.least(union, F.lit(0).cast("decimal(18,4)"))).alias("distinct_recovery"),
    )
    snapshot = add_distinct(snapshot, lines, [], {"total_orders": "order_id", "total_customers": "customer_id"})
    both = F.col("recoverable") + F.col("over_discount_drain")
    return snapshot.withColumns(
        {
            "combined_recovery": both.cast("double"),
            "distinct_recovery": F.col("distinct_recovery").cast("double"),
            "recoverable": F.col("recoverable").cast("double"),
            "over_discount_drain": F.col("over_discount_drain").cast("double"),
        }
    )


def purchases(lines: DataFrame) -> DataFrame:
    """Sales per customer and sub-category, long form: absent pairs mean zero."""
    known = lines.dropna(subset=["customer_id", "sub_category"])
    return known.groupBy("customer_id", "sub_category").agg(F.sum("sales").alias("sales"))


def pivot_purchases(bought: DataFrame, values: list[str] | None = None) -> DataFrame:
    """Customers by sub-categories, zero-filled. Without ``values`` Spark looks them up."""
    wide = bought.groupBy("customer_id").pivot("sub_category", values)
    return wide.agg(F.sum("sales").cast("double")).fillna(0.0)


def value_counts(df: DataFrame, name: str) -> DataFrame:
    counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("count"))
    return counts.orderBy(F.col("count").desc(), name)


def rule_segments(customers: DataFrame) -> DataFrame:
    """Segment by quantile thresholds, used when no fitted segments are given."""
    limits = exact_quantiles(customers, "monetary", {"_q75": 0.75, "_q50": 0.50})
    with_limits = customers.withColumn("_limits", one_row(limits))
    label = (
        F.when(F.col("monetary") > F.col("_limits._q75"), "Champions")
        .when(F.col("monetary") > F.col("_limits._q50"), "Loyal")
        .when(F.col("recency") > 180, "At Risk")
        .otherwise("Potential Loyalist")
    )
    return with_limits.withColumn("segment_label", label).drop("_limits")


def rule_churn(customers: DataFrame) -> DataFrame:
    """Two-level churn probability, used when no fitted scores are given."""
    return customers.withColumn(
        "churn_prob", F.when(F.col("recency") > 180, 0.8).otherwise(0.2)
    )
