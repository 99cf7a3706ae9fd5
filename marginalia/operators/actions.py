"""Action tables: what to do per customer, sub-category and channel, by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.columns import mean, nan_to_null, ratio, total
from marginalia.operators.aggregates import add_distinct, customer_facts, rule_churn, rule_segments
from marginalia.operators.star import first_present_per_key

# The texts of the recommended actions.
MARKETING = {
    "champions": "VIP loyalty rewards + cross-sell premium products",
    "loyal": "Upsell to higher-margin categories (Technology)",
    "win_back": "Win-back campaign: targeted 10% coupon",
    "at_risk": "Re-engagement email: show personalized deals",
    "dormant": "Dormant reactivation: survey + discount offer",
    "standard": "Standard newsletter + seasonal promotions",
}
PRICING = {
    "stop": "STOP DISCOUNTING — margin negative; set floor price",
    "reduce": "REDUCE discount to ≤10%; margin recovery priority",
    "cut": "Slight price reduction to grow volume (elastic)",
    "raise": "Price increase opportunity — inelastic demand",
    "hold": "Maintain current pricing; monitor quarterly",
}
INVENTORY = {
    "liquidate": "LIQUIDATE or discontinue — loss-making",
    "increase": "INCREASE stock — high margin, ensure availability",
    "low_volume": "LOW VOLUME — reduce SKU count; keep top sellers only",
    "maintain": "MAINTAIN — review reorder point monthly",
}
CHANNEL = {
    "scale_up": "SCALE UP — over-indexing on profit; increase investment",
    "review": "REVIEW — low margin; audit discount and cost structure",
    "reduce": "REDUCE DISCOUNTS on this channel; test lower rates",
    "maintain": "MAINTAIN — healthy contribution; optimize AOV",
}


def customer_base(lines: DataFrame) -> DataFrame:
    """Customer rows for marketing: names, recency, frequency, profit and habits."""
    known = lines.where(F.col("customer_id").isNotNull())
    latest = lines.select(F.max("order_date")).scalar()
    names = first_present_per_key(known, "customer_id", ["customer_name", "segment"])
    facts = customer_facts(
        known,
        {"monetary": "profit"},
        {"avg_discount": "discount", "avg_margin": "profit_margin"},
        {"num_channels": "channel"},
    )
    facts = facts.select(
        "customer_id",
        F.datediff(latest, "last_order").cast("bigint").alias("recency"),
        F.col("orders").alias("frequency"),
        "monetary",
        "avg_discount",
        "avg_margin",
        "num_channels",
    )
    return names.join(facts, "customer_id")


def marketing_rules(customers: DataFrame) -> DataFrame:
    """First matching rule wins. A NULL churn probability passes no threshold."""
    segment, churn = F.col("segment_label"), F.col("churn_prob")
    action = (
        F.when(segment == "Champions", MARKETING["champions"])
        .when(segment == "Loyal", MARKETING["loyal"])
        .when(churn > 0.7, MARKETING["win_back"])
        .when(segment == "At Risk", MARKETING["at_risk"])
        .when(F.col("recency") > 120, MARKETING["dormant"])
        .otherwise(MARKETING["standard"])
    )
    priority = (
        F.when((churn > 0.7) | (segment == "Champions"), "HIGH")
        .when(churn > 0.4, "MEDIUM")
        .otherwise("LOW")
    )
    return customers.withColumns({"recommended_action": action, "priority": priority})


def rec_marketing(
    lines: DataFrame, churn: DataFrame | None = None, segments: DataFrame | None = None
) -> DataFrame:
    """Action and priority per customer; scores and segments fall back to rules when absent."""
    customers = customer_base(lines)
    if churn is not None:
        scores = churn.select("customer_id", nan_to_null("churn_prob"))
        customers = customers.join(scores, "customer_id", "left")
    else:
        customers = rule_churn(customers)
    if segments is not None:
        labels = segments.select("customer_id", "segment_label")
        customers = customers.join(labels, "customer_id", "left")
    else:
        customers = rule_segments(customers)
    return marketing_rules(customers).orderBy("priority", F.col("monetary").desc(), "customer_id")


def pricing_rules(products: DataFrame) -> DataFrame:
    """First matching rule wins. A NULL elasticity fails both elasticity rules."""
    margin, discount = F.col("avg_margin"), F.col("avg_discount")
    slope = F.col("elasticity")
    action = (
        F.when(margin < 0, PRICING["stop"])
        .when((discount > 0.25) & (margin < 0.10), PRICING["reduce"])
        .when((slope < -1.5) & (margin > 0.20), PRICING["cut"])
        .when((slope > -0.5) & (margin > 0.15), PRICING["raise"])
        .otherwise(PRICING["hold"])
    )
    urgency = F.when(margin < 0, "CRITICAL").when(margin < 0.05, "HIGH").otherwise("NORMAL")
    return products.withColumns({"pricing_action": action, "urgency": urgency})


def rec_pricing(lines: DataFrame, elasticity: DataFrame | None = None) -> DataFrame:
    known = lines.dropna(subset=["sub_category", "category"])
    products = known.groupBy("sub_category", "category").agg(
        mean("discount").alias("avg_discount"),
        mean("profit_margin").alias("avg_margin"),
        total("profit").alias("total_profit"),
        total("sales").alias("total_revenue"),
        F.sum("quantity").alias("total_qty"),
    )
    if elasticity is None:
        products = products.withColumn("elasticity", F.lit(None).cast("double"))
    else:
        slopes = elasticity.select("sub_category", nan_to_null("elasticity"))
        products = products.join(slopes, "sub_category", "left")
    return pricing_rules(products).orderBy("urgency", "total_profit", "sub_category")


def override_reorder(inventory: DataFrame, reorder: DataFrame) -> DataFrame:
    """A modelled reorder point replaces the rule's; elsewhere the rule's stays."""
    modelled = reorder.select("sub_category", F.col("reorder_point").alias("_ml"))
    joined = inventory.join(modelled, "sub_category", "left")
    point = F.coalesce(nan_to_null("_ml"), F.col("reorder_point"))
    return joined.withColumn("reorder_point", point).drop("_ml")


def inventory_rules(inventory: DataFrame) -> DataFrame:
    margin = F.col("avg_margin")
    action = (
        F.when(margin < 0, INVENTORY["liquidate"])
        .when(margin > 0.25, INVENTORY["increase"])
        .when(F.col("total_qty") < 50, INVENTORY["low_volume"])
        .otherwise(INVENTORY["maintain"])
    )
    return inventory.withColumn("inventory_action", action)


def rec_inventory(lines: DataFrame, reorder: DataFrame | None = None) -> DataFrame:
    known = lines.dropna(subset=["sub_category", "category"])
    inventory = known.groupBy("sub_category", "category").agg(
        mean("quantity").alias("monthly_avg_qty"),
        F.stddev_samp("quantity").alias("std_qty"),
        F.sum("quantity").alias("total_qty"),
        total("profit").alias("total_profit"),
        mean("profit_margin").alias("avg_margin"),
    )
    safety = F.bround(F.coalesce("std_qty", F.lit(0.0)) * 1.65, 0)
    inventory = inventory.withColumn("safety_stock", safety)
    inventory = inventory.withColumns(
        {
            "reorder_point": F.bround(F.col("monthly_avg_qty") + F.col("safety_stock"), 0),
            "annual_demand": F.bround(F.col("monthly_avg_qty") * 12, 0),
        }
    )
    if reorder is not None:
        inventory = override_reorder(inventory, reorder)
    return inventory_rules(inventory).orderBy("total_profit", "sub_category")


def channel_rules(channels: DataFrame) -> DataFrame:
    action = (
        F.when(F.col("profit_share_%") > F.col("revenue_share_%") * 1.1, CHANNEL["scale_up"])
        .when(F.col("avg_margin") < 0.05, CHANNEL["review"])
        .when(F.col("avg_discount") > 0.20, CHANNEL["reduce"])
        .otherwise(CHANNEL["maintain"])
    )
    return channels.withColumn("channel_action", action)


def rec_channel(lines: DataFrame) -> DataFrame:
    known = lines.where(F.col("channel").isNotNull())
    channels = known.groupBy("channel").agg(
        F.sum("sales").alias("revenue"),
        F.sum("profit").alias("profit"),
        mean("profit_margin").alias("avg_margin"),
        mean("discount").alias("avg_discount"),
    )
    channels = add_distinct(channels, known, ["channel"], {"orders": "order_id", "customers": "customer_id"})
    # One row per channel. Sums stay decimal up to the division.
    everyone = Window.partitionBy()
    revenue, profit = F.col("revenue"), F.col("profit")
    channels = channels.withColumns(
        {
            "profit_per_order": ratio(profit, F.col("orders")),
            "revenue_share_%": ratio(revenue, F.sum(revenue).over(everyone)) * 100,
            "profit_share_%": ratio(profit, F.sum(profit).over(everyone)) * 100,
        }
    )
    channels = channels.withColumns(
        {"revenue": revenue.cast("double"), "profit": profit.cast("double")}
    )
    return channel_rules(channels)


def priority_counts(marketing: DataFrame, pricing: DataFrame) -> DataFrame:
    """Rows per priority level of the marketing and pricing tables."""
    levels = [
        ("marketing", marketing.select(F.col("priority").alias("level"))),
        ("pricing", pricing.select(F.col("urgency").alias("level"))),
    ]
    counted = [
        rows.groupBy("level").agg(F.count("*").alias("count")).withColumn("report", F.lit(name))
        for name, rows in levels
    ]
    return counted[0].unionByName(counted[1])


def top_volume(inventory: DataFrame, top: int = 12) -> DataFrame:
    return inventory.orderBy(F.col("total_qty").desc(), "sub_category").limit(top)


def alerts(marketing: DataFrame, pricing: DataFrame, inventory: DataFrame, top: int = 10) -> DataFrame:
    """The rows each report shows first, in one table."""
    shown = [
        marketing.where(F.col("priority") == "HIGH")
        .orderBy(F.col("monetary").desc(), "customer_id")
        .limit(top)
        .select(
            F.lit("marketing").alias("report"),
            F.col("customer_id").cast("string").alias("subject"),
            F.col("priority").alias("level"),
            F.col("recommended_action").alias("action"),
        ),
        pricing.where(F.col("urgency").isin("CRITICAL", "HIGH"))
        .orderBy("urgency", "total_profit", "sub_category")
        .limit(top)
        .select(
            F.lit("pricing").alias("report"),
            F.col("sub_category").alias("subject"),
            F.col("urgency").alias("level"),
            F.col("pricing_action").alias("action"),
        ),
        inventory.orderBy("total_profit", "sub_category")
        .limit(top)
        .select(
            F.lit("inventory").alias("report"),
            F.col("sub_category").alias("subject"),
            F.lit(None).cast("string").alias("level"),
            F.col("inventory_action").alias("action"),
        ),
    ]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])
