"""Ten profitability questions as Spark SQL over the star schema.

Facts are summed per product or customer before a dimension joins, so a popular product
reaches the join as one row, and the join shuffles sums rather than lines. Money sums stay decimal until they are rounded. Every top list has a full tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia import storage
from marginalia.operators import windows
from marginalia.functions.columns import money

TABLES = ["dim_customer", "dim_product", "dim_geography", "dim_date", "fact_sales"]


def _avg(column: str, scale: int = 100, places: int = 2) -> str:
    return f"round(CAST(sum({column}) AS DOUBLE) / count({column}) * {scale}, {places})"


def _money(column: str) -> str:
    return f"CAST(round(sum({column}), 2) AS DOUBLE)"


QUESTIONS = {
    "profit_by_channel": f"""
        SELECT channel,
               count(*) AS orders,
               {_money("sales")} AS total_revenue,
               {_money("profit")} AS total_profit,
               {_avg("profit_margin")} AS avg_margin_pct
        FROM {{fact_sales}}
        GROUP BY channel
        ORDER BY total_profit DESC, channel""",
    "profit_by_category": f"""
        SELECT p.category, p.sub_category,
               sum(n) AS line_items,
               CAST(round(sum(sales), 2) AS DOUBLE) AS revenue,
               CAST(round(sum(f.profit), 2) AS DOUBLE) AS profit,
               round(sum(margins) / sum(n) * 100, 2) AS avg_margin_pct,
               round(CAST(sum(discounts) AS DOUBLE) / sum(n) * 100, 2) AS avg_discount_pct,
               sum(profitable) AS profitable_orders
        FROM (SELECT product_id, count(*) AS n, sum(sales) AS sales, sum(profit) AS profit,
                     sum(profit_margin) AS margins, sum(discount) AS discounts,
                     sum(is_profitable) AS profitable
              FROM {{fact_sales}} GROUP BY product_id) f
        JOIN {{dim_product}} p ON f.product_id = p.product_id
        GROUP BY p.category, p.sub_category
        ORDER BY profit DESC, p.sub_category""",
    "discount_impact": f"""
        SELECT CASE WHEN discount = 0 THEN '0%  No discount'
                    WHEN discount <= 0.10 THEN '1–10%'
                    WHEN discount <= 0.20 THEN '11–20%'
                    WHEN discount <= 0.30 THEN '21–30%'
                    ELSE '> 30%' END AS discount_band,
               count(*) AS orders,
               {_avg("profit_margin")} AS avg_margin_pct,
               {_money("profit")} AS total_profit,
               {_money("sales")} AS total_revenue
        FROM {{fact_sales}}
        GROUP BY 1
        ORDER BY avg_margin_pct DESC, discount_band""",
    "monthly_trend": f"""
        SELECT CAST(d.year AS BIGINT) AS year,
               CAST(d.month AS BIGINT) AS month,
               CAST(d.quarter AS BIGINT) AS quarter,
               {_money("f.sales")} AS revenue,
               {_money("f.profit")} AS profit,
               {_avg("f.profit_margin")} AS margin_pct
        FROM {{fact_sales}} f JOIN {{dim_date}} d ON f.order_date = d.date_key
        GROUP BY d.year, d.month, d.quarter
        ORDER BY d.year, d.month""",
    "top_products": f"""
        SELECT p.product_name, p.category, p.sub_category,
               CAST(round(revenue, 2) AS DOUBLE) AS total_revenue,
               CAST(round(profit, 2) AS DOUBLE) AS total_profit,
               round(margins / times_sold * 100, 2) AS avg_margin_pct,
               times_sold
        FROM (SELECT product_id, sum(sales) AS revenue, sum(profit) AS profit,
                     sum(profit_margin) AS margins, count(*) AS times_sold
              FROM {{fact_sales}} GROUP BY product_id) f
        JOIN {{dim_product}} p ON f.product_id = p.product_id
        ORDER BY total_profit DESC, f.product_id
        LIMIT 15""",
    "loss_products": f"""
        SELECT p.product_name, p.category,
               CAST(round(profit, 2) AS DOUBLE) AS total_profit,
               round(CAST(discounts AS DOUBLE) / times_sold * 100, 2) AS avg_discount_pct,
               times_sold
        FROM (SELECT product_id, sum(profit) AS profit, sum(discount) AS discounts,
                     count(*) AS times_sold
              FROM {{fact_sales}} GROUP BY product_id
              HAVING round(sum(profit), 2) < 0) f
        JOIN {{dim_product}} p ON f.product_id = p.product_id
        ORDER BY total_profit, f.product_id
        LIMIT 15""",
    "customer_clv": f"""
        SELECT customer_id, c.customer_name, c.segment, total_orders,
               CAST(round(revenue, 2) AS DOUBLE) AS total_revenue,
               CAST(round(profit, 2) AS DOUBLE) AS total_profit,
               round(margins / lines * 100, 2) AS avg_margin_pct,
               first_order, last_order
        FROM (SELECT customer_id, count(DISTINCT order_id) AS total_orders,
                     sum(sales) AS revenue, sum(profit) AS profit,
                     sum(profit_margin) AS margins, count(*) AS lines,
                     min(order_date) AS first_order, max(order_date) AS last_order
              FROM {{fact_sales}} GROUP BY customer_id)
        JOIN {{dim_customer}} c USING (customer_id)
        ORDER BY total_profit DESC, customer_id
        LIMIT 20""",
    "region_channel": f"""
        SELECT g.region, f.channel,
               {_money("f.sales")} AS revenue,
               {_money("f.profit")} AS profit,
               count(DISTINCT f.order_id) AS orders
        FROM {{fact_sales}} f JOIN {{dim_geography}} g ON f.geo_key = g.geo_key
        GROUP BY g.region, f.channel
        ORDER BY g.region, profit DESC""",
    "shipping": f"""
        SELECT ship_mode,
               {_avg("ship_days", 1, 1)} AS avg_ship_days,
               count(*) AS orders,
               {_money("profit")} AS total_profit,
               {_avg("profit_margin")} AS avg_margin_pct
        FROM {{fact_sales}}
        GROUP BY ship_mode
        ORDER BY avg_ship_days, ship_mode""",
}


def run_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame]) -> DataFrame:
    """SQL text over named tables: ``{name}`` stands for the table of that name."""
    used = {name: df for name, df in tables.items() if "{" + name + "}" in sql}
    return spark.sql(sql, **used)


def ask(spark: SparkSession, question: str, star: dict[str, DataFrame]) -> DataFrame:
    return run_sql(spark, QUESTIONS[question], star)


def rfm_scores(
    fact: DataFrame, customers: DataFrame, buckets: int = 5, top: int | None = 20
) -> DataFrame:
    """Recency, frequency and monetary tiles per customer, with the named segment.

    Tiles begin at values selected by counting: SQL ``NTILE`` without a partition key would sort
    all customers in one task.
    """
    latest = fact.select(F.max("order_date")).scalar()
    base = fact.groupBy("customer_id").agg(
        F.datediff(latest, F.max("order_date")).cast("bigint").alias("recency_days"),
        F.countDistinct("order_id").alias("frequency"),
        money("sales").alias("monetary"),
    )
    scored = base.join(customers.select("customer_id", "segment"), "customer_id")
    scored = storage.stage(scored, "rfm")
    tiles = {"r_score": ("recency_days", True), "f_score": ("frequency", False), "m_score": ("monetary", False)}
    for name, (value, descending) in tiles.items():
        scored = windows.tiles(scored, buckets, value, ["customer_id"], name, descending)
    r, f = F.col("r_score"), F.col("f_score")
    scored = scored.withColumns(
        {
            "rfm_total": r + f + F.col("m_score"),
            "rfm_segment": F.when((r >= 4) & (f >= 4), "Champions")
            .when((r >= 3) & (f >= 3), "Loyal")
            .when((r >= 3) & (f <= 2), "Potential Loyalist")
            .when((r <= 2) & (f >= 3), "At Risk")
            .otherwise("Need Attention"),
        }
    )
    if top is None:
        return scored
    return scored.orderBy(F.col("rfm_total").desc(), "customer_id").limit(top)
