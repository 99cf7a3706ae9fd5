"""Business measures by month, quarter or year and any further grouping columns.

``by`` names the slicers, ``period`` the length of a period. Period-level results are small;
anything larger is grouped before it is windowed or joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.columns import divide_or_zero, mean, ratio, total
from marginalia.operators.aggregates import add_distinct
from marginalia.operators.windows import period_shift

# Columns of each period, and how many of them make a year.
PERIODS = {"month": ["order_year", "order_month"], "quarter": ["order_year", "order_quarter"], "year": ["order_year"]}
PER_YEAR = {"month": 12, "quarter": 4, "year": 1}

# Margin thresholds in percent and their colours.
MARGIN_COLOURS = [(15, "#06D6A0"), (5, "#FFB703")]
MARGIN_COLOUR_LOW = "#FF3A5C"


def _periods(by: list[str] | None, period: str | None) -> list[str]:
    return [*(PERIODS[period] if period else []), *(by or [])]


def core(lines: DataFrame, by: list[str] | None = None, period: str | None = "month") -> DataFrame:
    """Revenue, profit, orders, margin, order value and revenue per customer."""
    keys = _periods(by, period)
    sums = lines.groupBy(*keys).agg(
        total("sales").alias("total_revenue"), total("profit").alias("total_profit")
    )
    sums = add_distinct(sums, lines, keys, {"total_orders": "order_id", "customers": "customer_id"})
    revenue = F.col("total_revenue")
    return sums.withColumns(
        {
            "margin_pct": divide_or_zero(F.col("total_profit"), revenue) * 100,
            "avg_order_value": divide_or_zero(revenue, F.col("total_orders")),
            "revenue_per_customer": divide_or_zero(revenue, F.col("customers")),
        }
    ).drop("customers")


def _number(period: str) -> Column:
    """Periods since year 0, so that the period before is one less."""
    number = F.col("order_year").cast("bigint") * PER_YEAR[period]
    return number + F.col(PERIODS[period][1]) - 1 if period != "year" else number


def _per_period(lines: DataFrame, by: list[str], period: str, columns: dict[str, Column]) -> DataFrame:
    keys = PERIODS[period]
    sums = lines.groupBy(*keys, *by).agg(*[e.alias(n) for n, e in columns.items()])
    return sums.withColumn("period_no", _number(period).cast("bigint")).drop(*keys)


def _period_parts(df: DataFrame, period: str) -> DataFrame:
    many = PER_YEAR[period]
    parts = {"order_year": F.floor(F.col("period_no") / many).cast("int")}
    if many > 1:
        parts[PERIODS[period][1]] = (F.pmod("period_no", F.lit(many)) + 1).cast("int")
    return df.withColumns(parts).drop("period_no")


def growth(lines: DataFrame, by: list[str] | None = None, period: str = "month") -> DataFrame:
    """Profit growth on the previous period and revenue growth on the same period last year."""
    by = by or []
    sums = _per_period(lines, by, period, {"revenue": total("sales"), "profit": total("profit")})
    shifted = period_shift(
        sums, "period_no", by, {"_previous": ("profit", 1), "_last_year": ("revenue", PER_YEAR[period])}
    )
    profit, before = F.col("profit"), F.col("_previous")
    revenue, last_year = F.col("revenue"), F.col("_last_year")
    out = shifted.withColumns(
        {
            "profit_growth_mom_pct": ratio(profit - before, F.abs(before)) * 100,
            "revenue_growth_yoy_pct": ratio(revenue - last_year, last_year) * 100,
        }
    )
    return _period_parts(out.drop("_previous", "_last_year", "revenue", "profit"), period)


def running_revenue(lines: DataFrame, by: list[str] | None = None, period: str = "month") -> DataFrame:
    """Revenue up to and including each period; a window holds one row per period."""
    by = by or []
    sums = _per_period(lines, by, period, {"revenue": F.sum("sales")})
    so_far = Window.partitionBy(*by).orderBy("period_no")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = F.sum("revenue").over(so_far).cast("double")
    return _period_parts(sums.withColumn("running_revenue", running).drop("revenue"), period)


def _active_on(lines: DataFrame, by: list[str], days: int, period: str, ages: list[int]) -> DataFrame:
    """(period, ``active_{age}`` per age): customers whose last ``days`` days hold an order, on the day
    ``age`` days before each period's end. The last period ends with the last order date.

    A customer's orders merge into the intervals in which the customer is active. Each interval is
    one step up and one step down; steps are summed by date and then run over in date order, so
    what is ordered has one row per date, period and slicer, whatever the number of customers.
    """
    last = lines.select(F.max("order_date")).scalar()
    known = lines.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
    active = F.session_window(F.col("order_date").cast("timestamp"), f"{days} days").alias("_active")
    spans = known.groupBy("customer_id", *by, active).agg(F.count("*"))
    steps = F.array(
        F.struct(F.to_date("_active.start").alias("_date"), F.lit(1).alias("_step")),
        F.struct(F.to_date("_active.end").alias("_date"), F.lit(-1).alias("_step")),
    )
    steps = spans.select(*by, F.explode(steps).alias("_s")).groupBy(*by, "_s._date")
    steps = steps.agg(F.sum("_s._step").alias("_step"))
    starts = F.sequence(F.trunc(F.min("_date"), period), F.trunc(last, period), F.expr(f"interval {12 // PER_YEAR[period]} month"))
    # A slicer's first date is a step up, so it is a day with an order.
    starts = steps.groupBy(*by).agg(starts.alias("_starts")).select(*by, F.explode("_starts").alias("_start"))
    end = F.least(F.date_sub(F.add_months("_start", 12 // PER_YEAR[period]), 1), last)
    probes = F.array(*[F.struct(F.date_sub(end, age).alias("_date"), F.lit(age).alias("_age")) for age in ages])
    probes = starts.select(*by, "_start", F.explode(probes).alias("_p"))
    probes = probes.select(*by, "_p._date", F.lit(0).cast("bigint").alias("_step"), "_start", "_p._age")
    days_ = steps.withColumns({"_start": F.lit(None).cast("date"), "_age": F.lit(None).cast("int")}).unionByName(probes)
    until = Window.partitionBy(*by).orderBy("_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = days_.withColumn("_active", F.sum("_step").over(until)).where(F.col("_age").isNotNull())
    rows = counted.groupBy(*by, "_start").agg(
        *[F.max(F.when(F.col("_age") == age, F.col("_active"))).alias(f"active_{age}") for age in ages]
    )
    parts = {"order_year": F.year("_start"), "order_month": F.month("_start"), "order_quarter": F.quarter("_start")}
    keys = [parts[name].alias(name) for name in PERIODS[period]]
    return rows.select(*keys, *by, *[f"active_{age}" for age in ages])


def active_customers(
    lines: DataFrame, by: list[str] | None = None, days: int = 90, period: str = "month"
) -> DataFrame:
    """Distinct customers with an order in the ``days`` days up to the end of each period."""
    active = _active_on(lines, by or [], days, period, [0]).withColumnRenamed("active_0", "active_customers")
    return active.where("active_customers > 0")


def retention(
    lines: DataFrame, by: list[str] | None = None, days: int = 90, period: str = "month"
) -> DataFrame:
    """Active customers as a share of active plus previously active ones."""
    counts = _active_on(lines, by or [], days, period, [0, days])
    counts = counts.withColumnsRenamed({"active_0": "active_now", f"active_{days}": "active_previous"})
    both = F.col("active_now") + F.col("active_previous")
    return counts.where(both > 0).withColumn("retention_pct", divide_or_zero(F.col("active_now"), both) * 100)


def new_customers(lines: DataFrame, by: list[str] | None = None, period: str = "month") -> DataFrame:
    """Customers active in the period (the measure as written) and first-ever customers.

    One row per customer and period comes first; a customer's first period is then the lowest
    of at most as many rows as the calendar has periods.
    """
    by = by or []
    known = lines.where(F.col("customer_id").isNotNull())
    periods = known.select("customer_id", *by, _number(period).cast("bigint").alias("period_no")).distinct()
    history = Window.partitionBy("customer_id", *by)
    periods = periods.withColumn("_first", F.min("period_no").over(history))
    counts = periods.groupBy("period_no", *by).agg(
        F.count("*").alias("customers_in_period"),
        F.count_if(F.col("_first") == F.col("period_no")).alias("first_time_customers"),
    )
    return _period_parts(counts, period)


def average_clv(
    lines: DataFrame, by: list[str] | None = None, period: str | None = "month"
) -> DataFrame:
    """Mean over customers of their summed profit."""
    keys = _periods(by, period)
    customers = lines.groupBy(*keys, "customer_id").agg(F.sum("profit").alias("profit"))
    return customers.groupBy(*keys).agg(mean("profit").alias("avg_clv"))


def segment_share(
    lines: DataFrame,
    segments: DataFrame,
    label: str = "Champions",
    by: list[str] | None = None,
    period: str | None = "month",
) -> DataFrame:
    """Revenue share of the customers carrying a segment label.

    Lines shrink to one row per customer and period before the join.
    """
    keys = _periods(by, period)
    spent = lines.groupBy("customer_id", *keys).agg(F.sum("sales").alias("sales"))
    labelled = segments.select("customer_id", "segment_label")
    joined = spent.join(labelled, "customer_id", "left")
    chosen = F.sum(F.when(F.col("segment_label") == label, F.col("sales")))
    share = divide_or_zero(chosen, F.sum("sales")) * 100
    return joined.groupBy(*keys).agg(share.alias("segment_share_pct"))


def churn_risk(customers: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Customers at high churn risk and the mean churn probability."""
    by = by or []
    risky = F.when(F.col("churn_prob") >= 0.7, F.col("customer_id"))
    return customers.groupBy(*by).agg(
        F.countDistinct(risky).alias("high_risk_customers"),
        F.avg("churn_prob").alias("return_risk_score"),
    )


def segment_counts(customers: DataFrame, by: list[str] | None = None) -> DataFrame:
    keys = ["segment_label", *(by or [])]
    return customers.groupBy(*keys).agg(F.count("*").alias("customers"))


def operations(
    lines: DataFrame, by: list[str] | None = None, period: str | None = "month"
) -> DataFrame:
    """Shipping time, loss-making lines and discounts given.

    The loss share divides a count of lines by a count of orders, as the measure is defined.
    """
    given = F.col("sales") * F.col("discount")
    sums = lines.groupBy(*_periods(by, period)).agg(
        mean("ship_days").alias("avg_ship_days"),
        F.count_if(F.col("is_profitable") == 0).alias("loss_lines"),
        F.countDistinct("order_id").alias("_orders"),
        F.sum(given).cast("double").alias("discount_given"),
        total("sales").alias("_revenue"),
    )
    return sums.withColumns(
        {
            "loss_pct": divide_or_zero(F.col("loss_lines"), F.col("_orders")) * 100,
            "discount_pct": divide_or_zero(F.col("discount_given"), F.col("_revenue")) * 100,
        }
    ).drop("_orders", "_revenue")


def category_share(
    lines: DataFrame, by: list[str] | None = None, period: str | None = "month"
) -> DataFrame:
    """Profit of each category over the profit of all categories in the same context."""
    keys = _periods(by, period)
    profits = lines.groupBy(*keys, "category").agg(F.sum("profit").alias("profit"))
    everything = F.sum("profit").over(Window.partitionBy(*keys))
    share = divide_or_zero(F.col("profit"), everything) * 100
    return profits.withColumn("profit_share_pct", share).drop("profit")


def turnover(lines: DataFrame, by: list[str] | None = None, period: str = "month") -> DataFrame:
    """Quantity over the quantity one year earlier; NULL when there is none."""
    by = by or []
    sums = _per_period(lines, by, period, {"quantity": F.sum("quantity")})
    shifted = period_shift(sums, "period_no", by, {"_last_year": ("quantity", PER_YEAR[period])})
    out = shifted.withColumn("turnover", ratio(F.col("quantity"), F.col("_last_year")))
    return _period_parts(out.drop("_last_year"), period)


def flags(lines: DataFrame, by: list[str] | None = None, period: str = "month") -> DataFrame:
    """Margin colour and profit trend arrow per period."""
    by = by or []
    sums = _per_period(lines, by, period, {"revenue": total("sales"), "profit": total("profit")})
    shifted = period_shift(sums, "period_no", by, {"_previous": ("profit", 1)})
    before = F.col("_previous")
    margin = divide_or_zero(F.col("profit"), F.col("revenue")) * 100
    change = ratio(F.col("profit") - before, F.abs(before)) * 100
    colour = F.when(margin >= MARGIN_COLOURS[0][0], MARGIN_COLOURS[0][1])
    for threshold, shade in MARGIN_COLOURS[1:]:
        colour = colour.when(margin >= threshold, shade)
    text = F.when(change.isNull(), "").otherwise(F.format_string("%.1f", change))
    arrow = F.concat(F.when(change > 0, "▲ ").otherwise("▼ "), text, F.lit("%"))
    out = shifted.withColumns(
        {"margin_colour": colour.otherwise(MARGIN_COLOUR_LOW), "trend_arrow": arrow}
    )
    return _period_parts(out.drop("revenue", "profit", "_previous"), period)
