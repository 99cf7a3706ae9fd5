"""Model inputs that are plain queries: elasticity, reorder points, labels, splits, forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.columns import clip, key_mix, mean, numeric_key, one_row
from marginalia.operators.aggregates import monthly_series, value_counts
from marginalia.operators.windows import lag_features, lowest_draws, rank_by_draw


def with_unit_price(lines: DataFrame) -> DataFrame:
    units = F.greatest(F.col("quantity"), F.lit(1))
    price = F.col("sales").cast("double") / units
    return lines.withColumn("unit_price", price)


def log_at_least(value: Column, least: float) -> Column:
    return F.ln(clip(value.cast("double"), lower=least))


def elasticity_overall(lines: DataFrame) -> DataFrame:
    """Slope of log quantity on log mean price across sub-categories."""
    known = with_unit_price(lines).where(F.col("sub_category").isNotNull())
    points = known.groupBy("sub_category").agg(
        F.avg("unit_price").alias("price"), F.sum("quantity").alias("quantity")
    )
    x, y = log_at_least(F.col("price"), 0.01), log_at_least(F.col("quantity"), 1.0)
    return points.agg(F.regr_slope(y, x).alias("elasticity"))


def elasticity(
    lines: DataFrame, group: str = "sub_category", min_points: int = 4, min_sd: float = 0.01
) -> DataFrame:
    """Log-log slope per group over calendar months.

    Groups with too few months or hardly any price movement are left out.
    """
    known = with_unit_price(lines).dropna(subset=[group, "order_month"])
    months = known.groupBy(group, "order_month").agg(
        F.avg("unit_price").alias("price"), F.sum("quantity").alias("quantity")
    )
    logs = months.select(
        group,
        log_at_least(F.col("price"), 0.01).alias("lp"),
        log_at_least(F.col("quantity"), 1.0).alias("lq"),
    )
    fits = logs.groupBy(group).agg(
        F.regr_slope("lq", "lp").alias("elasticity"),
        F.count("*").alias("_points"),
        F.stddev_samp("lp").alias("_sd"),
    )
    enough = (F.col("_points") >= min_points) & (F.col("_sd") > min_sd)
    return fits.where(enough).drop("_points", "_sd")


def top_categories(lines: DataFrame, top: int = 8) -> DataFrame:
    """The sub-categories with the most lines; ties go to the first name."""
    return value_counts(lines, "sub_category").limit(top)


def in_top_categories(lines: DataFrame, top: int = 8) -> DataFrame:
    return lines.join(top_categories(lines, top), "sub_category", "left_semi")


def reorder_points(lines: DataFrame, top: int = 8, z: float = 1.65) -> DataFrame:
    """Safety stock and reorder point of the busiest sub-categories.

    The demand columns are means and deviations per order line, as the report defines them.
    Each sub-category is reduced to one row before the top ones are kept.
    """
    known = lines.where(F.col("sub_category").isNotNull())
    demand = known.groupBy("sub_category").agg(
        F.count("*").alias("_lines"),
        mean("quantity").alias("avg_monthly_demand"),
        F.stddev_samp("quantity").alias("std_demand"),
    )
    busiest = demand.orderBy(F.col("_lines").desc(), "sub_category").limit(top).drop("_lines")
    stocked = busiest.withColumn("safety_stock", F.bround(F.col("std_demand") * z, 0))
    point = F.bround(F.col("avg_monthly_demand") + F.col("safety_stock"), 0)
    return stocked.withColumn("reorder_point", point)


def monthly_demand(lines: DataFrame) -> DataFrame:
    """Mean and deviation of true monthly totals per sub-category."""
    monthly = monthly_series(lines.where(F.col("sub_category").isNotNull()), ["sub_category"])
    return monthly.groupBy("sub_category").agg(
        mean("quantity").alias("mean_month_qty"), F.stddev_samp("quantity").alias("std_month_qty")
    )


def revenue_lags(lines: DataFrame) -> DataFrame:
    monthly = monthly_series(lines).select("period", "month_no", "order_month", "revenue")
    lagged = lag_features(monthly, "revenue", "month_no", [1, 3, 12])
    return lagged.withColumnRenamed("order_month", "month_num")


def residual_lags(lines: DataFrame) -> DataFrame:
    monthly = monthly_series(lines).select("period", "month_no", "order_month", "revenue")
    lagged = lag_features(monthly, "revenue", "month_no", [1, 3])
    return lagged.withColumnRenamed("order_month", "month_num")


def demand_lags(lines: DataFrame, calendar: bool = False) -> DataFrame:
    known = lines.where(F.col("sub_category").isNotNull())
    monthly = monthly_series(known, ["sub_category"])
    monthly = monthly.select("sub_category", "month_no", "order_month", "quantity")
    lagged = lag_features(
        monthly, "quantity", "month_no", [1, 2, 3], ["sub_category"], 3, calendar
    )
    return lagged.withColumnRenamed("order_month", "month_num")


def return_noise(lines: DataFrame) -> Column:
    """A number in [0, 1) that depends on the line's keys alone."""
    types = dict(lines.dtypes)
    order, product = numeric_key(types, "order_id"), numeric_key(types, "product_id")
    return key_mix(order, product, 7919, 104729, 1000) / F.lit(1000.0)


def return_label(lines: DataFrame) -> DataFrame:
    """Return flag: deep discounts and clear losses raise the odds, keyed noise decides."""
    deep = (F.col("discount") > 0.3).cast("double")
    losing = (F.col("profit_margin") < -0.1).cast("double")
    odds = clip(0.3 * deep + 0.2 * losing + 0.1 * return_noise(lines), 0.0, 1.0)
    return lines.withColumn("returned", (odds > 0.35).cast("int"))


def shuffle_key(keys: list[str]) -> Column:
    """A fixed pseudo-random 32-bit number per key, the order of every split."""
    text = F.concat_ws("|", *[F.col(key).cast("string") for key in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def stratified_split(
    df: DataFrame, keys: list[str], label: str, test_share: float = 0.2
) -> DataFrame:
    """Train/test flag with the exact share of every class.

    The rows of a class with the lowest hashes of their keys are its test rows. The hash that
    parts them is found from counts, so no rows are sorted and a class may hold most of them.
    """
    keyed = df.withColumn("_draw", shuffle_key(keys))
    return lowest_draws(keyed, [label], "_draw", keys, test_share, "is_test").drop("_draw")


def stratified_folds(
    df: DataFrame, keys: list[str], label: str, folds: int = 5
) -> DataFrame:
    """Fold number per row with the classes spread evenly over the folds."""
    keyed = df.withColumn("_draw", shuffle_key(keys))
    ranked = rank_by_draw(keyed, [label], "_draw", keys, "_rank")
    fold = F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("bigint")
    return ranked.withColumn("fold", fold).drop("_draw", "_rank")


def hash_split(df: DataFrame, keys: list[str], test_share: float = 0.2) -> DataFrame:
    """Train/test flag by a hash of the row's key: no shuffle, stable under re-runs."""
    is_test = (F.pmod(shuffle_key(keys), F.lit(1000)) < int(test_share * 1000)).cast("int")
    return df.withColumn("is_test", is_test)


def chronological_split(df: DataFrame, order_col: str, train_share: float = 0.8) -> DataFrame:
    """Train/test flag by position in time of a month series, one row per month."""
    position = F.row_number().over(Window.orderBy(order_col)) - 1
    rows = F.count("*").over(Window.partitionBy())
    is_test = (position >= F.floor(rows * train_share)).cast("int")
    return df.withColumn("is_test", is_test)


def seasonal_forecast(
    series: DataFrame, horizon: int = 12, by: list[str] | None = None
) -> DataFrame:
    """Linear trend times a multiplicative month index, for months after the last one.

    ``series`` has month_no (year * 12 + month - 1), order_month and revenue. The trend is a
    least-squares line; the index of a month is the mean ratio of actual to trend.
    """
    by = by or []
    trend = series.groupBy(*by).agg(
        F.regr_slope("revenue", "month_no").alias("slope"),
        F.regr_intercept("revenue", "month_no").alias("intercept"),
        F.max("month_no").alias("last_month"),
    )
    line = F.col("intercept") + F.col("slope") * F.col("month_no")
    if by:
        fitted = series.join(trend, by)
    else:
        fitted = series.withColumn("_trend", one_row(trend)).select("*", "_trend.*")
    seasons = fitted.groupBy(*by, "order_month").agg(
        F.avg(F.try_divide(F.col("revenue"), line)).alias("season")
    )
    ahead = F.sequence(F.col("last_month") + 1, F.col("last_month") + horizon)
    future = trend.select(*by, "slope", "intercept", F.explode(ahead).alias("month_no"))
    month = (F.pmod("month_no", F.lit(12)) + 1).cast("int")
    future = future.withColumn("order_month", month)
    # A month of the year never seen keeps the plain trend.
    forecast = future.join(seasons, [*by, "order_month"], "left")
    forecast = forecast.withColumn("season", F.coalesce("season", F.lit(1.0)))
    year = F.floor(F.col("month_no") / 12).cast("int")
    return forecast.select(
        *by,
        F.make_date(year, F.col("order_month"), F.lit(1)).alias("period"),
        line.alias("trend"),
        "season",
        (line * F.col("season")).alias("forecast"),
    )
