"""Star schema: four dimensions, the sales fact and the contiguous calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.operators.windows import global_rank
from marginalia.sources.files import write_table

GEOGRAPHY = ["city", "state", "region", "postal_code"]

FACT_COLUMNS = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "ship_days", "customer_id",
    "product_id", "geo_key", "channel", "sales", "quantity", "discount", "profit",
    "profit_margin", "cost", "profit_per_unit", "is_profitable",
]


def first_row_per_key(lines: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Attributes of the first row (lowest row_id, then lowest values) of each key.

    The attributes nearly follow from the key, so grouping on key and attributes leaves about
    one row per key using hash aggregation alone; picking the first is then cheap.
    """
    variants = lines.groupBy(key, *columns).agg(F.min("row_id").alias("_first"))
    order = F.struct("_first", *columns)
    firsts = variants.groupBy(key).agg(F.min_by(F.struct(*columns), order).alias("_row"))
    return firsts.select(key, *[F.col(f"_row.{name}").alias(name) for name in columns])


def first_present_per_key(lines: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per column, the first non-null value (by row_id) of each key."""
    variants = lines.groupBy(key, *columns).agg(F.min("row_id").alias("_first"))
    picks = [
        F.min_by(name, F.when(F.col(name).isNotNull(), F.struct("_first", name))).alias(name)
        for name in columns
    ]
    return variants.groupBy(key).agg(*picks)


def dim_customer(lines: DataFrame) -> DataFrame:
    return first_row_per_key(lines, "customer_id", ["customer_name", "segment"])


def dim_product(lines: DataFrame) -> DataFrame:
    return first_row_per_key(lines, "product_id", ["product_name", "category", "sub_category"])


def dim_geography(lines: DataFrame) -> DataFrame:
    """Distinct places with a 1-based key in sorted order."""
    places = lines.select(*GEOGRAPHY).distinct()
    order = [F.col(name).asc_nulls_first() for name in GEOGRAPHY]
    return global_rank(places, order, "geo_key").select("geo_key", *GEOGRAPHY)


def dim_date(lines: DataFrame) -> DataFrame:
    """One row per date that occurs as an order date."""
    dates = lines.select(F.col("order_date").alias("date_key")).distinct()
    return dates.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.quarter("date_key").alias("quarter"),
        F.month("date_key").alias("month"),
        F.dayofmonth("date_key").alias("day"),
        F.weekday("date_key").alias("dayofweek"),
        (F.weekday("date_key") >= 5).cast("int").alias("is_weekend"),
    )


def attach_geo_key(lines: DataFrame, geography: DataFrame) -> DataFrame:
    """Left join on the four place columns, where NULL matches NULL."""
    places = geography.select("geo_key", *[F.col(c).alias(f"_{c}") for c in GEOGRAPHY])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in GEOGRAPHY]
    return lines.join(places, same, "left").drop(*[f"_{c}" for c in GEOGRAPHY])


def fact_sales(lines: DataFrame, geography: DataFrame) -> DataFrame:
    return attach_geo_key(lines, geography).select(*FACT_COLUMNS)


def dim_calendar(lines: DataFrame) -> DataFrame:
    """Every day from the first to the last order date."""
    span = lines.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("Date"))
    year, quarter = F.year("Date"), F.quarter("Date")
    return days.select(
        "Date",
        year.alias("Year"),
        quarter.alias("Quarter"),
        F.month("Date").alias("Month"),
        F.date_format("Date", "MMM").alias("MonthName"),
        F.weekofyear("Date").alias("WeekNum"),
        F.weekday("Date").alias("DayOfWeek"),
        F.date_format("Date", "EEEE").alias("DayName"),
        (F.weekday("Date") >= 5).cast("int").alias("IsWeekend"),
        F.concat(year.cast("string"), F.lit(" Q"), quarter.cast("string")).alias("QuarterLabel"),
    )


def star_schema(lines: DataFrame, stage) -> dict[str, DataFrame]:
    """The five warehouse tables; ``stage(name, build)`` decides where each is kept."""
    star = {
        name: stage(name, lambda build=build: build(lines))
        for name, build in {
            "dim_customer": dim_customer,
            "dim_product": dim_product,
            "dim_geography": dim_geography,
            "dim_date": dim_date,
        }.items()
    }
    star["fact_sales"] = stage("fact_sales", lambda: fact_sales(lines, star["dim_geography"]))
    return star


def write_star(star: dict[str, DataFrame], path: str) -> None:
    """The warehouse as parquet tables, the fact partitioned by order year."""
    for name, df in star.items():
        if name == "fact_sales":
            df = df.withColumn("order_year", F.year("order_date"))
            write_table(df, f"{path}/{name}", ["order_year"])
        else:
            write_table(df, f"{path}/{name}")
