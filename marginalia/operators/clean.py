"""Cleaning: names, dates, numbers, derived columns, de-duplication, rule checks."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia import storage
from marginalia.functions.columns import (
    CHANNEL_SHARES,
    assign_bucket,
    clip,
    key_mix,
    numeric_key,
    ratio_or_zero,
)

# Texts read as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Date formats, each with an optional time of day.
TIME = "['T'HH:mm[:ss[.SSSSSS][.SSS]]][ H:mm[:ss[.SSSSSS][.SSS]]]"
DATE_FORMATS = [
    f"{date}{TIME}"
    for date in ("yyyy-MM-dd", "M/d/yyyy", "M-d-yyyy", "yyyy/M/d", "d MMM yyyy", "MMM d, yyyy")
]

# Money of the adapted tables, whose columns bound it, and of raw text.
MONEY = "decimal(18,4)"
RAW_NUMBER = "decimal(38,10)"

CLEAN_COLUMNS = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id",
    "customer_name", "segment", "city", "state", "region", "postal_code", "product_id",
    "category", "sub_category", "product_name", "sales", "quantity", "discount", "profit",
    "order_year", "order_month", "order_quarter", "order_dayofweek", "ship_days", "revenue",
    "profit_margin", "cost", "profit_per_unit", "is_profitable", "channel",
]
# Those that raw rows bring.
RAW_COLUMNS = CLEAN_COLUMNS[: CLEAN_COLUMNS.index("profit") + 1]


def normalise_names(df: DataFrame) -> DataFrame:
    """Column names trimmed, lower-cased, spaces and hyphens turned into underscores."""
    return df.toDF(*[re.sub(r"[ -]", "_", name.strip().lower()) for name in df.columns])


def null_tokens(df: DataFrame, tokens: list[str] = NULL_TOKENS) -> DataFrame:
    """Text columns with missing-value tokens replaced by NULL."""
    return df.select(
        *[
            F.when(~F.col(name).isin(tokens), F.col(name)).alias(name)
            if kind == "string"
            else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def parse_date(text: Column | str, formats: list[str] = DATE_FORMATS) -> Column:
    """The first format that fits; text no format fits becomes NULL."""
    return F.coalesce(*[F.try_to_date(F.trim(text), fmt) for fmt in formats])


def coerce_numeric(
    df: DataFrame, defaults: dict[str, float], types: dict[str, str] | None = None
) -> DataFrame:
    """Text columns cast to numbers; unreadable or missing values take the default.

    A number that does not fit the type is neither: it raises an error instead of becoming the
    default.
    """
    types = types or {}
    columns = {}
    for name, default in defaults.items():
        kind = types.get(name, MONEY)
        text = F.trim(F.col(name).cast("string"))
        value = text.try_cast(kind)
        lost = value.isNull() & text.try_cast("double").isNotNull() & ~F.isnan(text.try_cast("double"))
        error = F.raise_error(F.concat(F.lit(f"{name} does not fit {kind}: "), text))
        columns[name] = F.when(lost, error).otherwise(F.coalesce(value, F.lit(default).cast(kind)))
    return df.withColumns(columns)


def derived_columns(df: DataFrame) -> dict[str, Column]:
    """Calendar parts, shipping latency and the money ratios of each line, by name."""
    sales, profit, quantity = F.col("sales"), F.col("profit"), F.col("quantity")
    money = dict(df.dtypes)["sales"]
    return {
        "order_year": F.year("order_date"),
        "order_month": F.month("order_date"),
        "order_quarter": F.quarter("order_date"),
        "order_dayofweek": F.weekday("order_date"),
        "ship_days": F.datediff("ship_date", "order_date"),
        "revenue": sales,
        "profit_margin": ratio_or_zero(profit, sales),
        "cost": (sales - profit).cast(money),
        "profit_per_unit": ratio_or_zero(profit, quantity),
        "is_profitable": (profit > 0).cast("int"),
    }


def derive(df: DataFrame) -> DataFrame:
    return df.withColumns(derived_columns(df))


def assign_channel(df: DataFrame) -> DataFrame:
    """Sales channel by a keyed 45/30/25 draw, the same wherever the row is processed."""
    types = dict(df.dtypes)
    order, product = numeric_key(types, "order_id"), numeric_key(types, "product_id")
    draw = key_mix(order, product, 31, 17, 100)
    return df.withColumn("channel", assign_bucket(draw, CHANNEL_SHARES))


def dedup_keep_first(df: DataFrame, keys: list[str], order_cols: list) -> DataFrame:
    """The first row per key.

    The rank filter lets Spark keep one row per key in every map task before the shuffle, so
    a key holding a third of all rows still reaches its reducer as a few rows.
    """
    first = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def dedup_wide(df: DataFrame, keys: list[str], order_cols: list) -> DataFrame:
    """``dedup_keep_first`` for wide rows: only those whose key comes again are shuffled.

    The keys are counted first and those that repeat are written, so ``df`` is read twice and has to
    give the same rows each time. NULL is a key like any other.
    """
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    repeated = storage.stage(repeated.select(*(F.col(key).alias(f"_key{place}") for place, key in enumerate(keys))), "repeated-keys")
    same = reduce(Column.__and__, (F.col(key).eqNullSafe(F.col(f"_key{place}")) for place, key in enumerate(keys)))
    again = dedup_keep_first(df.join(repeated, same, "left_semi"), keys, order_cols)
    return df.join(repeated, same, "left_anti").unionByName(again)


def clean(raw: DataFrame, order_cols: list | None = None) -> DataFrame:
    """Raw all-text order lines to typed, de-duplicated, derived lines.

    Of rows with the same order and product the first stays: by row number, read as a number
    where it is one, then by all columns. Numbers keep all digits up to 28 before and 10 after the
    point. Columns the clean table does not name are carried along; named ones that are missing
    are NULL. Without a row number, the order and product name the row.
    """
    df = null_tokens(normalise_names(raw))
    given = df.columns
    absent = [name for name in RAW_COLUMNS if name not in given]
    df = df.withColumns({name: F.lit(None).cast("string") for name in absent})
    more = [name for name in given if name not in CLEAN_COLUMNS]
    number = F.expr("try_cast(row_id AS decimal(38, 0))")
    order = order_cols or [number.asc_nulls_last(), *sorted(given)]
    # Before any column is derived: the shuffle carries the raw columns only.
    df = dedup_wide(df, ["order_id", "product_id"], order)
    key = F.concat_ws("-", "order_id", "product_id")
    df = df.withColumn("row_id", F.coalesce(F.trim(F.col("row_id").cast("string")), key))
    df = df.withColumns({name: parse_date(name) for name in ("order_date", "ship_date")})
    numbers = {"sales": 0, "profit": 0, "quantity": 1, "discount": 0}
    df = coerce_numeric(df, numbers, dict.fromkeys(numbers, RAW_NUMBER))
    df = df.withColumn("discount", clip("discount", 0, 1).cast("decimal(12,10)"))
    df = assign_channel(derive(df.where(F.col("quantity") > 0)))
    return df.select(*CLEAN_COLUMNS, *more)


# Fixed rules: name -> violation test.
CLEAN_RULES = {
    "sales_not_negative": "sales < 0",
    "discount_in_range": "discount IS NULL OR discount < 0 OR discount > 1",
    "quantity_positive": "quantity <= 0",
    "order_date_present": "order_date IS NULL",
}


def validate(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per rule with its number of violations, from a single pass."""
    counts = df.agg(*[F.count_if(F.expr(test)).alias(name) for name, test in rules.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in rules)
    return counts.select(F.expr(f"stack({len(rules)}, {pairs}) AS (rule, violations)"))


def check_unique(df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """Primary-key check: the number of key values that occur more than once or are NULL."""
    missing = " OR ".join(f"{key} IS NULL" for key in keys)
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .agg(F.count_if(F.expr(f"_n > 1 OR {missing}")).alias("violations"))
        .select(F.lit(rule).alias("rule"), "violations")
    )


def check_reference(df: DataFrame, dim: DataFrame, key: str, rule: str) -> DataFrame:
    """Foreign-key check: the number of rows whose key has no match in the dimension."""
    keys = df.groupBy(key).agg(F.count("*").alias("_n"))
    return (
        keys.join(dim.select(key), key, "left_anti")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"))
        .select(F.lit(rule).alias("rule"), "violations")
    )


def profile_nulls(df: DataFrame) -> DataFrame:
    """Type, row count and null count of each column, from a single pass."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns],
    )
    cells = ", ".join(f"'{name}', '{kind}', _rows, `{name}`" for name, kind in df.dtypes)
    shape = "(column_name, data_type, row_count, null_count)"
    return counts.select(F.expr(f"stack({len(df.columns)}, {cells}) AS {shape}"))


def encode_ordinal(
    df: DataFrame, names: list[str], suffix: str = "_enc", combinations: DataFrame | None = None
) -> DataFrame:
    """Alphabetical 0-based codes of category columns; NULL stays NULL.

    The value combinations are found in one pass and written, so that the join of each code
    table is planned by its file size: a small one is broadcast and the rows stay in place.
    ``combinations`` may give them where they are written already.
    """
    if combinations is None:
        combinations = storage.stage(df.select(*names).distinct(), "categories")
    for name in names:
        values = combinations.select(name).where(F.col(name).isNotNull()).distinct()
        code = (F.row_number().over(Window.orderBy(name)) - 1).cast("bigint")
        df = df.join(values.withColumn(f"{name}{suffix}", code), name, "left")
    return df
