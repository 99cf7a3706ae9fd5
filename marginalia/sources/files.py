"""CSV and parquet sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia import storage

CSV_OPTIONS = {"header": "true", "escape": '"', "mode": "PERMISSIVE"}


def files_not_utf8(spark: SparkSession, path: str) -> DataFrame:
    """Paths (``file``) of the files that hold bytes UTF-8 cannot decode, as a staged table."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    bad = lines.where(~F.is_valid_utf8("value")).select("file").distinct()
    return storage.stage(bad, "not-utf8")


def read_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """All-text CSV scan. Each file is read as UTF-8 if it is valid UTF-8, else as Latin-1.

    Spark replaces undecodable bytes without complaint, so the encoding is settled first. The
    paths stay in a table: both readings are joined with it, and none is kept on the driver.
    """
    options = {**CSV_OPTIONS, **options}
    bad = files_not_utf8(spark, path)
    utf8 = spark.read.options(**options).csv(path)
    if bad.isEmpty():
        return utf8

    def rows(df: DataFrame, how: str) -> DataFrame:
        named = df.withColumn("_file", F.col("_metadata.file_path"))
        return named.join(bad.withColumnRenamed("file", "_file"), "_file", how).drop("_file")

    latin = spark.read.options(**options, encoding="ISO-8859-1").csv(path)
    return rows(utf8, "left_anti").unionByName(rows(latin, "left_semi"), allowMissingColumns=True)


def read_typed_csv(
    spark: SparkSession, path: str, schema, date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """CSV scan with a given schema; dates are parsed by the reader."""
    return spark.read.options(**CSV_OPTIONS, dateFormat=date_format).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", compression: str = "none") -> None:
    """CSV sink with a header in every part file. A compressed part is read by one task."""
    options = {
        "header": "true", "escape": '"', "dateFormat": "yyyy-MM-dd", "encoding": encoding, "compression": compression,
    }
    df.write.mode("overwrite").options(**options).csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet sink. Rebalancing splits a hot partition value and merges small files."""
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(
            *partition_by
        ).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


# Headers of the raw order-line file for the clean columns they feed.
RAW_HEADERS = {
    "row_id": "Row ID", "order_id": "Order ID", "order_date": "Order Date",
    "ship_date": "Ship Date", "ship_mode": "Ship Mode", "customer_id": "Customer ID",
    "customer_name": "Customer Name", "segment": "Segment", "city": "City", "state": "State",
    "postal_code": "Postal Code", "region": "Region", "product_id": "Product ID",
    "category": "Category", "sub_category": "Sub-Category", "product_name": "Product Name",
    "sales": "Sales", "quantity": "Quantity", "discount": "Discount", "profit": "Profit",
}


def export_raw_csv(lines: DataFrame, path: str, encoding: str = "UTF-8", compression: str = "none") -> None:
    """Order lines in the shape of the raw file: raw headers, month-first dates, text."""
    columns = []
    for name, header in RAW_HEADERS.items():
        value = F.col(name)
        if name in ("order_date", "ship_date"):
            value = F.date_format(value, "M/d/yyyy")
        columns.append(value.cast("string").alias(header))
    write_csv(lines.select(*columns), path, encoding, compression)
