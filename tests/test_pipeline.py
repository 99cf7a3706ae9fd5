"""From a raw CSV with text identifiers to every output table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marginalia.plans import pipeline
from marginalia.sources import files


@pytest.fixture(scope="module")
def output(spark, lines, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    text = lines.withColumns(
        {
            "order_id": F.concat(F.lit("US-"), F.col("order_id")),
            "customer_id": F.concat(F.lit("CU-"), F.col("customer_id")),
            "product_id": F.concat(F.lit("PR-"), F.col("product_id")),
        }
    )
    files.export_raw_csv(text, str(folder / "raw"))
    names = pipeline.run(spark, str(folder / "raw"), str(folder / "out"), rounds=3, trees=3)
    return names, str(folder / "out")


def test_every_table_is_written(spark, output):
    names, folder = output
    for name in names:
        is_csv = name.startswith(("marts/", "actions/"))
        df = files.read_csv(spark, f"{folder}/{name}") if is_csv else spark.read.parquet(f"{folder}/{name}")
        assert df.columns
        assert not df.isEmpty(), name


def test_text_keys_lose_no_customer(spark, lines, output):
    _, folder = output
    customers = lines.select("customer_id").distinct().count()
    for name in ("marts/customer", "actions/marketing"):
        assert files.read_csv(spark, f"{folder}/{name}").count() == customers
    near = spark.read.parquet(f"{folder}/models/neighbours")
    assert near.count() == customers * 10
    assert near.where(F.col("customer_id") == F.col("neighbour_id")).isEmpty()


def test_channels_keep_their_shares_with_text_keys(spark, output):
    _, folder = output
    fact = spark.read.parquet(f"{folder}/star/fact_sales")
    shares = {r.channel: r["count"] / fact.count() for r in fact.groupBy("channel").count().collect()}
    assert shares["website"] == pytest.approx(0.45, abs=0.03)
    assert shares["store"] == pytest.approx(0.25, abs=0.03)
