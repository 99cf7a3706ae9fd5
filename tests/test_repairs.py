"""Rows without scores, lines counted once, keys of many parts."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marginalia.operators import aggregates, clean, evaluate
from marginalia.sources import retail

SCORED = [(1, 0.9), (0, 0.8), (1, 0.4), (1, None), (0, None)]


def test_rows_without_a_score_are_in_no_bin_and_no_curve(spark):
    scored = spark.createDataFrame(SCORED, "label int, score double")
    known = scored.where("score IS NOT NULL")
    for build in (evaluate.lift_table, evaluate.roc_curve, evaluate.pr_curve, evaluate.roc_auc):
        assert sorted(map(str, build(scored).collect())) == sorted(map(str, build(known).collect()))
    top = evaluate.lift_table(scored).first()
    assert top.lift == pytest.approx(1.5) and top.decile is not None


def test_curves_have_their_end_points(spark):
    scored = spark.createDataFrame(SCORED, "label int, score double")
    ends = evaluate.roc_curve(scored).where("threshold IS NULL").collect()
    assert [(row.fpr, row.tpr) for row in ends] == [(0.0, 0.0)]
    ends = evaluate.pr_curve(scored).where("threshold IS NULL").collect()
    assert [(row.precision, row.recall) for row in ends] == [(1.0, 0.0)]


def test_recovery_of_the_union_counts_a_line_once(spark):
    rows = [
        (1, 1, dt.date(2020, 1, 1), 10.0, profit, 0.0, discount)
        for profit, discount in ((-5.0, 0.5), (-3.0, 0.0), (2.0, 0.4), (7.0, 0.1))
    ]
    columns = "order_id int, customer_id int, order_date date, sales double, profit double, profit_margin double, discount double"
    lines = spark.createDataFrame(rows, columns).withColumns(
        {name: F.col(name).cast("decimal(18,4)") for name in ("sales", "profit")}
    )
    row = aggregates.exec_snapshot(lines).first()
    assert (row.recoverable, row.over_discount_drain, row.distinct_recovery) == (8.0, 3.0, 6.0)


def test_row_keys_stay_unique_for_many_parts(spark, tmp_path):
    folder = str(tmp_path)
    one = "2020-01-01"
    frames = {
        "region": "SELECT 1L AS r_regionkey, 'R' AS r_name",
        "nation": "SELECT 1L AS n_nationkey, 1L AS n_regionkey, 'N' AS n_name",
        "customer": "SELECT 1L AS c_custkey, 1L AS c_nationkey, 'C' AS c_name, 'S' AS c_mktsegment",
        "orders": f"SELECT id AS o_orderkey, 1L AS o_custkey, DATE'{one}' AS o_orderdate, 'P' AS o_orderpriority FROM range(1, 3)",
        "part": "SELECT id AS p_partkey, 'p' AS p_name, 'Brand#1' AS p_brand FROM range(1, 1000003)",
        "lineitem": f"""SELECT o AS l_orderkey, p AS l_partkey, 1L AS l_linenumber, 1L AS l_suppkey,
            DATE'{one}' AS l_shipdate, 10D AS l_extendedprice, 0D AS l_discount, 1D AS l_quantity
            FROM VALUES (1L, 1000001L), (2L, 1L) AS t(o, p)""",
    }
    for name, text in frames.items():
        spark.sql(text).write.parquet(f"{folder}/{name}.parquet")
    lines = retail.order_lines(spark, folder)
    assert sorted(row.row_id for row in lines.collect()) == ["1-1000001", "2-1"]
    assert clean.check_unique(lines, ["row_id"], "row_id_unique").first().violations == 0


def test_the_sink_writes_the_fact_once(spark, monkeypatch):
    """The fact is as long as the lines: the sink's own table is the only copy of it."""
    from marginalia import storage
    from marginalia.plans import catalog

    labels, stage = [], storage.stage
    monkeypatch.setattr(storage, "stage", lambda df, label, *more: labels.append(label) or stage(df, label, *more))
    monkeypatch.setattr(retail, "_staged", {})
    rows = catalog.star_sink(spark, "/root/testdata/sf0.001").collect()
    assert "dim_geography" in labels and "fact_sales" not in labels
    assert sum(row.rows for row in rows) == retail.retail_lines(spark, "/root/testdata/sf0.001").count()
