"""Every registered query against its DuckDB twin, values and all."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract
from marginalia.plans.catalog import QUERIES
from oracles.sql import ORACLES
from tests.conftest import SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    return repr(value) if isinstance(value, float) else str(value)


def sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rows = df.collect()
    assert rows, "no rows"
    if name not in ORACLES:
        return
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    result = duck.execute(ORACLES[name])
    columns = [item[0] for item in result.description]
    assert sorted(df.columns) == sorted(columns)
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    twins = {item[0]: str(item[1]) for item in result.description}
    for column, kind in df.dtypes:
        assert kinds.get(kind, kind.upper()) == twins[column], column
    assert sorted_rows(rows, df.columns) == sorted_rows(result.fetchall(), columns)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 3


def test_contract_holds_the_catalog():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_models_of_one_report_are_fitted_at_the_same_time(spark, monkeypatch):
    from threading import Barrier

    from marginalia.plans import catalog

    together = Barrier(3, timeout=20)
    monkeypatch.setattr(catalog, "fitted", lambda spark, sf_dir, name: together.wait())
    monkeypatch.setattr(catalog, "retail_lines", lambda spark, sf_dir: None)
    monkeypatch.setattr(catalog, "customer_table", lambda spark, sf_dir: None)
    catalog.fitted_side_by_side(spark, "unused", ("churn", "returns", "demand"))
