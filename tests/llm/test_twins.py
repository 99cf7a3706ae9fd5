"""Queries that SQL can express, against their DuckDB twins."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from marginalia.llm.oracles import ORACLES
from marginalia.llm.queries import QUERIES
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, name):
    duck = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    twin = duck.execute(ORACLES[name])
    names = [item[0] for item in twin.description]
    found = QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == sorted(names)
    rows = sorted((tuple(row) for row in found.select(*names).collect()), key=str)
    assert rows and rows == sorted(twin.fetchall(), key=str)
