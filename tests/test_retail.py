from __future__ import annotations

from marginalia.sources import retail
from tests.conftest import SMALL


def test_lines_are_staged_without_what_follows_from_other_columns(spark, lines):
    (folder,) = {file.rsplit("/", 1)[0] for file in lines.inputFiles()}
    staged = spark.read.parquet(folder)
    assert not set(retail.LATE) & set(staged.columns)
    whole = retail.order_lines(spark, SMALL)
    assert lines.dtypes == whole.dtypes
    assert sorted(map(str, lines.collect())) == sorted(map(str, whole.collect()))


def test_one_shuffle_of_the_lines_serves_copies_and_orders(spark):
    plan = retail.order_lines(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(l_orderkey" in line]
    assert len(dealt) == 1 and "l_partkey" not in dealt[0].split("hashpartitioning")[1].split(")")[0]
