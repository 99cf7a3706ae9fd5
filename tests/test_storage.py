"""Staged tables: what a write leaves on the disks."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from marginalia import storage
from marginalia.llm.components import components


def test_a_staged_table_keeps_no_shuffle_files(spark, tmp_path):
    """Files of a job that is done are only in the way, however many such jobs follow."""
    root = Path(spark.sparkContext._temp_dir).parent.parent

    def shuffles():
        return set(root.glob("blockmgr-*/*/shuffle_*.data"))

    kept = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).count()
    kept.write.parquet(str(tmp_path / "plain"))
    before = shuffles()
    assert before
    staged = storage.stage(kept, "counts")
    for _ in range(50):
        if not shuffles() - before:
            break
        spark.range(100000).count()
    assert not shuffles() - before
    assert staged.count() == 100
    # Other jobs keep theirs, as a frame may be read again.
    assert spark.conf.get(storage.CLEANUP) == "false"


def test_components_keep_only_their_last_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_root", lambda _: str(tmp_path))
    chain = spark.range(1, 60).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    assert {(row.u, row.root) for row in components(chain).collect()} == {(node, 0) for node in range(1, 60)}
    assert len(list(tmp_path.glob("marginalia/*/*"))) == 1
