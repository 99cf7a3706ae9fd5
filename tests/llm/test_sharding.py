from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from marginalia.llm import sharding
from marginalia.llm.queries import QUERIES
from tests.llm.frames import TEXT, awkward, documents

SF = "/root/testdata/sf0.01"


def check(rows, texts, shards):
    """Every document once, slots gapless; returns shard sums."""
    assert Counter((row.doc_id, row.text_crc32, row.size) for row in rows) == Counter(
        (key, zlib.crc32((text or "").encode()), len((text or "").encode()) + 1) for key, text in texts
    )
    slots, sums = defaultdict(list), np.zeros((shards, 3))
    for row in rows:
        slots[row.shard].append(row.slot)
        sums[row.shard] += (row.size, row.tokens, 1)
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    return sums


def test_documents(spark):
    texts = [(row.doc_id, row.text) for row in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op3_sharding"](spark, SF).collect()
    sums = check(rows, texts, 16)
    assert (sums[:, 0].max() - sums[:, 0].min()) / sums[:, 0].mean() < 0.02
    assert (abs(sums / sums.mean(0) - 1) < 0.1).all()
    homes = defaultdict(set)
    for row in rows:
        homes[row.text_crc32, row.size].add(row.shard)
    assert all(len(found) == 1 for found in homes.values())
    assert {row.law for row in rows} == {"bytes"} and {row.grown_shard for row in rows} == {None}


@pytest.mark.parametrize("cells", [4096, 8])
def test_hot_groups_are_split_only_over_capacity(spark, cells):
    texts = [(i, "same text of a third of all rows") for i in range(500)]
    texts += [(1000 + i, "a smaller group") for i in range(60)]
    texts += [(2000 + i, f"text {i} " + "word " * (i % 13)) for i in range(1000)]
    rows = sharding.shard(documents(spark, texts), 8, cells=cells).collect()
    sums = check(rows, texts, 8)
    homes = defaultdict(set)
    for row in rows:
        homes[row.text_crc32].add(row.shard)
    assert len(homes[zlib.crc32(b"same text of a third of all rows")]) > 1
    assert len(homes[zlib.crc32(b"a smaller group")]) == 1
    if cells == 4096:
        assert (abs(sums / sums.mean(0) - 1) < 0.1).all()


def test_awkward_rows(spark):
    rows = awkward([(1, "One two"), (2, "x" * 5000), (3, "ü 中")])
    docs = documents(spark, rows).selectExpr("*", "1 AS shard", "2 AS size", "3 AS rows", "4 AS number", "5 AS `group`")
    found = sharding.shard(docs, 4).collect()
    check(found, rows, 4)
    assert sharding.shard(spark.createDataFrame([], TEXT), 4).count() == 0


def test_place_takes_the_highest_dot_product():
    items = np.random.default_rng(4).random((40, 3)) * 9
    capacity = items.sum(0) / 3
    shards = sharding.place(items, 3, capacity)
    residual = np.ones((3, 3))
    for number in np.argsort(-(items / capacity).max(1), kind="stable"):
        need = items[number] / capacity
        scores = [8 * r[0] * need[0] + r[1] * need[1] + r[2] * need[2] for r in residual]
        assert scores[shards[number]] == max(scores)
        residual[shards[number]] -= need
