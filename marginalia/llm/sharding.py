"""Shards balanced by bytes, tokens and rows: vector bin packing of groups of equal texts.

Each document has a size vector (UTF-8 bytes plus one, tokens, one row). Groups are equal texts.
What is placed is an item: a heavy group (over ``1 / CELLS`` of the total in some dimension), or
all light groups of one of ``CELLS`` hash cells, so the number of items has a fixed bound and
placing them needs bounded work. Items go, largest first, to the shard with the highest dot product of item
and residual capacity, in which bytes count ``WEIGHTS[0]`` times, so that bytes are equal first
where a large group makes the dimensions disagree; a residual below zero counts against a shard. A
group that exceeds a shard's capacity is cut into pieces; any other stays in one shard.

The items' sums are taken in Spark; the driver sees items only. Slots are numbered by cells too:
a heavy group is cut into cells of its own for that, so no task numbers a whole shard.

Defined cases: a null text is the group of empty texts with size 1; equal rows are documents of
their own; null ids are kept; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.storage import stage

CELLS = 4096
DIMENSIONS = ("size", "tokens", "rows")
WEIGHTS = np.array([8.0, 1.0, 1.0])


def place(items: np.ndarray, shards: int, capacity: np.ndarray) -> np.ndarray:
    """The shard of each item (rows of ``items``: size in each dimension)."""
    scaled = items / capacity
    residual = np.ones((shards, items.shape[1]))
    out = np.zeros(len(items), np.int64)
    for item in np.argsort(-scaled.max(1), kind="stable"):
        out[item] = int(np.argmax(residual @ (scaled[item] * WEIGHTS)))
        residual[out[item]] -= scaled[item]
    return out


def _measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
        F.monotonically_increasing_id().alias("row"),
    )


def shard(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS
) -> DataFrame:
    """(``doc_id``, ``size``, ``tokens``, ``text_crc32``, ``shard``, ``slot``) of each row.

    Slots of a shard are gapless from 0.
    """
    spark = docs.sparkSession
    rows = stage(_measured(docs, id_col, text_col), "sizes")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = np.array([value or 0 for value in rows.agg(*sums).first()], float)
    capacity = np.maximum(total / shards, 1)
    groups = rows.groupBy("group").agg(*sums)
    bars = [max(total[number] / cells, 1) for number in range(3)]
    over = F.expr(" OR ".join(f"{name} > {float(bar)!r}" for name, bar in zip(DIMENSIONS, bars, strict=True)))
    # At most one group per cell and dimension can be heavy.
    heavy = groups.filter(over).select("group", "size", "tokens", F.col("rows").alias("n")).toArrow().to_pydict()
    pieces, whole = [], []
    for size, tokens, n in zip(heavy["size"], heavy["tokens"], heavy["n"], strict=True):
        share = max(np.array([size, tokens, n]) / capacity)
        # A piece per half capacity if the group is too large for one shard, and slots by cells.
        pieces.append(max(1, math.ceil(n / bars[2])))
        whole.append(share <= 1)
    known = spark.createDataFrame(
        list(zip(heavy["group"], range(len(pieces)), pieces, strict=True)), "group long, number int, pieces int"
    )
    cell = F.when(
        F.col("number").isNull(), F.struct(F.lit(-1).alias("number"), F.pmod("group", F.lit(cells)).cast("int").alias("part"))
    ).otherwise(F.struct("number", F.pmod(F.xxhash64("doc_id", "row"), F.col("pieces")).cast("int").alias("part")))
    celled = rows.join(F.broadcast(known), "group", "left").withColumn("cell", cell).select(
        "doc_id", "size", "tokens", "text_crc32", "row", "cell.number", "cell.part"
    )
    # Light cells, heavy groups and their pieces: a bounded number of rows.
    counted = celled.groupBy("number", "part").agg(*sums).orderBy("number", "part").toPandas()
    vectors = counted[list(DIMENSIONS)].to_numpy(float).reshape(-1, 3)
    # A heavy group that fits is one item, all other cells are items of their own.
    keys = [
        (number, -1) if number >= 0 and whole[number] else (number, part)
        for number, part in zip(counted["number"], counted["part"], strict=True)
    ]
    names = {key: position for position, key in enumerate(dict.fromkeys(keys))}
    item = np.array([names[key] for key in keys], np.int64)
    items = np.zeros((len(names), 3))
    np.add.at(items, item, vectors)
    counted["shard"] = place(items, shards, capacity)[item] if len(items) else []
    counted["offset"] = counted.groupby("shard")["rows"].cumsum() - counted["rows"] if len(counted) else []
    layout = spark.createDataFrame(
        [tuple(map(int, row)) for row in counted[["number", "part", "shard", "offset"]].itertuples(index=False)],
        "number int, part int, shard int, offset long",
    )
    placed = celled.join(F.broadcast(layout), ["number", "part"])
    slot = F.expr("row_number() OVER (PARTITION BY number, part ORDER BY doc_id, row)") - 1
    return placed.select(
        "doc_id", "size", "tokens", "text_crc32", "shard", (F.col("offset") + slot).cast("long").alias("slot")
    )
