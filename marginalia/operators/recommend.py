"""Similar customers and what to offer them.

Neighbours are exact. Customers with the same purchases form one direction, so copies cost
nothing. Directions lie in blocks of a fixed size, rings around pivots, and a few blocks of one
pivot form an area whose neighbours one task searches. The work list is a table of ids: which
block an area has to see, and how near it can be by the triangle inequality. An area's blocks
stream through its task nearest first, only the k best of each query stay in memory, and what is
left is skipped as soon as no block can hold a nearer neighbour.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia import storage
from marginalia.operators.clean import encode_ordinal
from marginalia.operators.windows import rank_in_group

# Similarities equal to this many digits are ties, settled by the lower customer id.
SIMILARITY_DIGITS = 9
# Directions of a block, most blocks of an area, areas wanted before areas grow to that, pivots in
# all, and queries multiplied at a time. More data means more areas, never ones beyond the bound.
BLOCK_ROWS = 2048
AREA_BLOCKS = 32
LEAST_AREAS = 16
MAX_PIVOTS = 64
QUERY_ROWS = 4096
# Rows that are copied to the areas that have to see them at a time, and entries of neighbours'
# purchases that are added up at a time: what lies on the disks is bounded, more data takes more turns.
SEEN_ROWS, SEEN_ENTRIES = 1 << 22, 1 << 26
# Pairs multiplied in full at a time, and the share of all pairs from which all are at once.
PAIR_ROWS, DENSE = 1 << 16, 16


def purchase_vectors(bought: DataFrame) -> DataFrame:
    """One dense row of sales per customer, in the alphabetical order of sub-categories.

    A row is as long as the sub-category dimension, whatever the number of customers.
    """
    coded = encode_ordinal(bought, ["sub_category"], "_code")
    width = coded.select(F.max("sub_category_code")).scalar()
    entries = F.map_from_entries(
        F.collect_list(F.struct("sub_category_code", F.col("sales").cast("double").alias("sales")))
    )
    sparse = coded.groupBy("customer_id").agg(entries.alias("_sales"))
    sparse = sparse.withColumn("_codes", F.sequence(F.lit(0).cast("bigint"), width))
    dense = F.transform(
        "_codes",
        lambda code: F.coalesce(F.try_element_at("_sales", code), F.lit(0.0)),
    )
    return sparse.select("customer_id", dense.alias("amounts"))


def _directions(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct unit vectors with their first k + 1 customers, and each customer's direction.

    For anyone outside, only the k lowest ids of a set of equal customers can be among the k
    nearest; one more covers the members themselves. Keeping the first rows is done before
    the shuffle, so a set of copies holding a third of all customers stays small.
    """
    square = F.aggregate("amounts", F.lit(0.0), lambda total, x: total + x * x)
    placed = vectors.withColumn("_norm", F.sqrt(square)).where("_norm > 0")
    unit = F.transform("amounts", lambda x: x / F.col("_norm"))
    placed = placed.select("customer_id", unit.alias("vector"))
    order = Window.partitionBy("vector").orderBy("customer_id")
    first = placed.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= k + 1)
    directions = first.groupBy("vector").agg(
        F.min("customer_id").alias("direction"),
        F.sort_array(F.collect_list("customer_id")).alias("members"),
    )
    directions = storage.stage(directions, "directions")
    members = placed.join(directions.select("vector", "direction"), "vector")
    return directions, members.select("customer_id", "direction")


def _pivots(directions: DataFrame, count: int) -> np.ndarray:
    """A fixed, bounded choice of vectors to form cells around: the lowest key hashes."""
    rows = directions.orderBy(F.xxhash64("direction"), "direction").limit(count)
    return np.array([row.vector for row in rows.select("vector").collect()])


def _gaps(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of unit vectors."""
    return np.sqrt(np.maximum(2.0 - 2.0 * points @ pivots.T, 0.0))


def _reach(floor: np.ndarray) -> np.ndarray:
    """How far a neighbour of this similarity can be; slack covers rounding, so ties are seen."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (np.maximum(floor, -1.0) - 2e-9), 0.0)) + 1e-9


def _blocks(directions: DataFrame, pivots, block_rows: int, area_blocks: int) -> DataFrame:
    """(direction, vector, block, area): rings around the nearest pivot, cut by distance; staged."""
    key = dict(directions.dtypes)["direction"]

    def assign(batches):
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.iloc[start : start + 1024]
                gaps = _gaps(np.stack(part["vector"].to_numpy()), pivots.value)
                cell = gaps.argmin(axis=1)
                yield part.assign(cell=cell, gap=gaps[np.arange(len(cell)), cell])

    cells = directions.select("direction", "vector").mapInPandas(
        assign, f"direction {key}, vector array<double>, cell bigint, gap double"
    )
    ranked = rank_in_group(cells, ["cell"], ["gap", "direction"], "_rank")
    ring = F.floor((F.col("_rank") - 1) / block_rows)
    blocked = ranked.select(
        "direction",
        "vector",
        (F.col("cell") * 2**32 + ring).alias("block"),
        (F.col("cell") * 2**32 + F.floor(ring / area_blocks)).alias("area"),
    )
    return storage.stage(blocked, "blocks")


def _work_list(blocked: DataFrame, pivots, k: int) -> DataFrame:
    """(block, area, apart): the blocks each area has to see, with the least possible distance."""
    count = len(pivots.value)
    shape = "block bigint, area bigint, reach double, near array<double>, far array<double>"

    def describe(block: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(block["vector"].to_numpy())
        gaps = _gaps(points, pivots.value)
        floor = -1.0
        if len(points) >= k:
            for start in range(0, len(points), 256):
                near = np.round(points[start : start + 256] @ points.T, SIMILARITY_DIGITS)
                least = np.partition(near, -k, axis=1)[:, -k].min()
                floor = least if start == 0 else min(floor, least)
        row = block["block"].iloc[0], block["area"].iloc[0], _reach(np.array([floor]))[0], gaps.min(axis=0), gaps.max(axis=0)
        return pd.DataFrame([row], columns=["block", "area", "reach", "near", "far"])

    stats = storage.stage(blocked.groupBy("block").applyInPandas(describe, shape), "block-stats")
    bounds = [F.min(F.col("near")[i]) for i in range(count)] + [F.max(F.col("far")[i]) for i in range(count)]
    # One row per area of AREA_BLOCKS blocks, a few hundred bytes each.
    areas = stats.groupBy("area").agg(F.max("reach").alias("reach"), F.array(*bounds).alias("bounds")).toPandas()
    layout = blocked.sparkSession.sparkContext.broadcast(
        (areas["area"].to_numpy(), areas["reach"].to_numpy(), np.stack(areas["bounds"].to_numpy()))
    )

    def route(batches):
        names, reach, bounds = layout.value
        for batch in batches:
            for row in batch.itertuples():
                # |query - point| is at least the difference of their distances to any pivot.
                apart = np.maximum(bounds[:, :count] - row.far, row.near - bounds[:, count:]).max(axis=1)
                apart = np.maximum(apart, 0.0)
                seen = apart <= reach
                yield pd.DataFrame({"block": row.block, "area": names[seen], "apart": apart[seen]})

    return storage.stage(stats.mapInPandas(route, "block bigint, area bigint, apart double"), "work-list")


def _slack(width: int) -> float:
    """What products of unit vectors in single precision may be off by, and rounding besides."""
    return 2.0 * (width + 3) * float(np.finfo(np.float32).eps) + 1e-8


def _products(points: np.ndarray, others: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The products of the pairs, a bounded number at a time."""
    found = np.empty(len(row))
    for start in range(0, len(row), PAIR_ROWS):
        part = slice(start, start + PAIR_ROWS)
        found[part] = np.einsum("ij,ij->i", points[row[part]], others[column[part]])
    return found


def _best_pairs(points: np.ndarray, others: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each point's pairs of similarity ``floor`` or more, but for those that k others exceed."""
    near = np.round(points @ others.T, SIMILARITY_DIGITS)
    if len(others) > k:
        floor = np.maximum(floor, np.partition(near, -k, axis=1)[:, -k])
    row, column = np.nonzero(near >= floor[:, None])
    return row, column, near[row, column]


class _Best:
    """The k best candidates of an area's queries so far."""

    def __init__(self, names: np.ndarray, points: np.ndarray, k: int):
        self.names, self.points, self.k = names, points, k
        self.similarity = np.full((len(names), k), -np.inf)
        self.candidate = np.empty((len(names), k), names.dtype)
        self.rough = points.astype(np.float32)

    def reach(self) -> float:
        return float(_reach(self.similarity[:, -1]).max())

    def see(self, names: np.ndarray, points: np.ndarray) -> None:
        rough, slack = points.T.astype(np.float32), _slack(points.shape[1])
        for start in range(0, len(self.names), QUERY_ROWS):
            part = slice(start, start + QUERY_ROWS)
            # Only pairs that may be near enough are multiplied and rounded in full.
            floor = self.similarity[part, -1]
            maybe = self.rough[part] @ rough >= (floor - slack).astype(np.float32)[:, None]
            hit = np.flatnonzero(maybe.any(axis=1))
            row, column = np.nonzero(maybe[hit])
            row = hit[row]
            if DENSE * len(row) > maybe.size:
                row, column, near = _best_pairs(self.points[part], points, floor, self.k)
            else:
                near = np.round(_products(self.points[part], points, row, column), SIMILARITY_DIGITS)
                some = near >= floor[row]
                row, column, near = row[some], column[some], near[some]
            if not len(row):
                continue
            touched, place = np.unique(row, return_inverse=True)
            held = self.similarity[part][touched]
            owner = np.concatenate([np.repeat(np.arange(len(touched)), self.k), place])
            value = np.concatenate([held.ravel(), near])
            candidate = np.concatenate([self.candidate[part][touched].ravel(), names[column]])
            # Ties go to the lower id.
            order = np.lexsort((candidate, -value, owner))
            owner, value, candidate = owner[order], value[order], candidate[order]
            rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
            kept = rank < self.k
            rows, ranks = start + touched[owner[kept]], rank[kept]
            self.similarity[rows, ranks], self.candidate[rows, ranks] = value[kept], candidate[kept]

    def frame(self) -> pd.DataFrame:
        row, rank = np.nonzero(self.similarity > -np.inf)
        return pd.DataFrame(
            {"direction": self.names[row], "candidate": self.candidate[row, rank], "similarity": self.similarity[row, rank]}
        )


def _nearest_directions(
    directions: DataFrame, k: int, block_rows: int, area_blocks: int = AREA_BLOCKS
) -> DataFrame:
    """(direction, candidate, similarity): the k nearest directions of each, itself included."""
    spark = directions.sparkSession
    key = dict(directions.dtypes)["direction"]
    shape = f"direction {key}, candidate {key}, similarity double"
    count = directions.count()
    if count == 0:
        return spark.createDataFrame([], shape)
    # A small table has smaller areas, so that all tasks take part.
    area_blocks = min(area_blocks, max(1, count // (block_rows * LEAST_AREAS)))
    pivot_count = min(MAX_PIVOTS, max(1, count // (block_rows * area_blocks)))
    pivots = spark.sparkContext.broadcast(_pivots(directions, pivot_count))
    blocked = _blocks(directions, pivots, block_rows, area_blocks)
    work = _work_list(blocked, pivots, k)
    own = blocked.select("area", F.lit(-1.0).alias("apart"), "block", "direction", "vector")

    def search(batches):
        area, best, names, points = None, None, [], []

        def gathered():
            found = np.array([name for part in names for name in part]), np.concatenate(points)
            names.clear()
            points.clear()
            return found

        for batch in batches:
            # An area's own rows come first, then what it has to see, the nearest blocks first.
            for (*now, apart), part in batch.groupby(["area", "part", "apart"], sort=True):
                if now != area:
                    if best is not None:
                        yield best.frame()
                    area, best = now, None
                    # A part may have no blocks to see.
                    names.clear()
                    points.clear()
                if apart < 0:
                    names.append(part["direction"].tolist())
                    points.append(np.stack(part["vector"].to_numpy()))
                    continue
                if best is None:
                    best, reach = _Best(*gathered(), k), np.inf
                if apart <= reach:
                    for start in range(0, len(part), 1024):
                        some = part.iloc[start : start + 1024]
                        best.see(np.array(some["direction"].tolist()), np.stack(some["vector"].to_numpy()))
                    reach = best.reach()
        if best is not None:
            yield best.frame()

    def turn(areas: list[tuple[int, int]]) -> DataFrame:
        # With few areas, what each has to see is dealt to several tasks, whose best are compared.
        parts = min(max(blocks for _, blocks in areas), math.ceil(spark.sparkContext.defaultParallelism / len(areas)))
        mine = F.col("area").between(areas[0][0], areas[-1][0])
        numbers = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        queries = own.where(mine).withColumn("part", numbers)
        part = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")
        seen = blocked.drop("area").join(work.where(mine), "block").withColumn("part", part).select(*queries.columns)
        order = ["area", "part", "apart", "block", "direction"]
        dealt = queries.unionByName(seen).repartition(len(areas) * parts, "area", "part").sortWithinPartitions(*order)
        near = dealt.mapInPandas(search, shape)
        if parts == 1:
            return near
        best = F.sort_array(F.collect_list(F.struct((-F.col("similarity")).alias("far"), "candidate")))
        best = near.groupBy("direction").agg(F.slice(best, 1, k).alias("best")).select("direction", F.explode("best").alias("item"))
        return best.select("direction", F.col("item.candidate").alias("candidate"), (-F.col("item.far")).alias("similarity"))

    # A row per area.
    areas = [(row.area, row.blocks) for row in work.groupBy("area").agg(F.count("*").alias("blocks")).orderBy("area").collect()]
    turns = _turns(areas, max(SEEN_ROWS, 2 * count) // block_rows)
    if len(turns) == 1:
        return turn(turns[0])
    # The copies of a turn are gone when its result is written.
    return reduce(DataFrame.unionByName, [storage.stage(turn(some), "nearest") for some in turns])


def _turns(areas: list[tuple[int, int]], most: int) -> list[list[tuple[int, int]]]:
    """(area, blocks) in groups of ``most`` blocks, or one area that has more."""
    turns, held = [[]], 0
    for area, blocks in areas:
        if turns[-1] and held + blocks > most:
            turns.append([])
            held = 0
        turns[-1].append((area, blocks))
        held += blocks
    return turns


def similar_customers(
    bought: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS, area_blocks: int = AREA_BLOCKS
) -> DataFrame:
    """The k customers with the most similar purchases (cosine), for every customer.

    Ties go to the lower id. Customers whose purchases sum to nothing have no direction and
    no neighbours.
    """
    directions, members = _directions(purchase_vectors(bought), k)
    near = _nearest_directions(directions, k + 1, block_rows, area_blocks)
    offered = near.join(
        directions.select(F.col("direction").alias("candidate"), "members"), "candidate"
    )
    offered = offered.select(
        "direction", "similarity", F.explode("members").alias("neighbour_id")
    )
    # At most (k + 1) squared rows per direction; the best k + 1 serve all its members.
    ranked = F.sort_array(
        F.collect_list(F.struct((-F.col("similarity")).alias("far"), "neighbour_id"))
    )
    lists = offered.groupBy("direction").agg(F.slice(ranked, 1, k + 1).alias("best"))
    mine = members.join(lists, "direction")
    others = F.slice(
        F.filter("best", lambda item: item["neighbour_id"] != F.col("customer_id")), 1, k
    )
    rows = mine.select("customer_id", F.posexplode(others).alias("position", "item"))
    return rows.select(
        "customer_id",
        F.col("item.neighbour_id").alias("neighbour_id"),
        (-F.col("item.far")).alias("similarity"),
        (F.col("position") + 1).cast("bigint").alias("rank"),
    )


def unbought(bought: DataFrame) -> DataFrame:
    """The sub-categories each customer has not bought.

    The list of all names is a scalar, as long as the sub-category dimension.
    """
    everything = bought.agg(F.collect_set("sub_category")).scalar()
    owned = F.collect_set(F.when(F.col("sales") > 0, F.col("sub_category")))
    customers = bought.groupBy("customer_id").agg(owned.alias("_mine"))
    rest = F.array_except(everything, F.col("_mine"))
    return customers.select("customer_id", F.explode(rest).alias("sub_category"))


def recommend(bought: DataFrame, neighbours: DataFrame, top: int = 5) -> DataFrame:
    """Unbought sub-categories ranked by the neighbours' sales weighted by similarity.

    Items no neighbour bought stay in the ranking with score zero.
    """
    # A row per customer: a neighbour's purchases travel as one row, not as one per sub-category.
    coded = encode_ordinal(bought, ["sub_category"], "_code").where(F.col("sub_category").isNotNull())
    items = F.collect_list(F.struct(F.col("sub_category_code").cast("int").alias("code"), F.col("sales").cast("double").alias("sales")))
    lists = coded.groupBy(F.col("customer_id").alias("neighbour_id")).agg(items.alias("items"))
    lists = storage.stage(lists.select("neighbour_id", F.col("items.code").alias("codes"), F.col("items.sales").alias("sales")), "purchase-lists")
    names = F.lit(bought.agg(F.array_sort(F.collect_set("sub_category"))).scalar())
    size = lists.agg(F.sum(F.size("codes")).alias("entries"), F.count("*").alias("customers")).first()
    turns = math.ceil(neighbours.count() * (size.entries or 0) / max(size.customers, 1) / SEEN_ENTRIES)

    def turn(near: DataFrame, offers: DataFrame) -> DataFrame:
        seen = near.select("customer_id", "neighbour_id", "similarity").join(lists, "neighbour_id")
        seen = seen.select("customer_id", "similarity", "codes", "sales").repartition("customer_id")
        entries = seen.select("customer_id", "similarity", F.explode(F.arrays_zip("codes", "sales")).alias("item"))
        scores = entries.groupBy("customer_id", F.col("item.codes").alias("code")).agg(
            F.sum(F.col("similarity") * F.col("item.sales")).alias("score")
        )
        named = F.struct(F.get(names, F.col("code")).alias("sub_category"), "score")
        scores = scores.groupBy("customer_id").agg(F.map_from_entries(F.collect_list(named)).alias("_scores"))
        offers = offers.join(scores, "customer_id", "left")
        score = F.try_element_at("_scores", F.col("sub_category"))
        offers = offers.select("customer_id", "sub_category", F.round(F.coalesce(score, F.lit(0.0)), 4).alias("score"))
        order = Window.partitionBy("customer_id").orderBy(F.col("score").desc(), "sub_category")
        ranked = offers.withColumn("rank", F.row_number().over(order).cast("bigint"))
        return ranked.where(F.col("rank") <= top)

    offers = unbought(bought)
    if turns <= 1:
        return turn(neighbours, offers)
    # The copies of a turn are gone when its result is written.
    mine = F.pmod(F.xxhash64("customer_id"), F.lit(turns))
    parts = [storage.stage(turn(neighbours.where(mine == one), offers.where(mine == one)), "recommended") for one in range(turns)]
    return reduce(DataFrame.unionByName, parts)


def copurchase_corr(bought: DataFrame) -> DataFrame:
    """Correlation of sub-category sales over all customers, absent purchases being zero.

    The matrix is as wide as the sub-category dimension; its sums are built on the executors.
    """
    spark = bought.sparkSession
    # Means and products take a pass each over the vectors, so these are written once.
    vectors = storage.stage(purchase_vectors(bought).select("amounts"), "vectors")
    vectors = vectors.select(array_to_vector("amounts").alias("features"))
    names = [row.sub_category for row in bought.select("sub_category").distinct().collect()]
    names.sort()
    matrix = Correlation.corr(vectors, "features").head()[0].toArray()
    cells = [
        (a, b, None if math.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(names)
        for j, b in enumerate(names)
    ]
    return spark.createDataFrame(cells, "item_a string, item_b string, corr double")
