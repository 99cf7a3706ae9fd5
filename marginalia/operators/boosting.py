"""Boosted trees for two classes, fitted on all rows from one binned table.

Every column is cut once into at most ``BINS`` ranges at its quantiles. Blocks of rows stay in the
executors as bytes, with the margin and the residual each model gives a row; a level of the trees of
all models is one pass over them that brings back histograms, and the next tree starts with the pass
that adds the last one to the margins. What a pass sends follows from models, columns and depth, not
from rows; only the nodes that begin a pair are counted, their sisters follow from the node above.
Every ``KEPT_ROUNDS`` rounds the blocks are written to the shared folder, which cuts their lineage.

The loss is that of Spark's boosted trees: with y = 1 or -1 and margin F, residuals are
4y / (1 + exp(2yF)), a leaf is their weighted mean, nodes split where that lowers their variance, the
first tree fits y itself, and a probability is 1 / (1 + exp(-2F)). Residuals are counted in fixed
point, so sums do not depend on the order of rows or tasks.

Missing numbers and labels are an error.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from marginalia import storage
from marginalia.operators import forest

BINS = 32
BLOCK_ROWS = 1 << 15
# Rows that are worth a task: a pass over fewer takes less time than to start it. A table of no more
# is one block, which stays in one task for all its passes.
TASK_ROWS = 1 << 17
KEPT_ROUNDS = 50
# Residuals are multiples of this share; partial histograms of more tasks are added on the executors.
UNIT, FEW_TASKS = 1 << 24, 32


@dataclass(frozen=True)
class Boosting:
    """What boosted trees are fitted with; shares of rows are per tree, of columns per node."""

    rounds: int = 200
    rate: float = 0.05
    depth: int = 6
    row_share: float = 1.0
    column_share: float = 1.0
    seed: int = 42


@dataclass
class Boosted:
    """Trees of one depth, a line each, with the nodes of each level behind those of the one above.

    Rows whose value of ``feature`` is above the edge ``cut`` go to the second child; a node that is
    not split has the cut 255 and sends all to its first. ``value`` belongs to the last nodes,
    ``rows`` (training rows) to all nodes, ``weight`` to the trees.
    """

    names: list[str]
    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    weight: np.ndarray
    importances: np.ndarray

    def margins(self, cells: np.ndarray) -> np.ndarray:
        """The margin of each row of ``cells`` (bins)."""
        steps, total = self.value.shape[1].bit_length() - 1, np.zeros(len(cells))
        flat, rows = np.ascontiguousarray(cells.T).ravel(), np.arange(len(cells))
        for feature, cut, value, weight in zip(self.feature, self.cut, self.value, self.weight, strict=True):
            total += weight * value.take(forest._walk(flat, rows, len(rows), feature, cut, steps))
        return total

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with rawPrediction, probability and prediction, as Spark's classifiers name them."""
        shared = rows.sparkSession.sparkContext.broadcast(self)
        numbers = [F.col(name).cast("double").alias(f"_v{place}") for place, name in enumerate(self.names)]

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                model, first = shared.value, batch.num_columns - len(shared.value.names)
                values = [batch.column(place).to_numpy(zero_copy_only=False) for place in range(first, batch.num_columns)]
                found = pa.array(model.margins(cells_of(values, model.edges)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:first], found], [*batch.schema.names[:first], "_margin"])

        schema = StructType([*rows.schema.fields, StructField("_margin", DoubleType())])
        scored = rows.select("*", *numbers).mapInArrow(scan, schema)
        chance = 1 / (1 + F.exp(-2 * F.col("_margin")))
        return scored.withColumns(
            {
                "rawPrediction": array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
                "probability": array_to_vector(F.array(1 - chance, chance)),
                "prediction": (F.col("_margin") > 0).cast("double"),
            }
        ).drop("_margin")

    def leaves(self) -> list[tuple[float, list[tuple[int, float, float, float]]]]:
        """Every leaf as (weighted value, [(feature, above, up to, share let through)])."""
        found = []
        inner = self.feature.shape[1]
        for tree, weight in enumerate(self.weight):
            todo = [(0, {})]
            while todo:
                node, rules = todo.pop()
                if node >= inner or self.cut[tree, node] == 255:
                    while node < inner:
                        node = 2 * node + 1
                    found.append((float(weight * self.value[tree, node - inner]), [(f, *rule) for f, rule in rules.items()]))
                    continue
                feature = int(self.feature[tree, node])
                edge = float(self.edges[feature][self.cut[tree, node]])
                lo, hi, share = rules.get(feature, (-np.inf, np.inf, 1.0))
                for child, bounds in ((2 * node + 1, (lo, min(hi, edge))), (2 * node + 2, (max(lo, edge), hi))):
                    through = share * float(self.rows[tree, child] / self.rows[tree, node])
                    todo.append((child, {**rules, feature: (*bounds, through)}))
        return found

    def save(self, spark: SparkSession, path: str) -> None:
        """One row; its size follows from trees and depth."""
        row = spark.createDataFrame([(bytearray(pickle.dumps(self.__dict__)),)], "boosted binary")
        row.coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Boosted:
    return Boosted(**pickle.loads(bytes(spark.read.parquet(path).first().boosted)))


def cells_of(values: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    if any(np.isnan(column).any() for column in values):
        raise ValueError("missing numbers cannot be scored")
    return forest.cells_of(values, edges)


def binned(rows: DataFrame, names: list[str], keys: list[str], label: str) -> tuple[DataFrame, list[np.ndarray]]:
    """The staged table of ``forest.binned`` with the edges it was cut at. ``rows`` has its ``fold``."""
    known = {name: F.col(name).cast("double") for name in names}
    known = {name: F.when(~F.isnan(F.coalesce(value, F.lit(float("nan")))), value) for name, value in known.items()}
    error = F.raise_error(F.lit("features and labels must not be null"))
    checked = rows.withColumns({name: F.coalesce(value, error) for name, value in {**known, label: F.col(label)}.items()})
    edges = forest.bin_edges(checked, names, BINS)
    return forest.binned(checked, names, keys, label, edges), edges


def _blocks(table: DataFrame, models: int, tasks: int) -> RDD:
    """Blocks of rows: draw, fold, label, bins (column by column), margins and residuals per model."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
        if size:
            yield pa.Table.from_batches(held).combine_chunks()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pack(batch for batch in batches if batch.num_rows):
            bins = np.frombuffer(b"".join(part["bins"].to_pylist()), np.uint8).reshape(part.num_rows, -1)
            draw = (part["draw"].to_numpy().view(np.uint64) >> np.uint64(32)).astype(np.uint32)
            label, fold = part["label"].to_numpy().astype(np.int8), part["fold"].to_numpy().astype(np.int16)
            block = pickle.dumps((draw, fold, label, np.ascontiguousarray(bins.T).ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], ["block"])

    def state(row) -> tuple:
        draw, fold, label, flat = pickle.loads(bytes(row.block))
        first = np.tile((2 * label.astype(np.int32) - 1) * UNIT, (models, 1))
        return draw, fold, label, flat, np.zeros((models, len(label)), np.float32), first

    rows = table.select("draw", "fold", "label", "bins")
    return rows.coalesce(tasks).mapInArrow(scan, "block binary").rdd.map(state)


def _added(block: tuple, trees: list[tuple], weight: float) -> tuple:
    """``block`` with the margins and residuals after one more tree of each model."""
    draw, fold, label, flat, margins, _ = block
    sign, rows = (2 * label - 1).astype(np.float32), np.arange(len(label))
    margins, residuals = margins.copy(), np.empty(margins.shape, np.int32)
    for model, (feature, cut, value) in enumerate(trees):
        leaf = forest._walk(flat, rows, len(rows), feature, cut, len(value).bit_length() - 1)
        margins[model] += (weight * value).astype(np.float32).take(leaf)
        residuals[model] = np.rint(4 * UNIT * sign.astype(np.float64) / (1 + np.exp(2 * sign * margins[model])))
    return draw, fold, label, flat, margins, residuals


def _histograms(
    blocks: Iterator[tuple], trees: list[tuple], level: int, columns: int, odd: int, row_share: float
) -> Iterator[np.ndarray]:
    """Rows and residuals by model, column, node, bin and label, of the first node of each pair."""
    size = max(1, 1 << (level - 1) if level else 1) * BINS * 2
    total = np.zeros((2, len(trees), columns, size))
    drawn = int(row_share * 65536)
    for draw, fold, label, flat, _, residuals in blocks:
        count = len(label)
        sampled = ((draw * np.uint32(odd)) >> np.uint32(16)) < drawn if row_share < 1 else np.ones(count, bool)
        for model, (feature, cut) in enumerate(trees):
            rows = np.flatnonzero(sampled & (fold != model))
            node = forest._walk(flat, rows, count, feature, cut, level)
            if level:
                first = (node & 1) == 0
                rows, node = rows[first], node[first] >> 1
            cell = node * (2 * BINS) + label.take(rows)
            residual = residuals[model].take(rows).astype(np.float64)
            for column in range(columns):
                bins = flat[column * count : (column + 1) * count].take(rows).astype(np.int64)
                bins += bins
                bins += cell
                total[0, model, column] += np.bincount(bins, minlength=size)
                total[1, model, column] += np.bincount(bins, residual, size)
    yield total


def _best_splits(counts: np.ndarray, allowed: np.ndarray, weights: tuple[float, float]) -> tuple[np.ndarray, ...]:
    """Column, cut and gain of each node, and (rows, weight, weighted residuals) of the children in turn.

    ``counts`` has rows and residuals by column, node, bin and label; ``allowed`` nodes by columns.
    """
    rows = counts[0].sum(axis=-1).cumsum(axis=2)
    weight, value = (sums.cumsum(axis=2) for sums in (counts * np.array(weights)).sum(axis=-1))
    value = value / UNIT
    sides = np.stack([rows, weight, value], axis=-1)
    whole = sides[:, :, -1:, :]
    rest = whole - sides
    parted = (sides[..., 0] > 0) & (rest[..., 0] > 0) & allowed.T[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = sides[..., 2] ** 2 / sides[..., 1] + rest[..., 2] ** 2 / rest[..., 1] - whole[..., 2] ** 2 / whole[..., 1]
    gain = np.where(parted, gain, -np.inf)
    nodes = np.arange(gain.shape[1])
    place = gain.transpose(1, 0, 2).reshape(len(nodes), -1).argmax(axis=1)
    column, cut = place // BINS, place % BINS
    gain = gain[column, nodes, cut]
    split = gain > 1e-9 * whole[0, :, 0, 1]
    left = np.where(split[:, None], sides[column, nodes, cut], whole[0, :, 0])
    children = np.stack([left, whole[0, :, 0] - left], axis=1).reshape(-1, 3)
    return np.where(split, column, 0), np.where(split, cut, 255), np.where(split, gain, 0.0), children


class _Held:
    """The blocks of a small table, in the task that holds them."""

    def __init__(self, blocks: Iterator[tuple]):
        self.blocks = list(blocks)

    def count(self, *what) -> np.ndarray:
        return next(_histograms(self.blocks, *what))

    def add(self, *what) -> None:
        self.blocks = [_added(block, *what) for block in self.blocks]


class _Spread:
    """The blocks of a table over all executors."""

    def __init__(self, spark: SparkSession, blocks: RDD):
        self.spark, self.turn, self.old, self.kept = spark, 0, [], []
        self.blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)

    def count(self, *what) -> np.ndarray:
        found = self.blocks.mapPartitions(lambda part: _histograms(part, *what))
        total = found.treeReduce(np.add) if found.getNumPartitions() > FEW_TASKS else sum(found.collect())
        # The pass has put the present blocks in place of the old ones.
        for done in self.old:
            done.unpersist()
        self.old = []
        return total

    def add(self, *what) -> None:
        self.old.append(self.blocks)
        self.blocks = self.blocks.map(lambda block: _added(block, *what))
        self.turn += 1
        if self.turn % KEPT_ROUNDS == 0:
            path = storage.new_path(self.spark, "blocks")
            self.blocks.saveAsPickleFile(path, 1)
            self.blocks = self.spark.sparkContext.pickleFile(path, self.blocks.getNumPartitions())
            self.kept.append(path)
            if len(self.kept) > 1:
                # The blocks before are in the new files.
                storage.remove(self.spark, self.kept.pop(0))
        self.blocks = self.blocks.persist(StorageLevel.MEMORY_AND_DISK)

    def end(self) -> None:
        for done in (*self.old, self.blocks):
            done.unpersist()
        for path in self.kept:
            storage.remove(self.spark, path)


def _grown(
    state: _Held | _Spread, names: list[str], edges: list[np.ndarray], boosting: Boosting, weights: list[tuple[float, float]]
) -> list[Boosted]:
    depth, width, models = boosting.depth, len(names), len(weights)
    rng = np.random.default_rng(boosting.seed)
    tried = max(1, math.ceil(boosting.column_share * width))
    inner = (1 << depth) - 1
    shape = (models, boosting.rounds, inner)
    feature, cut = np.zeros(shape, np.uint8), np.full(shape, 255, np.uint8)
    value, rows = np.zeros((models, boosting.rounds, inner + 1)), np.zeros((models, boosting.rounds, 2 * inner + 1))
    gains = np.zeros((models, boosting.rounds, width))
    tree_weight = np.full(boosting.rounds, boosting.rate)
    tree_weight[:1] = 1.0
    for turn in range(boosting.rounds):
        odd, above = 2 * int(rng.integers(0, 1 << 31)) + 1, None
        for level in range(depth):
            nodes, here = 1 << level, slice((1 << level) - 1, (2 << level) - 1)
            trees = [(feature[model, turn].copy(), cut[model, turn].copy()) for model in range(models)]
            total = state.count(trees, level, width, odd, boosting.row_share)
            total = total.reshape(2, models, width, max(1, nodes // 2), BINS, 2)
            if level:
                total = np.stack([total, above - total], axis=4).reshape(2, models, width, nodes, BINS, 2)
            above = total
            allowed = rng.random((models, nodes, width)).argsort(axis=2).argsort(axis=2) < tried
            if level:
                # A node that no column has split is a leaf, and so is what lies below it.
                allowed &= np.repeat(cut[:, turn, (1 << level - 1) - 1 : (1 << level) - 1] != 255, 2, axis=1)[:, :, None]
            for model in range(models):
                best, at, gain, sides = _best_splits(total[:, model], allowed[model], weights[model])
                feature[model, turn, here], cut[model, turn, here] = best, at
                np.add.at(gains[model, turn], best, gain)
                rows[model, turn, (2 << level) - 1 : (4 << level) - 1] = sides[:, 0]
                if not level:
                    rows[model, turn, 0] = sides[:, 0].sum()
                if level == depth - 1:
                    value[model, turn] = np.divide(sides[:, 2], sides[:, 1], out=np.zeros(inner + 1), where=sides[:, 1] > 0)
        trees = [(feature[model, turn].copy(), cut[model, turn].copy(), value[model, turn].copy()) for model in range(models)]
        if turn + 1 < boosting.rounds:
            state.add(trees, float(tree_weight[turn]))
    totals = gains.sum(axis=2, keepdims=True)
    shares = np.divide(gains, totals, out=np.zeros_like(gains), where=totals > 0) * tree_weight[:, None]
    shares = shares.sum(axis=1)
    sums = shares.sum(axis=1, keepdims=True)
    shares = np.divide(shares, sums, out=np.zeros_like(shares), where=sums > 0)
    return [Boosted(names, edges, feature[m], cut[m], value[m], rows[m], tree_weight, shares[m]) for m in range(models)]


def fit(
    table: DataFrame, names: list[str], edges: list[np.ndarray], boosting: Boosting, weights: list[tuple[float, float]]
) -> list[Boosted]:
    """One model per pair of class ``weights``, of the labels 0 and 1; model m learns from the rows of
    ``table`` (as of ``binned``) whose fold is not m."""
    models, count = len(weights), table.count()
    if not count:
        raise ValueError("no rows to fit")
    if count <= TASK_ROWS:
        return _blocks(table, models, 1).mapPartitions(lambda part: _grown(_Held(part), names, edges, boosting, weights)).collect()
    state = _Spread(table.sparkSession, _blocks(table, models, math.ceil(count * models / TASK_ROWS)))
    try:
        return _grown(state, names, edges, boosting, weights)
    finally:
        state.end()


def held_out_scores(
    rows: DataFrame, names: list[str], keys: list[str], label: str, boosting: Boosting, folds: int, balanced: bool
) -> DataFrame:
    """(``fold``, ``label``, ``score``) of every row, scored by the model its fold is held out of.

    ``rows`` has its ``fold`` (0 to folds - 1). The models of all folds are fitted in the same passes.
    """
    table, edges = binned(rows, names, keys, label)
    weights = [(1.0, 1.0)] * folds
    if balanced:
        # Weights follow from the training folds alone.
        counts = {(row.fold, row.label): row["count"] for row in table.groupBy("fold", "label").count().collect()}
        for fold in range(folds):
            sizes = [sum(n for (own, kind), n in counts.items() if own != fold and kind == one) for one in (0, 1)]
            weights[fold] = tuple(sum(sizes) / (2 * size) if size else 1.0 for size in sizes)
    shared = rows.sparkSession.sparkContext.broadcast(fit(table, names, edges, boosting, weights))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, len(names))
            fold, margin = batch.column("fold").to_numpy(), np.zeros(batch.num_rows)
            for own in np.unique(fold):
                margin[fold == own] = shared.value[own].margins(cells[fold == own])
            score = pa.array(1 / (1 + np.exp(-2 * margin)))
            yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("label"), score], ["fold", "label", "score"])

    return storage.stage(table.mapInArrow(scan, "fold int, label int, score double"), "held-out")
