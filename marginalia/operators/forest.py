"""Random forests of full depth, grown side by side from one binned table.

Every column is cut once into at most ``BINS`` ranges at its quantiles; a row is then a few bytes,
staged once and shared by all folds. Every tree is grown from the bootstrap of all training rows:
how often a row is drawn (Poisson with mean 1) follows from its key. A node with more than
``fit_rows`` drawn rows is split by a pass over the table that counts it; smaller ones are each left
to one task, with their rows. Both take the same cuts from the same counts, and the choices of a
node follow from its key, so ``fit_rows`` decides where the work is done and never what comes out.
Trees take turns in groups, so that what is shuffled at a time is bounded, however many rows there are.

Trees are not cut: nodes split until they are pure or no column parts their rows.

A forest of a fixed depth (``fit_levels``) sees all rows in every tree: the bootstrap weights of a
row follow from its key, and each level of all trees takes one pass over the binned table, whose
tasks send histograms only. What a task holds and sends follows from trees and depth, not from rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from marginalia import storage

BINS = 64
# Rows of trees (a row for each tree that works on it) that are shuffled at a time and that are worth
# a task, most tasks, and nodes of a tree whose histograms are held at a time.
PAIRS, TASK_PAIRS, MOST_TASKS, NODES = 1 << 27, 1 << 24, 2048, 4096
# Scores of trees are added as multiples of this share, so sums do not depend on their order.
UNIT = 1 << 40
# Parts the keys of what belongs to a node.
STEP = np.uint64(0x9E3779B97F4A7C15)
# Rows that ``fit_levels`` works on at a time, so that they stay in the processor's cache.
CHUNK_ROWS = 1 << 16
# The bootstrap weight (how often a row is drawn: Poisson with mean 1) by 16 random bits.
DRAWN_SHARES = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(9)])
DRAWN = np.searchsorted(DRAWN_SHARES, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


@dataclass(frozen=True)
class Forest:
    """What a forest is grown with; the depth is free unless it is given. ``fit_rows`` are the most
    drawn rows of a node that one task holds."""

    trees: int = 100
    fit_rows: int = 100_000
    depth: int | None = None
    balanced: bool = True
    seed: int = 42


@dataclass
class Tree:
    """Nodes as arrays: rows whose bin of ``feature`` is above ``cut`` go to the node behind
    ``left``; a leaf has ``left`` -1 and the share of label 1 as ``value``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.ends(bins)]

    def ends(self, bins: np.ndarray) -> np.ndarray:
        """The node each row ends at."""
        at = np.zeros(len(bins), np.int32)
        moving = np.flatnonzero(self.left[at] >= 0)
        while len(moving):
            now = at[moving]
            at[moving] = self.left[now] + (bins[moving, self.feature[now]] > self.cut[now])
            moving = moving[self.left[at[moving]] >= 0]
        return at


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Each number scattered over all 64 bits."""
    numbers = (numbers ^ (numbers >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    numbers = (numbers ^ (numbers >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return numbers ^ (numbers >> np.uint64(31))


def _children(keys: np.ndarray) -> np.ndarray:
    """The keys of the two children of nodes in turn."""
    return _mixed(keys[:, None] + STEP * np.array([1 << 20, 1 << 21], np.uint64)).ravel()


def _best_cuts(counts: np.ndarray, weights: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Per node the best cut of a column and how well it parts the classes (-inf: none).

    ``counts`` has the drawn rows of each node by bin and label, ``weights`` those of the labels.
    """
    zeros, ones = (counts[..., label].cumsum(axis=1) * weights[label] for label in (0, 1))
    all_ = zeros + ones
    total, total_ones = all_[:, -1:], ones[:, -1:]
    rest, rest_ones = total - all_, total_ones - ones
    parted = (all_ > 1e-9 * total) & (rest > 1e-9 * total)
    with np.errstate(divide="ignore", invalid="ignore"):
        purity = (ones**2 + (all_ - ones) ** 2) / all_ + (rest_ones**2 + (rest - rest_ones) ** 2) / rest
    purity = np.where(parted, purity, -np.inf)
    cut = purity.argmax(axis=1)
    return cut, purity[np.arange(len(counts)), cut]


def _splits(keys: np.ndarray, open_: np.ndarray, columns: int, cuts: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column and cut of each node, and whether it is split. ``cuts`` gives those of some nodes by column.

    Each ``open_`` node looks at a choice, by its key, of the square root of the columns, and at
    further ones while none of them parts its rows.
    """
    tried = max(1, int(math.sqrt(columns)))
    order = _mixed(keys[:, None] + STEP * np.arange(1, columns + 1, dtype=np.uint64)).argsort(axis=1, kind="stable")
    feature, cut, best = np.zeros(len(keys), np.uint8), np.zeros(len(keys), np.uint8), np.full(len(keys), -np.inf)
    for turn in range(columns):
        nodes = np.flatnonzero(open_ if turn < tried else open_ & np.isneginf(best))
        if not len(nodes):
            break
        for start in range(0, len(nodes), NODES):
            some = nodes[start : start + NODES]
            found, purity = cuts(some, order[some, turn])
            better = purity > best[some]
            where = some[better]
            best[where], feature[where], cut[where] = purity[better], order[where, turn], found[better]
    return feature, cut, ~np.isneginf(best)


def grow(
    bins: np.ndarray, label: np.ndarray, weight: np.ndarray, rng: np.random.Generator | np.uint64,
    depth: int | None = None, weights: tuple[float, float] = (1.0, 1.0),
) -> Tree:
    """A tree from rows of ``bins`` (bytes), 0/1 labels and how often each is drawn (0: not used).

    ``weights`` are those of the labels. The choices of a node follow from its key alone, which
    follows from its parent's; the root's is drawn from ``rng``, or ``rng`` itself.
    """
    used = np.flatnonzero(weight > 0)
    bins, weight, label = bins[used], weight[used].astype(np.float64), label[used].astype(np.int64)
    columns = bins.shape[1]
    keys = np.array([rng if isinstance(rng, np.uint64) else rng.integers(0, 1 << 63)], np.uint64)
    feature, cut, left, value = ([] for _ in range(4))
    owner, first, level = np.zeros(len(bins), np.int64), 0, 0
    while len(keys):
        nodes = len(keys)
        sums = np.bincount(2 * owner + label, weight, 2 * nodes).reshape(nodes, 2)
        share = _shares(sums, weights)
        open_ = (sums > 0).all(axis=1) & (depth is None or level < depth)
        # Rows of finished nodes have no more to say; the others lie by node.
        kept = np.flatnonzero(open_[owner])
        kept = kept[owner[kept].argsort(kind="stable")]
        bins, weight, label, owner = bins[kept], weight[kept], label[kept], owner[kept]
        starts = np.searchsorted(owner, np.arange(nodes + 1))

        def cuts(some: np.ndarray, chosen: np.ndarray, held=(bins, weight, label, owner, starts)):
            bins, weight, label, owner, starts = held
            rows = slice(starts[some[0]], starts[some[-1] + 1])
            place = np.full(some[-1] + 1 - some[0], -1)
            place[some - some[0]] = np.arange(len(some))
            at = place[owner[rows] - some[0]]
            here = np.arange(rows.start, rows.stop)
            if len(some) < len(place):
                here, at = here[at >= 0], at[at >= 0]
            cell = (at * BINS + bins[here, chosen[at]]) * 2 + label[here]
            counts = np.bincount(cell, weight[here], len(some) * BINS * 2)
            return _best_cuts(counts.reshape(len(some), BINS, 2), weights)

        best_feature, best_cut, split = _splits(keys, open_, columns, cuts)
        children = first + nodes + 2 * (np.cumsum(split) - 1)
        feature.append(best_feature)
        cut.append(best_cut)
        value.append(share)
        left.append(np.where(split, children, -1))
        if not split.all():
            kept = np.flatnonzero(split[owner])
            bins, weight, label, owner = bins[kept], weight[kept], label[kept], owner[kept]
        above = bins[np.arange(len(bins)), best_feature[owner]] > best_cut[owner]
        owner = children[owner] - first - nodes + above
        keys = _children(keys[split])
        first += nodes
        level += 1
    kinds = (np.uint8, np.uint8, np.int32, np.float32)
    return Tree(*(np.concatenate(parts).astype(kind) for parts, kind in zip((feature, cut, left, value), kinds, strict=True)))


def _shares(sums: np.ndarray, weights: tuple[float, float]) -> np.ndarray:
    """The weighted share of label 1 by node; 0 without rows. ``sums`` has the drawn rows by label."""
    ones = sums[:, 1] * weights[1]
    all_ = sums[:, 0] * weights[0] + ones
    return np.divide(ones, all_, out=np.zeros(len(sums)), where=all_ > 0)


def bin_edges(rows: DataFrame, names: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Quantiles of the whole table, to one in a thousand."""
    shares = [place / bins for place in range(1, bins)]
    return [np.unique(found) for found in rows.approxQuantile(names, shares, 0.001)]


def cells_of(values: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    """The bins of some rows, one line per row; missing numbers lie in the first bin."""
    cells = np.zeros((len(values[0]), len(edges)), np.uint8)
    for place, (column, cuts) in enumerate(zip(values, edges, strict=True)):
        known = ~np.isnan(column)
        cells[known, place] = np.searchsorted(cuts, column[known], side="left")
    return cells


def binned(
    rows: DataFrame, names: list[str], keys: list[str], label: str, edges: list[np.ndarray] | None = None
) -> DataFrame:
    """(``draw``, ``fold``, ``label``, ``row``, ``bins``): each row's columns as one byte each, staged.

    Edges are those of ``bin_edges`` unless given. ``draw`` follows from the row's key; ``row`` is
    its number in the staged table.
    """
    edges = edges or bin_edges(rows, names)
    source = rows.select(
        F.xxhash64(*keys).alias("draw"),
        F.col("fold").cast("int").alias("fold"),
        F.col(label).cast("int").alias("label"),
        F.monotonically_increasing_id().alias("row"),
        *(F.col(name).cast("double").alias(f"v{place}") for place, name in enumerate(names)),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch.column(4 + place).to_numpy(zero_copy_only=False) for place in range(len(edges))]
            raw = pa.py_buffer(cells_of(values, edges).tobytes())
            listed = pa.Array.from_buffers(pa.binary(len(edges)), batch.num_rows, [None, raw]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], listed], ["draw", "fold", "label", "row", "bins"])

    return storage.stage(source.mapInArrow(scan, "draw long, fold int, label int, row long, bins binary"), "binned")


def _fold_weights(table: DataFrame, balanced: bool, folds: int) -> list[tuple[tuple[float, float], float]]:
    """Per fold the weights of the labels among the other folds' rows, and their weighted share of label 1."""
    counts = np.zeros((folds, 2))
    for row in table.groupBy("fold", "label").count().collect():
        counts[row.fold, row.label] = row["count"]
    sizes = counts.sum(axis=0) - counts
    weights = [tuple(own.sum() / (2 * own)) if balanced and own.all() else (1.0, 1.0) for own in sizes]
    return [(own, float(_shares(size[None], own)[0])) for own, size in zip(weights, sizes, strict=True)]


@dataclass
class _Top:
    """The upper nodes of the tree ``tree`` that ``fold`` is held out of, as lists as in ``Tree``.

    ``left`` is -2 where a node is left to one task. ``odd`` makes the row's draws, ``keys`` and
    ``levels`` belong to the nodes, ``open`` are those still to be split here.
    """

    fold: int
    tree: int
    weights: tuple[float, float]
    share: float
    odd: np.uint64
    feature: list[int]
    cut: list[int]
    left: list[int]
    value: list[float]
    keys: list[np.uint64]
    levels: list[int]
    open: list[int]

    def arrays(self) -> Tree:
        return Tree(np.array(self.feature, np.uint8), np.array(self.cut, np.uint8), np.array(self.left, np.int32), np.array(self.value, np.float32))

    def add(self, key: np.uint64, level: int, sums: np.ndarray, forest: Forest) -> None:
        """One more node, which has ``sums`` drawn rows by label."""
        node, full = len(self.left), forest.depth is not None and level >= forest.depth
        self.feature.append(0)
        self.cut.append(0)
        self.value.append(float(_shares(sums[None], self.weights)[0]))
        self.keys.append(key)
        self.levels.append(level)
        if full or not sums.all():
            self.left.append(-1)
        elif sums.sum() <= forest.fit_rows:
            self.left.append(-2)
        else:
            self.left.append(-1)
            self.open.append(node)


def _drawn(draw: np.ndarray, fold: np.ndarray, top: _Top) -> np.ndarray:
    """How often each row is drawn for a tree, not at all if its fold is held out."""
    times = DRAWN.take(((draw * top.odd) >> np.uint64(48)).view(np.int64))
    times[fold == top.fold] = 0
    return times


def _tops(table: DataFrame, forest: Forest, turns: list[tuple], rows: int) -> list[_Top]:
    """The trees of ``turns`` (fold, tree, weights, share) down to nodes of ``fit_rows`` drawn rows.

    A level of all of them is one pass over ``table``, whose tasks send histograms of the nodes that
    have more; so their number, and what is sent, follow from the drawn rows of ``turns`` alone.
    """
    spark, tops = table.sparkSession, []
    for fold, tree, weights, share in turns:
        rng = np.random.default_rng([forest.seed, fold, tree])
        odd = np.uint64(rng.integers(0, 1 << 63)) * np.uint64(2) + np.uint64(1)
        top = _Top(fold, tree, weights, share, odd, [], [], [], [], [], [], [])
        # Nine draws a row are the most there are.
        alone = rows * (len(DRAWN_SHARES) - 1) <= forest.fit_rows
        top.add(np.uint64(rng.integers(0, 1 << 63)), 0, np.ones(2), forest)
        if not alone and top.left[0] == -2:
            top.left[0], top.open = -1, [0]
        tops.append(top)
    while any(top.open for top in tops):
        shared = spark.sparkContext.broadcast([(top, top.arrays()) for top in tops if top.open])

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            totals = None
            for draw, fold, label, bins, _ in _rows(batches):
                columns = bins.shape[1]
                if totals is None:
                    totals = [np.zeros((columns, len(top.open) * BINS * 2)) for top, _ in shared.value]
                for (top, tree), total in zip(shared.value, totals, strict=True):
                    times = _drawn(draw, fold, top)
                    rows = np.flatnonzero(times)
                    slot = np.full(len(tree.left), -1)
                    slot[top.open] = np.arange(len(top.open))
                    own = slot[tree.ends(bins[rows])]
                    rows, own = rows[own >= 0], own[own >= 0]
                    cell, weight = own * (BINS * 2) + label[rows], times[rows].astype(np.float64)
                    for column in range(columns):
                        total[column] += np.bincount(cell + 2 * bins[rows, column].astype(np.int64), weight, total.shape[1])
            for place in range(len(totals or ())):
                sums = totals[place].reshape(len(totals[place]), -1, BINS * 2).astype(np.int64)
                nodes = sums.shape[1]
                blobs = [sums[:, node].tobytes() for node in range(nodes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([place] * nodes, pa.int32()), pa.array(range(nodes), pa.int32()), pa.array(blobs, pa.binary())],
                    ["place", "node", "counts"],
                )

        def split(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
            top, _ = shared.value[key[0]]
            counts = sum(np.frombuffer(blob, np.int64) for blob in parts["counts"]).reshape(1, -1, BINS, 2)
            sums, keys = counts[0, 0].sum(axis=0), np.array([top.keys[top.open[key[1]]]], np.uint64)
            feature, cut, parted = _splits(
                keys, (sums > 0)[None].all(axis=1), counts.shape[1], lambda some, chosen: _best_cuts(counts[some, chosen], top.weights)
            )
            low = counts[0, feature[0], : int(cut[0]) + 1].sum(axis=0)
            found = (*key, int(feature[0]), int(cut[0]), bool(parted[0]), *map(int, low), *map(int, sums - low))
            return pd.DataFrame([found], columns=["place", "node", "feature", "cut", "parted", "low0", "low1", "high0", "high1"])

        sums = table.mapInArrow(count, "place int, node int, counts binary")
        shape = "place int, node int, feature int, cut int, parted boolean, low0 long, low1 long, high0 long, high1 long"
        found = {(row.place, row.node): row for row in sums.groupBy("place", "node").applyInPandas(split, shape).collect()}
        for place, top in enumerate([top for top in tops if top.open]):
            now, top.open = top.open, []
            for slot, node in enumerate(now):
                row = found.get((place, slot))
                sides = np.array([[row.low0, row.low1], [row.high0, row.high1]], float) if row else np.zeros((2, 2))
                if node == 0:
                    # Only now it is known what the root has.
                    top.value[0] = float(_shares(sides.sum(axis=0)[None], top.weights)[0]) if sides.any() else top.share
                    if sides.sum(axis=0).all() and sides.sum() <= forest.fit_rows:
                        top.left[0] = -2
                        continue
                if row is None or not row.parted:
                    continue
                top.feature[node], top.cut[node], top.left[node] = row.feature, row.cut, len(top.left)
                for key, side in zip(_children(np.array([top.keys[node]])), sides, strict=True):
                    top.add(key, top.levels[node] + 1, side, forest)
        shared.destroy()
    return tops


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Draws, folds, labels, bins (a line per row) and row numbers of about ``CHUNK_ROWS`` rows at a time."""
    held, size = [], 0

    def joined():
        part = pa.Table.from_batches(held).combine_chunks()
        bins = np.frombuffer(b"".join(part["bins"].to_pylist()), np.uint8).reshape(part.num_rows, -1)
        numbers = [part[name].to_numpy() for name in ("fold", "label", "row")]
        return part["draw"].to_numpy().view(np.uint64), numbers[0], numbers[1].astype(np.int64), bins, numbers[2]

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHUNK_ROWS:
            yield joined()
            held, size = [], 0
    if size:
        yield joined()


def _by_value(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value with its places."""
    order = values.argsort(kind="stable")
    edges = np.flatnonzero(np.diff(values[order])) + 1
    for places in np.split(order, edges) if len(values) else ():
        yield int(values[places[0]]), places


def _dealt(table: DataFrame, tops: list[_Top], scored: bool) -> DataFrame:
    """(``place``, ``node``, ``held``, ``about``, ``bins``): the rows of each node of ``tops`` that is left
    to one task, packed. ``about`` has their draws and labels; with ``scored``, held-out rows follow
    with their numbers."""
    shared = table.sparkSession.sparkContext.broadcast([(top, top.arrays()) for top in tops])

    def packed(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        columns = [pa.array(column, kind) for column, kind in zip(zip(*found, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["place", "node", "held", "about", "bins"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for draw, fold, label, bins, row in _rows(batches):
            found, size = [], 0
            for place, (top, tree) in enumerate(shared.value):
                times = _drawn(draw, fold, top)
                about = times * np.uint8(2) + label.astype(np.uint8)
                for held, rows in enumerate([np.flatnonzero(times), np.flatnonzero(fold == top.fold) if scored else ()]):
                    if not len(rows):
                        continue
                    node = tree.ends(bins[rows])
                    left = tree.left[node] == -2
                    rows, node = rows[left], node[left]
                    size += len(rows)
                    for one, places in _by_value(node):
                        mine = rows[places]
                        what = row[mine] if held else about[mine]
                        found.append((place, one, held, what.tobytes(), bins[mine].tobytes()))
                if size >= CHUNK_ROWS:
                    yield packed(found)
                    found, size = [], 0
            if found:
                yield packed(found)

    dealt = table.mapInArrow(deal, "place int, node int, held int, about binary, bins binary")
    nodes = sum(left == -2 for top in tops for left in top.left)
    # A task for a node: adaptive execution would merge the small ones, and their work is not small.
    return dealt.repartition(max(1, min(nodes, MOST_TASKS)), "place", "node")


def _grown(top: _Top, node: int, parts: pd.DataFrame, depth: int | None) -> Tree:
    """The tree below ``node`` from its drawn rows."""
    drawn = parts[parts["held"] == 0]
    about = np.frombuffer(b"".join(drawn["about"]), np.uint8)
    if not len(about):
        # Nothing was drawn of a table of a few rows.
        return Tree(np.zeros(1, np.uint8), np.zeros(1, np.uint8), np.full(1, -1, np.int32), np.array([top.share], np.float32))
    bins = np.frombuffer(b"".join(drawn["bins"]), np.uint8).reshape(len(about), -1)
    rest = None if depth is None else depth - top.levels[node]
    return grow(bins, about & 1, about >> 1, top.keys[node], rest, top.weights)


def _turns(table: DataFrame, forest: Forest, folds: int) -> tuple[int, list[list[tuple]]]:
    """Rows, and the forests' trees as (fold, tree, weights, share) in groups of ``PAIRS`` rows of trees
    at most, if that is one tree. What is shuffled at a time follows from that bound, not from the trees."""
    rows = table.count()
    own = _fold_weights(table, forest.balanced, folds)
    turns = [(fold, tree, *own[fold]) for tree in range(forest.trees) for fold in range(folds)]
    size = max(1, PAIRS // max(rows, 1))
    return rows, [turns[start : start + size] for start in range(0, len(turns), size)]


def fold_forests(table: DataFrame, forest: Forest, folds: int) -> DataFrame:
    """(``fold``, ``tree``, ``feature``, ``cut``, ``left``, ``value``) of every tree of the forest that
    each fold is held out of, as bytes; staged. ``table`` is as of ``binned``.

    For forests that are to be kept; a tree has up to two nodes of ten bytes a drawn row.
    """
    rows, groups = _turns(table, forest, folds)
    shape, parts = "feature binary, cut binary, left binary, value binary", []
    for turns in groups if rows else [[]]:
        tops = _tops(table, forest, turns, rows)

        def piece(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            tree = _grown(tops[key[0]], key[1], rows, forest.depth)
            arrays = (tree.feature, tree.cut, tree.left, tree.value)
            return pd.DataFrame([(*key, *(array.tobytes() for array in arrays))])

        def whole(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
            top = tops[key[0]]
            tree = top.arrays()
            found, size = [tree], len(tree.left)
            for row in pieces[pieces["node"] >= 0].sort_values("node").itertuples():
                kinds = (np.uint8, np.uint8, np.int32, np.float32)
                own = [np.frombuffer(blob, kind) for blob, kind in zip(row[3:], kinds, strict=True)]
                left = np.where(own[2] >= 0, own[2] + size - 1, -1)
                tree.feature[row.node], tree.cut[row.node], tree.left[row.node], tree.value[row.node] = own[0][0], own[1][0], left[0], own[3][0]
                found.append(Tree(own[0][1:], own[1][1:], left[1:].astype(np.int32), own[3][1:]))
                size += len(left) - 1
            arrays = (np.concatenate([getattr(one, name) for one in found]).tobytes() for name in ("feature", "cut", "left", "value"))
            return pd.DataFrame([(top.fold, top.tree, *arrays)])

        pieces = _dealt(table, tops, False).groupBy("place", "node").applyInPandas(piece, f"place int, node int, {shape}")
        # Trees without such nodes have a line, too.
        lines = table.sparkSession.createDataFrame([(place, -1, *[bytearray()] * 4) for place in range(len(tops))], pieces.schema)
        trees = pieces.unionByName(lines).groupBy("place").applyInPandas(whole, f"fold int, tree int, {shape}")
        parts.append(storage.stage(trees, "forests"))
    return reduce(DataFrame.unionByName, parts)


def _score_blobs(row: np.ndarray, score: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """(chunk, places in it, scores) of rows by their numbers."""
    for chunk, places in _by_value(row >> 16):
        yield chunk, (row[places] & 0xFFFF).astype(np.uint16).tobytes(), score[places].tobytes()


def held_out_scores(rows: DataFrame, names: list[str], keys: list[str], label: str, forest: Forest, folds: int) -> DataFrame:
    """(``fold``, ``label``, ``score``) of every row, scored by the forest its fold is held out of.

    ``rows`` has its ``fold`` (0 to folds - 1). A row is scored by the task that grows the part of a
    tree it falls into, so no tree is ever in one place; scores are added up in chunks of 65,536 rows.
    """
    known = F.coalesce(label, F.raise_error(F.lit("labels must not be null")))
    table = binned(rows.withColumn(label, known), names, keys, label)
    count, groups = _turns(table, forest, folds)
    if not count:
        return table.select("fold", "label", F.lit(0.0).alias("score"))
    tasks = min(math.ceil(count * len(groups[0]) / TASK_PAIRS), 2 * rows.sparkSession.sparkContext.defaultParallelism)
    if tasks > table.rdd.getNumPartitions():
        spread = storage.stage(table.repartition(tasks), "binned")
        storage.discard(table)
        table = spread
    shape = "chunk long, at binary, score binary, fold binary, label binary"
    names_ = ["chunk", "at", "score", "fold", "label"]

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, fold, own, _, row in _rows(batches):
            found = []
            for chunk, places in _by_value(row >> 16):
                at, zeros = (row[places] & 0xFFFF).astype(np.uint16), np.zeros(len(places), np.int64)
                found.append((chunk, at.tobytes(), zeros.tobytes(), fold[places].astype(np.int32).tobytes(), own[places].astype(np.int32).tobytes()))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(found, columns=names_), preserve_index=False)

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total, about = np.zeros(1 << 16, np.int64), np.full((2, 1 << 16), -1, np.int32)
        for part in parts.itertuples():
            at = np.frombuffer(part.at, np.uint16)
            total[at] += np.frombuffer(part.score, np.int64)
            if part.fold:
                about[0, at], about[1, at] = np.frombuffer(part.fold, np.int32), np.frombuffer(part.label, np.int32)
        at = np.flatnonzero(about[0] >= 0)
        blobs = at.astype(np.uint16).tobytes(), total[at].tobytes(), about[0, at].tobytes(), about[1, at].tobytes()
        return pd.DataFrame([(*key, *blobs)], columns=names_)

    state = table.mapInArrow(begin, shape)
    for turns in groups:
        tops = _tops(table, forest, turns, count)
        shared = rows.sparkSession.sparkContext.broadcast(tops)

        def finished(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trees = [(top, top.arrays()) for top in shared.value]
            for _, fold, _, bins, row in _rows(batches):
                total = np.zeros(len(row), np.int64)
                for top, tree in trees:
                    held = np.flatnonzero(fold == top.fold)
                    node = tree.ends(bins[held])
                    total[held] += np.where(tree.left[node] == -1, np.rint(tree.value[node].astype(np.float64) * UNIT), 0).astype(np.int64)
                found = [(*blobs, b"", b"") for blobs in _score_blobs(row, total)]
                yield pa.RecordBatch.from_pandas(pd.DataFrame(found, columns=names_), preserve_index=False)

        def score(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
            tree = _grown(shared.value[key[0]], key[1], parts, forest.depth)
            held = parts[parts["held"] == 1]
            row = np.frombuffer(b"".join(held["about"]), np.int64)
            cells = np.frombuffer(b"".join(held["bins"]), np.uint8).reshape(len(row), len(names))
            found = np.rint(tree.predict(cells).astype(np.float64) * UNIT).astype(np.int64)
            return pd.DataFrame([(*blobs, b"", b"") for blobs in _score_blobs(row, found)], columns=names_)

        scored = _dealt(table, tops, True).groupBy("place", "node").applyInPandas(score, shape)
        if any(left == -1 for top in tops for left in top.left):
            scored = scored.unionByName(table.mapInArrow(finished, shape))
        before, state = state, storage.stage(state.unionByName(scored).groupBy("chunk").applyInPandas(add, shape), "score-sums")
        storage.discard(before) if turns is not groups[0] else None
        shared.destroy()

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                fold, own = (np.frombuffer(batch.column(at)[place].as_py(), np.int32) for at in (3, 4))
                total = np.frombuffer(batch.column(2)[place].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(fold), pa.array(own), pa.array(total / (UNIT * forest.trees))], ["fold", "label", "score"])

    return storage.stage(state.mapInArrow(scores, "fold int, label int, score double"), "held-out")


def _walk(flat: np.ndarray, rows: np.ndarray, count: int, feature: np.ndarray, cut: np.ndarray, steps: int) -> np.ndarray:
    """Each row's node after ``steps`` levels, as its place in that level. ``flat`` has the bins of
    ``count`` rows, column by column."""
    node = np.zeros(len(rows), np.int64)
    columns, first = feature.astype(np.int64) * count, 0
    for level in range(steps):
        here = slice(first, first + (1 << level))
        above = flat.take(columns[here].take(node) + rows) > cut[here].take(node)
        node += node
        node += above
        first += 1 << level
    return node


@dataclass
class LevelForest:
    """Trees of one depth, a line each, with the nodes of each level behind those of the one above.

    Rows whose bin of ``feature`` is above ``cut`` go to the second child; a node that is not split
    has the cut 255, which none is above. ``value`` is the share of label 1 in each last node.
    """

    names: list[str]
    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    importances: np.ndarray

    def shares(self, cells: np.ndarray) -> np.ndarray:
        """The mean over the trees of the share of label 1 where a row of ``cells`` ends."""
        steps, total = self.value.shape[1].bit_length() - 1, np.zeros(len(cells))
        flat, rows = np.ascontiguousarray(cells.T).ravel(), np.arange(len(cells))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            total += value.take(_walk(flat, rows, len(rows), feature, cut, steps))
        return total / len(self.feature)

    def score(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with the forest's share of label 1."""
        shared = rows.sparkSession.sparkContext.broadcast(self)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                model = shared.value
                values = [batch.column(one).to_numpy(zero_copy_only=False) for one in model.names]
                found = pa.array(model.shares(cells_of(values, model.edges)))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

        return rows.mapInArrow(scan, StructType([*rows.schema.fields, StructField(name, DoubleType())]))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Draws, labels and bins (column by column) of about ``CHUNK_ROWS`` rows at a time."""
    held, size = [], 0

    def joined():
        table = pa.Table.from_batches(held).combine_chunks()
        bins = np.frombuffer(b"".join(table["bins"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
        return table["draw"].to_numpy().view(np.uint64), table["label"].to_numpy().astype(np.int64), np.ascontiguousarray(bins.T).ravel()

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHUNK_ROWS:
            yield joined()
            held, size = [], 0
    if size:
        yield joined()


def _best_splits(counts: np.ndarray, chosen: np.ndarray, weights: tuple[float, float]) -> tuple[np.ndarray, ...]:
    """Column, cut and gain of each node, and the weighted (label 1, all) of the children in turn.

    ``counts`` has, for each chosen column, the rows of each node by bin and label.
    """
    zeros, ones = (counts[..., label] * weights[label] for label in (0, 1))
    all_ = (zeros + ones).cumsum(axis=2)
    ones = ones.cumsum(axis=2)
    total, total_ones = all_[0, :, -1], ones[0, :, -1]
    rest, rest_ones = all_[:, :, -1:] - all_, ones[:, :, -1:] - ones
    parted = (all_ > 1e-9 * total[:, None]) & (rest > 1e-9 * total[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        purity = (ones**2 + (all_ - ones) ** 2) / all_ + (rest_ones**2 + (rest - rest_ones) ** 2) / rest
        before = (total_ones**2 + (total - total_ones) ** 2) / total
    gain = np.where(parted, purity - before[:, None], -np.inf)
    nodes = np.arange(counts.shape[1])
    place = gain.transpose(1, 0, 2).reshape(len(nodes), -1).argmax(axis=1)
    turn, cut = place // BINS, place % BINS
    gain = gain[turn, nodes, cut]
    split = gain > 1e-9 * total
    left = np.where(split, all_[turn, nodes, cut], total)
    left_ones = np.where(split, ones[turn, nodes, cut], total_ones)
    sides = np.stack([left_ones, left, total_ones - left_ones, total - left], axis=1).reshape(-1, 2)
    return np.where(split, chosen[nodes, turn], 0), np.where(split, cut, 255), np.where(split, gain, 0.0), sides


def fit_levels(
    table: DataFrame, names: list[str], edges: list[np.ndarray], trees: int, depth: int, weights: tuple[float, float], seed: int
) -> LevelForest:
    """A forest from all rows of ``table`` (as of ``binned``) with ``weights`` of the labels 0 and 1.

    Each node looks at a random choice of the square root of the columns and is split if that gains
    purity. Importances are the gains by column, each tree's adding up to one.
    """
    spark = table.sparkSession
    rng = np.random.default_rng(seed)
    # A row's draws for two trees are products with different odd numbers.
    odd = rng.integers(0, 1 << 63, trees).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    tried = max(1, int(math.sqrt(len(names))))
    feature, cut = np.zeros((trees, (1 << depth) - 1), np.uint8), np.full((trees, (1 << depth) - 1), 255, np.uint8)
    gains, value = np.zeros((trees, len(names))), np.zeros((trees, 1 << depth))
    source = table.select("draw", "label", "bins")
    for level in range(depth):
        nodes = 1 << level
        chosen = rng.random((trees, nodes, len(names))).argsort(axis=2)[:, :, :tried]
        shared = spark.sparkContext.broadcast((feature, cut, chosen))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            feature, cut, chosen = shared.value
            size = nodes * BINS * 2
            total = None
            for draw, label, flat in _chunks(batches):
                if total is None:
                    total = np.zeros((trees, tried, size))
                for tree in range(trees):
                    weight = DRAWN.take(((draw * odd[tree]) >> np.uint64(48)).view(np.int64))
                    rows = np.flatnonzero(weight != 0)
                    weight = weight.take(rows).astype(np.float64)
                    node = _walk(flat, rows, len(draw), feature[tree], cut[tree], level)
                    cell = node * (2 * BINS) + label.take(rows)
                    for turn in range(tried):
                        column = chosen[tree, :, turn] * len(draw)
                        bins = flat.take(column.take(node) + rows).astype(np.int64)
                        bins += bins
                        bins += cell
                        total[tree, turn] += np.bincount(bins, weight, size)
            for tree in range(trees) if total is not None else ():
                blob = total[tree].astype(np.int64).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([blob], pa.binary())], ["tree", "counts"])

        def split(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
            counts = sum(np.frombuffer(blob, np.int64) for blob in parts["counts"]).reshape(tried, nodes, BINS, 2)
            found = _best_splits(counts, shared.value[2][key[0]], weights)
            kinds = (np.uint8, np.uint8, np.float64, np.float64)
            return pd.DataFrame([(key[0], *(array.astype(kind).tobytes() for array, kind in zip(found, kinds, strict=True)))])

        sums = source.mapInArrow(count, "tree int, counts binary")
        schema = "tree int, feature binary, cut binary, gain binary, sides binary"
        here = slice(nodes - 1, 2 * nodes - 1)
        for row in sums.groupBy("tree").applyInPandas(split, schema).collect():
            feature[row.tree, here] = np.frombuffer(row.feature, np.uint8)
            cut[row.tree, here] = np.frombuffer(row.cut, np.uint8)
            np.add.at(gains[row.tree], feature[row.tree, here], np.frombuffer(row.gain))
            sides = np.frombuffer(row.sides).reshape(-1, 2)
            if level == depth - 1:
                value[row.tree] = np.divide(sides[:, 0], sides[:, 1], out=np.zeros(len(sides)), where=sides[:, 1] > 0)
                # What is left after a side is taken off may be off by a rounding.
                value[row.tree] = value[row.tree].clip(0.0, 1.0)
        shared.unpersist()
    totals = gains.sum(axis=1, keepdims=True)
    shares = np.divide(gains, totals, out=np.zeros_like(gains), where=totals > 0).sum(axis=0)
    return LevelForest(names, edges, feature, cut, value, shares / shares.sum() if shares.any() else shares)
