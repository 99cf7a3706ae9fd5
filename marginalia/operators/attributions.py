"""Shapley attributions of boosted-tree scores.

A leaf is reached only if every feature on its path allows it, so its part of the score is a
product over at most as many features as the tree is deep. Such a product game has closed
Shapley values: an absent feature contributes the share of training rows its tests let through.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia import storage
from marginalia.operators.boosting import Boosted
from marginalia.operators.models import Fitted

# Features of a leaf up to which its attributions are tabulated for every way to allow it.
TABLED = 8


def leaf_rules(fitted: Fitted) -> list[tuple[float, list[tuple[int, float, float, float]]]]:
    """Every leaf as (weighted value, [(feature, above, up to, share let through)]).

    The node table is read back from a saved copy of the model. Its size is set by the number
    of trees and their depth, not by the data.
    """
    if isinstance(fitted.model, Boosted):
        return fitted.model.leaves()
    spark = fitted.scored.sparkSession
    trees = fitted.model.stages[-1]
    path = storage.new_path(spark, "trees")
    trees.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    tables: dict[int, dict[int, object]] = {}
    for node in nodes:
        tables.setdefault(node.treeID, {})[node.id] = node
    leaves = []
    for tree, table in tables.items():
        weight = trees.treeWeights[tree]
        todo = [(0, {})]
        while todo:
            number, path_rules = todo.pop()
            node = table[number]
            if node.leftChild < 0:
                rules = [(f, lo, hi, share) for f, (lo, hi, share) in path_rules.items()]
                leaves.append((weight * node.prediction, rules))
                continue
            feature = node.split.featureIndex
            cut = node.split.leftCategoriesOrThreshold[0]
            lo, hi, share = path_rules.get(feature, (-np.inf, np.inf, 1.0))
            for child, bounds in (
                (node.leftChild, (lo, min(hi, cut))),
                (node.rightChild, (max(lo, cut), hi)),
            ):
                through = share * table[child].rawCount / node.rawCount
                todo.append((child, {**path_rules, feature: (*bounds, through)}))
    return leaves


def product_parts(value: float, shares: list[float], allowed: np.ndarray) -> np.ndarray:
    """Shapley values of one leaf's features, a line each, for columns of ``allowed`` (0 or 1)."""
    m = len(shares)
    parts = np.zeros(allowed.shape)
    for j in range(m):
        # Coefficients of prod (allowed * z + share) over the other features:
        # the one of z^s sums the coalitions of size s.
        sums = [np.ones(allowed.shape[1])]
        for i in range(m):
            if i == j:
                continue
            grown = [c * shares[i] for c in sums] + [np.zeros(allowed.shape[1])]
            for s, c in enumerate(sums):
                grown[s + 1] = grown[s + 1] + c * allowed[i]
            sums = grown
        # Shapley weight of a coalition of s among m features: s! (m - s - 1)! / m!.
        total = sum(c / (m * comb(m - 1, s)) for s, c in enumerate(sums))
        parts[j] = value * (allowed[j] - shares[j]) * total
    return parts


def tabulated(leaves: list[tuple[float, list[tuple[int, float, float, float]]]], width: int) -> tuple[list[np.ndarray], list]:
    """The cuts of each feature, and every leaf as (feature, above, up to) by places among the cuts,
    its value and shares, and its ``product_parts`` for all ways in which its features may allow it.

    A leaf of more than ``TABLED`` features has no such table.
    """
    cuts = [np.unique([bound for _, rules in leaves for f, *bounds, _ in rules if f == own for bound in bounds]) for own in range(width)]
    found = []
    for value, rules in leaves:
        m, shares = len(rules), [rule[3] for rule in rules]
        places = [(f, np.searchsorted(cuts[f], lo), np.searchsorted(cuts[f], hi)) for f, lo, hi, _ in rules]
        ways = (np.arange(1 << m) >> np.arange(m)[:, None]) & 1 if m <= TABLED else None
        found.append((places, value, shares, None if ways is None else product_parts(value, shares, ways.astype(float))))
    return cuts, found


def attributions(fitted: Fitted, key: str) -> DataFrame:
    """Per scored row: base value, margin and one attribution per feature, which add up."""
    names = fitted.features
    leaves = leaf_rules(fitted)
    spark = fitted.scored.sparkSession
    width = len(names)
    shared = spark.sparkContext.broadcast(tabulated(leaves, width))
    base = float(sum(value * np.prod([rule[3] for rule in rules]) for value, rules in leaves))

    def explain(batches):
        cuts, found = shared.value
        for batch in batches:
            x = batch[names].to_numpy(dtype=float)
            # A row's place among the cuts of each feature: above those before it. Missing numbers
            # are in no range.
            at = [np.searchsorted(own, column) for own, column in zip(cuts, x.T, strict=True)]
            at = [np.where(np.isnan(column), len(own), place).astype(np.int32) for own, column, place in zip(cuts, x.T, at, strict=True)]
            parts = np.zeros((width, len(x)))
            for places, value, shares, table in found:
                allowed = [(at[f] > lo) & (at[f] <= hi) for f, lo, hi in places]
                if table is None:
                    own = product_parts(value, shares, np.array(allowed, float).reshape(len(places), len(x)))
                else:
                    way = np.zeros(len(x), np.uint16)
                    for j, one in enumerate(allowed):
                        way |= one.astype(np.uint16) << np.uint16(j)
                    way = way.astype(np.intp)
                    own = (line.take(way) for line in table)
                for (f, _, _), part in zip(places, own, strict=True):
                    parts[f] += part
            out = pd.DataFrame({key: batch[key].to_numpy(), "base_value": base})
            out["margin"] = base + parts.sum(axis=0)
            for i, name in enumerate(names):
                out[f"phi_{name}"] = parts[i]
            yield out

    kind = dict(fitted.scored.dtypes)[key]
    shape = ", ".join(
        [f"{key} {kind}", "base_value double", "margin double"]
        + [f"phi_{name} double" for name in names]
    )
    return fitted.scored.select(key, *names).mapInPandas(explain, shape)


def attribution_summary(explained: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature."""
    names = [name for name in explained.columns if name.startswith("phi_")]
    means = explained.agg(*[F.avg(F.abs(name)).alias(name) for name in names])
    cells = ", ".join(f"'{name.removeprefix('phi_')}', {name}" for name in names)
    table = means.select(F.expr(f"stack({len(names)}, {cells}) AS (feature, mean_abs)"))
    return table.orderBy(F.col("mean_abs").desc(), "feature")
