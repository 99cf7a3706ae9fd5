"""Boosted trees against plain definitions: splits, residuals, tasks and folds."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.operators import boosting, models
from marginalia.operators.boosting import Boosting

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    a, b, c = rng.random(4000), rng.normal(size=4000), rng.integers(0, 4, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-4 * (a - 0.5) - 2 * b))).astype(int)
    made = [(i, float(a[i]), float(b[i]), int(c[i]), int(y[i])) for i in range(4000)]
    return spark.createDataFrame(made, "id long, a double, b double, c int, y int").repartition(5)


def fitted(rows, weights, **kind):
    table, edges = boosting.binned(rows, NAMES, ["id"], "y")
    return boosting.fit(table, NAMES, edges, Boosting(**kind), weights)


def plain(x, y, weight, edges, rounds, rate, depth):
    """Margins of boosted trees by trying every edge of every column in every node."""
    margin, sign = np.zeros(len(y)), 2.0 * y - 1
    for turn in range(rounds):
        residual = 4 * sign / (1 + np.exp(2 * sign * margin)) if turn else sign
        out = np.zeros(len(y))

        def mean(some, residual=residual):
            return (weight[some] * residual[some]).sum() / weight[some].sum()

        def split(some, left, out=out, mean=mean):
            best = None
            for column in range(x.shape[1]) if left else ():
                for edge in edges[column]:
                    sides = some & (x[:, column] <= edge), some & (x[:, column] > edge)
                    if not all(side.any() for side in sides):
                        continue
                    gain = sum(weight[side].sum() * mean(side) ** 2 for side in sides) - weight[some].sum() * mean(some) ** 2
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-6):
                        best = gain, sides
            if best is None:
                out[some] = mean(some)
            else:
                for side in best[1]:
                    split(side, left - 1)

        split(np.ones(len(y), bool), depth)
        margin += (rate if turn else 1.0) * out
    return margin


def test_trees_are_those_of_the_definition(rows):
    some = rows.withColumn("fold", F.lit(-1))
    (model,) = fitted(some, [(1.0, 3.0)], rounds=4, rate=0.3, depth=3)
    given = some.orderBy("id").toPandas()
    x, y = given[NAMES].to_numpy(float), given["y"].to_numpy()
    expected = plain(x, y, np.where(y == 1, 3.0, 1.0), model.edges, 4, 0.3, 3)
    scored = {row.id: row.rawPrediction[1] for row in model.transform(rows).collect()}
    assert [scored[one] for one in given["id"]] == pytest.approx(list(expected), abs=1e-4)


def test_tasks_make_no_difference(rows, monkeypatch):
    """Before, each fit was a chain of jobs per fold; now one pass serves all folds, spread or not."""
    kind = {"rounds": 5, "rate": 0.1, "depth": 3, "row_share": 0.7, "column_share": 0.5}
    numbered = rows.withColumn("fold", (F.col("id") % 3).cast("int"))
    one_task = fitted(numbered, [(1.0, 1.0)] * 3, **kind)
    for limit in (("TASK_ROWS", 1500), ("BLOCK_ROWS", 300), ("KEPT_ROUNDS", 2), ("FEW_TASKS", 3)):
        monkeypatch.setattr(boosting, *limit)
    for one, other in zip(one_task, fitted(numbered, [(1.0, 1.0)] * 3, **kind), strict=True):
        for name in ("feature", "cut", "value", "rows", "importances"):
            assert np.array_equal(getattr(one, name), getattr(other, name)), name


def test_folds_do_not_see_their_rows(rows):
    numbered = rows.withColumn("fold", (F.col("id") % 2).cast("int"))
    both = fitted(numbered, [(1.0, 1.0)] * 2, rounds=3, depth=2)
    table, _ = boosting.binned(numbered, NAMES, ["id"], "y")
    for own in (0, 1):
        assert (both[own].rows[:, 0] == table.where(F.col("fold") != own).count()).all()
    scores = models.cross_validate(rows, NAMES, ["id"], "y", Boosting(rounds=20, depth=3), folds=3)
    assert {row.metric: row["mean"] for row in scores.collect()}["auc"] > 0.8


def test_missing_numbers_are_an_error(rows):
    holed = rows.withColumn("a", F.when(F.col("id") > 0, F.col("a"))).withColumn("fold", F.lit(-1))
    with pytest.raises(Exception, match="must not be null"):
        fitted(holed, [(1.0, 1.0)], rounds=1, depth=2)


def test_leaves_give_the_margins(rows):
    """A node whose few columns part nothing is a leaf, for its scores and for its rules."""
    flat = rows.withColumns({"b": F.lit(1.0), "c": F.lit(2), "fold": F.lit(-1)})
    (model,) = fitted(flat, [(1.0, 1.0)], rounds=8, depth=4, column_share=0.3)
    given = flat.orderBy("id").limit(200).toPandas()
    x = given[NAMES].to_numpy(float)
    total = np.zeros(len(x))
    for value, rules in model.leaves():
        total += value * np.all([(lo < x[:, f]) & (x[:, f] <= hi) for f, lo, hi, _ in rules] or [np.ones(len(x), bool)], axis=0)
    scored = {row.id: row.rawPrediction[1] for row in model.transform(flat).collect()}
    assert [scored[one] for one in given["id"]] == pytest.approx(list(total), abs=1e-9)
