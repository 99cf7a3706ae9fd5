"""The forest against plain definitions: cuts, purity of leaves, folds, repeatability."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.operators import forest, models


def plain_best(bins, label, weight, column):
    """The cut of a column with the least weighted Gini impurity."""
    best = None
    for cut in range(bins[:, column].max()):
        sides = [bins[:, column] <= cut, bins[:, column] > cut]
        if not all(weight[side].sum() for side in sides):
            continue
        impurity = 0.0
        for side in sides:
            share = weight[side] @ label[side] / weight[side].sum()
            impurity += weight[side].sum() * 2 * share * (1 - share)
        if best is None or impurity < best[0] - 1e-9:
            best = (impurity, cut)
    return best


def test_first_cut_is_the_best_one():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 40, (500, 1)).astype(np.uint8)
    label = (rng.random(500) < bins[:, 0] / 60).astype(int)
    weight = rng.integers(0, 4, 500).astype(float)
    tree = forest.grow(bins, label, weight, np.random.default_rng(1), depth=1)
    assert tree.left.tolist() == [1, -1, -1]
    assert tree.cut[0] == plain_best(bins, label, weight, 0)[1]
    low = bins[:, 0] <= tree.cut[0]
    assert tree.value[1] == pytest.approx(weight[low] @ label[low] / weight[low].sum())


def test_full_trees_learn_every_row():
    rng = np.random.default_rng(5)
    bins = np.unique(rng.integers(0, 60, (3000, 4)).astype(np.uint8), axis=0)
    label = rng.integers(0, 2, len(bins))
    tree = forest.grow(bins, label, np.ones(len(bins)), np.random.default_rng(2))
    assert (tree.predict(bins) == label).all()
    # Equal rows of both labels end in one leaf with their share.
    twice = np.repeat(bins[:1], 4, axis=0)
    tree = forest.grow(twice, np.array([1, 0, 0, 0]), np.ones(4), np.random.default_rng(2))
    assert tree.left.tolist() == [-1] and tree.value[0] == pytest.approx(0.25)


def test_columns_without_news_are_passed_over():
    bins = np.zeros((200, 9), np.uint8)
    bins[100:, 8] = 1
    label = (np.arange(200) >= 100).astype(int)
    tree = forest.grow(bins, label, np.ones(200), np.random.default_rng(0))
    assert (tree.predict(bins) == label).all()


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(9)
    data = []
    for key in range(3000):
        x, y, z = rng.random(3)
        odds = 0.9 if x > 0.6 and y < 0.5 else 0.1
        data.append((key, float(x), float(y), None if key % 50 == 0 else float(z), int(rng.random() < odds), key % 3))
    return spark.createDataFrame(data, "key long, x double, y double, z double, label int, fold int")


def test_scores_are_held_out_and_repeatable(spark, rows):
    grown = forest.Forest(trees=20, fit_rows=900)
    scored = [forest.held_out_scores(rows, ["x", "y", "z"], ["key"], "label", grown, 3) for _ in range(2)]
    first, second = (sorted(map(tuple, table.collect())) for table in scored)
    assert first == second and len(first) == 3000
    table = forest.binned(rows, ["x", "y", "z"], ["key"], "label")
    trees = forest.fold_forests(table, grown, 3).groupBy("fold").count().collect()
    assert {(row.fold, row["count"]) for row in trees} == {(0, 20), (1, 20), (2, 20)}
    metrics = {row.fold: row for row in models.fold_metrics(scored[0]).collect()}
    # Label 1 is drawn with odds of 0.9 or 0.1, so the best possible area is about 0.88.
    assert all(0.8 < row.auc < 0.93 for row in metrics.values())


def test_one_class_and_empty_table(spark, rows):
    grown = forest.Forest(trees=3)
    same = forest.held_out_scores(rows.where("label = 1"), ["x", "y", "z"], ["key"], "label", grown, 3)
    assert {row.score for row in same.collect()} == {1.0}
    assert forest.held_out_scores(rows.where("key < 0"), ["x", "y", "z"], ["key"], "label", grown, 3).count() == 0


def test_levels_use_every_row_and_split_like_plain_counts(spark, rows):
    names, rows = ["x", "y", "z"], rows.fillna(0.0)
    edges = forest.bin_edges(rows, names)
    table = forest.binned(rows, names, ["key"], "label", edges)
    found = forest.fit_levels(table, names, edges, 30, 1, (1.0, 3.0), 5)
    again = forest.fit_levels(table.repartition(7), names, edges, 30, 1, (1.0, 3.0), 5)
    assert (found.feature == again.feature).all() and (found.cut == again.cut).all() and (found.value == again.value).all()
    held = table.toPandas()
    bins = np.stack([np.frombuffer(value, np.uint8) for value in held["bins"]])
    draw, label = held["draw"].to_numpy().view(np.uint64), held["label"].to_numpy()
    rng = np.random.default_rng(5)
    odd = rng.integers(0, 1 << 63, 30).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for tree in range(30):
        times = forest.DRAWN[(draw * odd[tree]) >> np.uint64(48)]
        assert 0.9 < times.mean() < 1.1
        above = bins[:, found.feature[tree, 0]] > found.cut[tree, 0]
        weight = times * np.where(label == 1, 3.0, 1.0)
        for side in (0, 1):
            mine = above == side
            assert found.value[tree, side] == pytest.approx((weight * label)[mine].sum() / weight[mine].sum())


def test_level_forest_scores_near_the_best_area(spark, rows):
    names, rows = ["x", "y", "z"], rows.fillna(0.0)
    edges = forest.bin_edges(rows, names)
    table = forest.binned(rows.where("fold > 0"), names, ["key"], "label", edges)
    found = forest.fit_levels(table, names, edges, 20, 5, (1.0, 1.0), 5)
    assert found.importances.sum() == pytest.approx(1) and found.importances.argmin() == 2
    scored = found.score(rows.where("fold = 0"), "score")
    assert 0.8 < models.fold_metrics(scored).first().auc < 0.93
    one = forest.fit_levels(table.where("label = 1"), names, edges, 3, 2, (1.0, 1.0), 5)
    assert {row.score for row in one.score(rows, "score").collect()} == {1.0} and not one.importances.any()


def test_returns_are_fitted_without_a_draw_per_line_and_tree(spark, lines):
    fitted = models.fit_returns(lines, trees=6, depth=3)
    assert isinstance(fitted.model, forest.LevelForest) and fitted.model.feature.shape == (6, 7)
    scored = fitted.scored.collect()
    assert scored and all(0 <= row.return_prob <= 1 and row.prediction == (row.return_prob >= 0.5) for row in scored)
    assert abs(sum(row.importance for row in models.feature_importance(fitted).collect()) - 1) < 1e-9


def test_a_line_without_a_label_is_refused(spark, lines):
    unlabelled = lines.withColumn("discount", F.when(F.col("order_id") % 2 == 0, F.col("discount")))
    with pytest.raises(Exception, match="labels must not be null"):
        models.fit_returns(unlabelled, trees=2, depth=2)


def test_trees_see_all_rows_whatever_a_task_holds(spark, rows, monkeypatch):
    """A table beyond ``fit_rows`` was dealt into blocks, each tree saw one of them, and what was left
    over after a block a tree was dropped."""
    names = ["x", "y", "z"]
    table = forest.binned(rows, names, ["key"], "label")
    held = table.toPandas()
    bins = np.stack([np.frombuffer(value, np.uint8) for value in held["bins"]])
    draw, label = held["draw"].to_numpy().view(np.uint64), held["label"].to_numpy()
    found, scores = [], []
    for fit_rows in (100_000, 500):
        monkeypatch.setattr(forest, "PAIRS", 1 << 27 if fit_rows > 500 else 4 * 3000)
        grown = forest.Forest(trees=2, fit_rows=fit_rows)
        trees = {}
        for row in forest.fold_forests(table, grown, 3).collect():
            kinds = {"feature": np.uint8, "cut": np.uint8, "left": np.int32, "value": np.float32}
            trees[row.fold, row.tree] = forest.Tree(*(np.frombuffer(row[name], kind) for name, kind in kinds.items()))
        found.append({key: (len(tree.left), tree.value[0], tree.predict(bins).tolist()) for key, tree in trees.items()})
        scores.append(sorted(map(tuple, forest.held_out_scores(rows, names, ["key"], "label", grown, 3).collect())))
    assert found[0] == found[1] and len(found[0]) == 6
    assert scores[0] == scores[1] and len(scores[0]) == 3000
    # The root of a tree has the bootstrap of all rows of the other folds.
    for (fold, tree), (_, share, predicted) in found[0].items():
        odd = np.uint64(np.random.default_rng([42, fold, tree]).integers(0, 1 << 63)) * np.uint64(2) + np.uint64(1)
        times = np.where(held["fold"] == fold, 0, forest.DRAWN[(draw * odd) >> np.uint64(48)])
        sizes = np.bincount(label[held["fold"] != fold], minlength=2)
        weight = times * (sizes.sum() / (2 * sizes))[label]
        assert share == pytest.approx((weight * label).sum() / weight.sum())
        # Trees of full depth know nearly every row they were grown from.
        assert (np.array(predicted)[times > 0].round() == label[times > 0]).mean() > 0.98


def test_forest_of_a_few_rows_and_missing_labels(spark, rows):
    few = forest.held_out_scores(rows.where("key < 4"), ["x", "y", "z"], ["key"], "label", forest.Forest(trees=5), 3)
    assert few.count() == 4 and all(0 <= row.score <= 1 for row in few.collect())
    with pytest.raises(Exception, match="labels must not be null"):
        unknown = rows.withColumn("label", F.when(F.col("key") > 5, F.col("label")))
        forest.held_out_scores(unknown, ["x", "y", "z"], ["key"], "label", forest.Forest(trees=2), 3).count()
