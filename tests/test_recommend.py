from __future__ import annotations

import numpy as np
import pytest

from marginalia.operators import recommend


def brute_force(rows, k):
    """The k nearest by rounded cosine, ties to the lower id, for customers who bought."""
    ids = sorted({c for c, _, _ in rows})
    items = sorted({i for _, i, _ in rows})
    matrix = np.zeros((len(ids), len(items)))
    for c, i, v in rows:
        matrix[ids.index(c), items.index(i)] += v
    norms = np.linalg.norm(matrix, axis=1)
    ids = [c for c, n in zip(ids, norms) if n > 0]
    unit = matrix[norms > 0] / norms[norms > 0][:, None]
    near = np.round(unit @ unit.T, 9)
    best = {}
    for a, c in enumerate(ids):
        order = sorted((-near[a, b], d) for b, d in enumerate(ids) if d != c)
        best[c] = [(d, pytest.approx(-s, abs=2e-9)) for s, d in order[:k]]
    return best


def purchases(spark, rows):
    return spark.createDataFrame(rows, "customer_id bigint, sub_category string, sales double")


def found(df):
    best = {}
    for row in df.orderBy("customer_id", "rank").collect():
        best.setdefault(row.customer_id, []).append((row.neighbour_id, row.similarity))
    return best


@pytest.mark.parametrize(("block_rows", "area_blocks"), [(8, 1), (8, 3), (40, 2), (2048, 32)])
def test_neighbours_are_exact_for_any_block_size(spark, block_rows, area_blocks):
    rng = np.random.default_rng(7)
    rows = []
    for customer in range(150):
        for item in rng.choice(6, size=rng.integers(1, 5), replace=False):
            rows.append((customer, f"item{item}", float(rng.integers(1, 40))))
    result = recommend.similar_customers(purchases(spark, rows), 5, block_rows, area_blocks)
    assert found(result) == brute_force(rows, 5)


def test_a_third_of_all_customers_may_be_copies(spark):
    rng = np.random.default_rng(11)
    rows = [(c, "a", 3.0) for c in range(0, 120, 3)] + [(c, "b", 4.0) for c in range(0, 120, 3)]
    for customer in range(120):
        if customer % 3:
            rows += [(customer, item, float(rng.integers(1, 9))) for item in "abc"]
    result = recommend.similar_customers(purchases(spark, rows), 4, 16, 2)
    assert found(result) == brute_force(rows, 4)


def test_customers_without_spending_have_no_neighbours(spark):
    rows = [(1, "a", 1.0), (2, "a", 2.0), (3, "b", 0.0)]
    assert found(recommend.similar_customers(purchases(spark, rows), 3, 8)) == {
        1: [(2, 1.0)],
        2: [(1, 1.0)],
    }


def test_recommendations_rank_unbought_items(spark):
    rows = [
        (1, "a", 10.0), (1, "z", 0.0), (2, "a", 10.0), (2, "b", 5.0), (3, "a", 1.0), (3, "c", 9.0),
        (4, "d", 1.0),
    ]
    near = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.5)], "customer_id bigint, neighbour_id bigint, similarity double")
    offers = recommend.recommend(purchases(spark, rows), near, 4).where("customer_id = 1")
    found = [(r.sub_category, r.score) for r in offers.orderBy("rank").collect()]
    assert found == [("b", 4.5), ("c", 4.5), ("d", 0.0), ("z", 0.0)]


def test_copurchase_counts_absent_pairs_as_zero(spark):
    rows = [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (3, "b", 1.0), (4, "a", 2.0), (4, "b", 2.0)]
    cells = {(r.item_a, r.item_b): r["corr"] for r in recommend.copurchase_corr(purchases(spark, rows)).collect()}
    expected = np.corrcoef([1, 3, 0, 2], [2, 0, 1, 2])[0, 1]
    assert cells["a", "b"] == pytest.approx(expected) and cells["a", "a"] == pytest.approx(1.0)


def test_far_areas_are_not_searched_and_vectors_are_staged_once(spark, monkeypatch):
    """Groups of customers in different corners: the work list leaves most pairs out, and nothing as
    long as the vectors is staged but the vectors."""
    rng = np.random.default_rng(4)
    rows = []
    for customer in range(1200):
        corner = customer % 6
        for item in range(6):
            rows.append((customer, f"item{item}", 1000.0 if item == corner else float(rng.integers(1, 40))))
    staged = []
    real = recommend.storage.stage

    def stage(df, label, *rest):
        table = real(df, label, *rest)
        staged.append((label, table.count(), "vector" in table.columns))
        return table

    monkeypatch.setattr(recommend.storage, "stage", stage)
    result = recommend.similar_customers(purchases(spark, rows), 3, 20, 2)
    assert found(result) == brute_force(rows, 3)
    counts = {label: rows for label, rows, _ in staged}
    areas = counts["block-stats"] / 2
    assert counts["work-list"] < 0.4 * counts["block-stats"] * areas
    assert sum(rows for _, rows, wide in staged if wide) <= 5 * 1200


@pytest.mark.parametrize("dense", [0, 16, 1 << 40])
def test_few_pairs_are_multiplied_in_full_and_none_is_lost(monkeypatch, dense):
    monkeypatch.setattr(recommend, "DENSE", dense)
    monkeypatch.setattr(recommend, "PAIR_ROWS", 100)
    rng = np.random.default_rng(4)
    points = rng.random((900, 6)) * (rng.random((900, 6)) < 0.6) + 1e-3
    points[300:420] = points[:120]
    points /= np.sqrt((points**2).sum(axis=1))[:, None]
    multiplied = []
    products = recommend._products

    def counted(some, others, row, column):
        multiplied.append(len(row))
        return products(some, others, row, column)

    monkeypatch.setattr(recommend, "_products", counted)
    names = np.arange(900)
    best = recommend._Best(names, points, 7)
    for start in range(0, 900, 150):
        best.see(names[start : start + 150], points[start : start + 150])
    near = np.round(points @ points.T, recommend.SIMILARITY_DIGITS)
    for query in range(900):
        order = np.lexsort((names, -near[query]))[:7]
        assert best.candidate[query].tolist() == order.tolist()
        assert best.similarity[query] == pytest.approx(near[query][order], abs=2e-9)
    if dense == 16:
        assert sum(multiplied) < 900 * 900 / 16


def _staged(monkeypatch, work):
    """What ``work`` finds, and the labels and frames it stages."""
    most = []
    real = recommend.storage.stage

    def stage(df, label, *rest):
        most.append((label, df))
        return real(df, label, *rest)

    monkeypatch.setattr(recommend.storage, "stage", stage)
    return work(), most


def test_areas_take_turns_with_the_copies_they_see(spark, monkeypatch):
    """All areas saw their copies of the blocks at once: as many copies of the table as it has areas."""
    monkeypatch.setattr(recommend, "SEEN_ROWS", 100)
    rng = np.random.default_rng(12)
    rows = [(c, f"item{item}", float(rng.integers(1, 40))) for c in range(200) for item in range(6)]
    result, staged = _staged(monkeypatch, lambda: found(recommend.similar_customers(purchases(spark, rows), 4, 16, 1)))
    assert result == brute_force(rows, 4)
    turns = [df for label, df in staged if label == "nearest"]
    assert len(turns) > 2


def test_turns_hold_what_they_may():
    areas = [(area, 3) for area in range(7)]
    assert [len(turn) for turn in recommend._turns(areas, 7)] == [2, 2, 2, 1]
    assert [len(turn) for turn in recommend._turns(areas, 1)] == [1] * 7
    assert sum(recommend._turns(areas, 7), []) == areas


def test_neighbours_purchases_are_added_up_in_turns_and_travel_as_one_row(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(c, f"item{item}", float(rng.integers(0, 40))) for c in range(60) for item in rng.choice(9, 5, replace=False)]
    rows += [(0, "item1", 5.0), (1, "item2", None), (61, None, 3.0)]
    near = [(c, int(n), float(rng.random())) for c in range(60) for n in rng.choice(62, 4, replace=False) if n != c]
    names = sorted({item for _, item, _ in rows if item})
    expected = {}
    for customer in sorted({c for c, _, _ in rows}):
        mine = {item for c, item, sales in rows if c == customer and sales and sales > 0}
        scores = dict.fromkeys([name for name in names if name not in mine], 0.0)
        for c, n, similarity in near:
            for other, item, sales in rows:
                if c == customer and other == n and item in scores:
                    scores[item] += similarity * (sales or 0.0)
        order = sorted(scores, key=lambda item: (-round(scores[item], 4), item))[:3]
        expected[customer] = [(item, pytest.approx(scores[item], abs=1e-4)) for item in order]
    shape = "customer_id bigint, neighbour_id bigint, similarity double"
    for most in (1 << 26, 300):
        monkeypatch.setattr(recommend, "SEEN_ENTRIES", most)
        result = recommend.recommend(purchases(spark, rows), spark.createDataFrame(near, shape), 3)
        offered = {}
        for row in result.orderBy("customer_id", "rank").collect():
            offered.setdefault(row.customer_id, []).append((row.sub_category, row.score))
        assert offered == expected
        # The purchases of a neighbour are one row of the join.
        assert ("recommended" in str(result.inputFiles())) == (most == 300)
