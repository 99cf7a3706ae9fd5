from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from marginalia.llm import toxicity
from marginalia.llm.queries import QUERIES
from tests.llm.frames import TEXT, awkward, documents

LABELS = "doc_id long, quality int, toxic int"


def all_maximal(scores):
    """Segments by definition: split at the best one, then look left and right of it."""
    if not len(scores):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    best = max(
        ((sums[j] - sums[i], -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))
    )
    total, _, _, i, j = best
    if total <= 0:
        return []
    right = [(a + j, b + j, s) for a, b, s in all_maximal(scores[j:])]
    return [*all_maximal(scores[:i]), (i, j, total), *right]


@pytest.mark.parametrize("seed", range(20))
def test_segments_against_the_definition(seed):
    rng = np.random.default_rng(seed)
    scores = rng.choice([-0.35, -1.1, 0.8, 2.3, -0.05], 30) + rng.normal(0, 0.01, 30)
    got, want = toxicity.segments(scores), all_maximal(scores)
    assert [segment[:2] for segment in got] == [segment[:2] for segment in want]
    assert np.allclose([segment[2] for segment in got], [segment[2] for segment in want])


def corpus(count=400):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for key in range(count):
        text = rng.choices(words, k=rng.randint(20, 120))
        toxic = int(rng.random() < 0.25)
        for _ in range(4 * toxic):
            text[rng.randrange(len(text))] = rng.choice(["Vile", "rotten", "scoundrel"])
        rows.append((key, " ".join(text)))
        labels.append((key, 1, toxic))
    return rows, labels


def held_out(key):
    return zlib.crc32(str(key).encode()) % 3 == 1


def test_held_out_accuracy_and_awkward_rows(spark):
    rows, labels = corpus()
    given = [row for row in labels if not held_out(row[0])]
    odd = [(None, 1, 1), (3, 1, None), (77777, 1, 1), given[0], (9001, 0, 0)]
    docs = documents(spark, awkward(rows)).selectExpr("*", "1 AS score", "0 AS toxic")
    model = toxicity.fit(docs, spark.createDataFrame(given + odd, LABELS))
    scored = [(row.doc_id, row.score) for row in toxicity.score(docs, model).collect()]
    assert len(scored) == len(rows) + 7 and all(0 <= value <= 1 for _, value in scored)
    truth = {key: toxic for key, _, toxic in labels}
    wrong = [key for key, value in scored if key in truth and held_out(key) and (value >= 0.7) != truth[key]]
    assert len(wrong) <= 3
    assert {value for key, value in scored if key in (9001, 9002, 9003)} == {min(value for _, value in scored)}
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(value < 0.7 for _, value in scored)


def test_passages_hold_the_toxic_words(spark):
    rows, labels = corpus()
    calm = " ".join(f"word{i % 300}" for i in range(900))
    rows.append((5000, f"{calm} vile rotten scoundrel {calm} rotten vile vile {calm}"))
    docs = documents(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    spans = toxicity.passages(docs, model).filter("doc_id = 5000").orderBy("start").collect()
    assert [(row.start, row.end) for row in spans] == [(900, 903), (1803, 1806)]
    assert all(row.p_value < 0.01 for row in spans)


def test_without_labels(spark):
    docs = documents(spark, awkward([(1, "a b c")]))
    none = spark.createDataFrame([], LABELS)
    for labels in (none, spark.createDataFrame([(1, 1, 1)], LABELS)):
        assert {row.score for row in toxicity.score(docs, toxicity.fit(docs, labels)).collect()} == {0.0}
    empty = spark.createDataFrame([], TEXT)
    model = toxicity.fit(empty, spark.createDataFrame([(1, 1, 1), (2, 1, 0)], LABELS))
    assert toxicity.score(empty, model).count() == 0


def test_query_folds(spark):
    from tests.conftest import SMALL

    for row in QUERIES["op4_toxicity"](spark, SMALL).collect():
        assert row.held_out == held_out(row.doc_id) and row.predicted == int(row.score >= 0.7)


def test_prefix_cells_stop_at_word_ends():
    cells, rows = toxicity.tokens(pa.array(["abcd abcde", None, "abcd ABCDE"]))
    assert rows.tolist() == [0, 0, 2, 2]
    assert cells[0][0] == cells[0][1] and cells[1][0] != cells[1][1]
    assert (cells[:, :2] == cells[:, 2:]).all()
