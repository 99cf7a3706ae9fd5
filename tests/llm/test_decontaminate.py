from __future__ import annotations

import random

import pytest

from marginalia.llm import decontaminate
from tests.conftest import SMALL
from tests.llm.frames import TEXT, awkward, documents
from tests.llm.test_pipeline import WORD, shingles

ITEMS = "item_id long, text string"


def brute(rows, items):
    found = []
    for doc_id, text in rows:
        words = WORD.findall((text or "").lower())
        for item_id, item in {(key, value) for key, value in items}:
            grams = shingles(item)
            if not grams:
                continue
            width = len(next(iter(grams)))
            held = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
            share = len(grams & held) / len(grams)
            if share >= 0.8:
                found.append((doc_id, item_id, share))
    return sorted(found, key=str)


def result(df):
    return sorted(((row.doc_id, row.item_id, row.containment) for row in df.collect()), key=str)


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    queries = [(row.item_id, row.text) for row in items.collect()]
    assert result(decontaminate.find_leaks(docs, items)) == brute(rows, queries)


@pytest.mark.parametrize("block", [16_000_000, 300])
def test_edits_ties_and_awkward_rows(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)] + ["Été", "naïve", "x-y"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(60)]
    items += [(None, "lone item of null id here"), (500, None), (501, " ,, "), (502, "one two"), items[0], items[0]]
    rows = []
    for key in range(300):
        text = rng.choices(words, k=rng.randint(0, 200))
        piece = (rng.choice(items)[1] or "").split()
        for _ in range(rng.randint(0, 2)):
            if piece:
                piece[rng.randrange(len(piece))] = "changed"
        place = rng.randint(0, len(text))
        rows.append((key, " ".join([*text[:place], *map(str.upper, piece), *text[place:]])))
    rows = awkward([*rows, (700, "lone item of null id here"), (701, "a one two b")])
    docs = documents(spark, rows).selectExpr("*", "1 AS item_id", "2 AS containment")
    frame = spark.createDataFrame(items, ITEMS).selectExpr("*", "0 AS doc_id")
    expected = brute(rows, items)
    assert len(expected) > 50
    assert result(decontaminate.find_leaks(docs, frame)) == expected
    kept = decontaminate.drop_leaks(docs, frame)
    leaked = {key for key, _, _ in expected if key is not None}
    assert kept.columns == docs.columns
    texts = {text for key, text in rows if key in leaked}
    assert sorted(-1 if row.doc_id is None else row.doc_id for row in kept.collect()) == sorted(
        (-1 if key is None else key) for key, text in rows if text not in texts
    )


def test_empty_tables(spark):
    none, docs = spark.createDataFrame([], ITEMS), documents(spark, [(1, "a b c d e")])
    assert decontaminate.find_leaks(docs, none).count() == 0
    assert decontaminate.drop_leaks(docs, none).count() == 1
    assert decontaminate.find_leaks(spark.createDataFrame([], TEXT), spark.createDataFrame([(1, "a b c d e")], ITEMS)).count() == 0
