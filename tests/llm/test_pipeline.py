"""The pipeline against a brute-force version of every stage on its own input."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa

import corpus_pipeline
from marginalia.llm import credentials, toxicity
from marginalia.llm.queries import table, toxicity_model
from tests.conftest import SMALL
from tests.llm.frames import TEXT, awkward, documents
from tests.llm.test_bpe import plain as ids_of
from tests.llm.test_credentials import plain as base_of
from tests.llm.test_jaccard import plain_kept

WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def shingles(text):
    words = WORD.findall((text or "").lower())
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def leaks(text, items):
    words = WORD.findall((text or "").lower())
    for item in items:
        width = len(next(iter(item)))
        held = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        if len(item & held) >= 0.8 * len(item):
            return True
    return False


def rows_of(df):
    return {row.doc_id: row for row in df.collect()}


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    given = rows_of(docs)
    stages = dict(corpus_pipeline.STAGES)
    results = {}
    current = docs
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, current, SMALL), f"test-{name}")
        if name != "tokens":
            assert out.columns == docs.columns
        results[name], current = rows_of(out), out
    assert list(stages) == list(results)

    model = toxicity_model(docs, table(spark, SMALL, "labels"))
    scores = model.probabilities(pa.array([row.text for row in given.values()], pa.string()))
    calm = {key for key, value in zip(given, scores, strict=True) if value < toxicity.THRESHOLD}
    assert set(results["toxicity"]) == calm

    assert sorted(results["near_duplicates"]) == plain_kept([(key, row.text) for key, row in results["toxicity"].items()])

    items = [grams for row in table(spark, SMALL, "benchmark").collect() if (grams := shingles(row.text))]
    clean = {key for key, row in results["near_duplicates"].items() if not leaks(row.text, items)}
    assert set(results["decontamination"]) == clean

    formats = credentials.fit(spark.createDataFrame(list(results["decontamination"].values()), docs.schema))
    assert set(results["secrets"]) == clean
    for key, row in results["secrets"].items():
        text = results["decontamination"][key].text
        assert row.text == credentials.covered(text, formats.spans(text), "[SECRET]")
        assert row.n_chars == len(row.text)
        assert bool(base_of(text)) <= ("[SECRET]" in row.text)

    for key, row in results["tokens"].items():
        text = results["secrets"][key].text
        assert row.ids == ids_of(text) and row.n_tokens == len(row.ids)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()

    whole = rows_of(corpus_pipeline.run(spark, SMALL))
    assert whole == results["tokens"]


def through(spark, docs):
    """The rows after each stage, none of which may fail or lose a column."""
    found = []
    for name, stage in corpus_pipeline.STAGES:
        docs, columns = corpus_pipeline.written(stage(spark, docs, SMALL), f"test-{name}"), docs.columns
        assert name == "tokens" or docs.columns == columns
        found.append(sorted(map(tuple, docs.collect()), key=str))
    return found


def test_awkward_rows_through_all_stages(spark):
    given = awkward([(1, "one two three four five six"), (2, "another text of some words altogether"), (3, "word " * 500_000)])
    docs = documents(spark, given)
    *stages, tokens = through(spark, docs)
    # Nulls, empty texts and blanks are one group, and so are the copies; nothing else goes.
    assert [row[0] for row in stages[-1]] == [1, 2, 3, 9001, 9004]
    assert [row[0] for row in tokens] == [1, 2, 3, 9001, 9004]
    assert tokens[2][1] >= 500_000 and tokens[3][1] == 0


def test_clashing_columns_through_all_stages(spark):
    extra = "*", "1 AS place", "2 AS node", "3 AS root", "'s' AS score", "4 AS item_id", "5 AS spans", "6 AS __place"
    docs = documents(spark, [(1, "one two three four five"), (2, "one two three four five")]).selectExpr(*extra)
    *stages, tokens = through(spark, docs)
    assert [row[0] for row in stages[-1]] == [1] and stages[-1][0][5:] == (1, 2, 3, "s", 4, 5, 6)


def test_empty_table_through_all_stages(spark):
    assert through(spark, spark.createDataFrame([], TEXT)) == [[]] * 5
