from __future__ import annotations

import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from marginalia.llm import suffix_tree
from marginalia.llm.queries import QUERIES
from marginalia.llm.toxicity import remainder
from tests.conftest import SMALL
from tests.llm.frames import TEXT, awkward, documents

DEPTH, D = suffix_tree.DEPTH, suffix_tree.DISCOUNT


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def held_out(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7 == 2


def spell(words):
    return "".join(word + " " for word in words).encode() + b"\n"


def plain_tree(texts):
    """Smoothed distributions of the retained contexts, by dictionaries of byte strings."""
    counts = defaultdict(Counter)
    for words in texts:
        data = b"\n" * DEPTH + spell(words)
        for at in range(DEPTH, len(data)):
            for depth in range(DEPTH + 1):
                counts[data[at - depth : at]][data[at]] += 1
    total = sum(counts[b""].values())
    rows = {b"": {byte: (counts[b""][byte] + 0.5) / (total + 128) for byte in range(256)}}
    kept = {b""}
    for context in sorted(counts, key=len)[1:]:
        found, size = counts[context], sum(counts[context].values())
        if size < suffix_tree.SHARE * total or context[1:] not in rows:
            continue
        above = rows[context[1:]]
        rows[context] = {b: (max(found[b] - D, 0) + D * len(found) * above[b]) / size for b in range(256)}
        if size * sum(p * math.log(p / above[b]) for b, p in rows[context].items()) > suffix_tree.DIVERGENCE:
            kept |= {context[at:] for at in range(len(context) + 1)}
    return {context: rows[context] for context in kept}


def plain(rows):
    """Every result column straight from the definitions."""
    texts = [(key, tokens_of(text)) for key, text in rows]
    training = [words for key, words in texts if not held_out(key)]
    c = Counter(token for words in training for token in [*words, "\n"])
    n, v, once = sum(c.values()), len(c), sum(count == 1 for count in c.values())
    tree = plain_tree(training)
    out = []
    for key, words in texts:
        data, at, score = b"\n" * DEPTH + spell(words), DEPTH, 0.0
        for token in [*words, "\n"]:
            size = len(token.encode()) + (token != "\n")
            p = 1.0
            for place in range(at, at + size):
                context = next(data[place - d : place] for d in range(DEPTH, -1, -1) if data[place - d : place] in tree)
                p *= tree[context][data[place]]
            at += size
            if not n:
                score += math.log10(p)
            elif c[token]:
                score += math.log10((c[token] - D) / n + D * v / n * p)
            else:
                score += math.log10(D * v / n * max(once, 1) / n)
        base = sum(math.log10((c[token] + 1) / (n + v + 1)) for token in [*words, "\n"])
        known = sum(c[token] > 0 for token in [*words, "\n"])
        out.append((key, held_out(key), len(words) + 1, known, n, base, score))
    return sorted(out, key=lambda row: (str(row[0]), row[2], row[5]))


def compare(found, expected):
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    found = sorted((tuple(row[name] for name in names) for row in found), key=lambda row: (str(row[0]), row[2], row[5]))
    assert [row[:5] for row in found] == [row[:5] for row in expected]
    for one, other in zip(found, expected, strict=True):
        assert one[5:] == pytest.approx(other[5:], rel=1e-5, abs=1e-5)


def model(docs, **options):
    return suffix_tree.score(docs, remainder("doc_id", 7) != 2, **options).collect()


@pytest.mark.parametrize("frequent", [1e-6, 0.004, 2.0])
def test_documents_against_brute_force(spark, frequent):
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted([(row.doc_id, row.text) for row in given], key=lambda row: len(row[1] or ""))[:60]
    rows = awkward([*rows, (8001, "Ünïque \x85\xa0 WORD\x0bword")])
    docs = documents(spark, rows).selectExpr("*", "1 AS word", "2 AS score", "3 AS row")
    compare(model(docs, frequent=frequent), plain(rows))


def test_steps_and_flushes_do_not_change_counts(spark, monkeypatch):
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted([(row.doc_id, row.text) for row in given], key=lambda row: len(row[1] or ""))[:40]
    texts = [suffix_tree.words(text) for _, text in rows]
    whole = suffix_tree.grams(*suffix_tree.symbols(texts))
    parts = [suffix_tree.grams(*suffix_tree.symbols(texts[at : at + 7])) for at in range(0, 40, 7)]
    assert all((a == b).all() for a, b in zip(suffix_tree.merged(parts), whole, strict=True))
    expected = Counter()
    for words in texts:
        data = b"\n" * DEPTH + b"".join(word + b" " for word in words) + b"\n"
        expected.update(data[at - DEPTH : at + 1] for at in range(DEPTH, len(data)))
    assert {int(code).to_bytes(DEPTH + 1, "big"): n for code, n in zip(*whole, strict=True)} == expected


def test_without_training_texts(spark):
    rows = [(key, f"text {key}") for key in range(200) if held_out(key)]
    compare(model(documents(spark, rows)), plain(rows))
    assert model(spark.createDataFrame([], TEXT)) == []


def test_distributions_sum_to_one():
    tree = suffix_tree.build(
        [{0: {97: 50, 98: 50, 10: 4}}, {97: {98: 49, 10: 1}, 98: {97: 48, 10: 2}}, {(98 << 8) + 97: {98: 45}}], divergence=1
    )
    assert len(tree.child) > 2
    share = [1] * 3 + [253]
    for row in tree.log_p:
        assert sum(math.exp(value) * times for value, times in zip(row.tolist(), share, strict=True)) == pytest.approx(1, rel=1e-5)


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    sf = SMALL.replace("0.001", "0.01")
    rows = [row for row in QUERIES["op5_language_model"](spark, sf).collect() if row.held_out]
    assert len(rows) > 80
    assert sum(row.score for row in rows) > sum(row.base_score for row in rows)


def weighted(rows, share):
    """Scores by definition with the tree's ``share``, in the order of ``rows``."""
    texts = [(key, tokens_of(text)) for key, text in rows]
    training = [words for key, words in texts if not held_out(key)]
    c = Counter(token for words in training for token in [*words, "\n"])
    n, once = sum(c.values()), sum(count == 1 for count in c.values())
    spare, tree = share + (1 - share) * D * len(c) / n, plain_tree(training)
    out = []
    for _, words in texts:
        data, at, score = b"\n" * DEPTH + spell(words), DEPTH, 0.0
        for token in [*words, "\n"]:
            p = 1.0
            for at in range(at, at + len(token.encode()) + (token != "\n")):
                context = next(data[at - d : at] for d in range(DEPTH, -1, -1) if data[at - d : at] in tree)
                p *= tree[context][data[at]]
            at += 1
            known = (1 - share) * (c[token] - D) / n + spare * p
            score += math.log10(known if c[token] else spare * max(once, 1) / n)
        out.append(score)
    return out


@pytest.mark.parametrize("frequent", [1e-6, 2.0])
def test_the_tree_weighs_as_much_as_counts_in_the_query(spark, monkeypatch, frequent):
    """Words that always follow each other are likelier in that order, though counts are the same."""
    rows = [(key, "ab cd ef gh " * 40) for key in range(300) if not held_out(key)]
    ordered, mixed = [key for key in range(300, 400) if held_out(key)][:2]
    rows += [(ordered, "ab cd ef gh"), (mixed, "gh ef cd ab"), (mixed + 10_000, "Zz ab")]
    found = {row.doc_id: row for row in model(documents(spark, rows), frequent=frequent, tree_share=suffix_tree.TREE)}
    for (key, _), expected in zip(rows, weighted(rows, suffix_tree.TREE), strict=True):
        assert found[key].score == pytest.approx(expected, rel=1e-5)
    before = {row.doc_id: row for row in model(documents(spark, rows), frequent=frequent)}
    assert before[ordered].score - before[mixed].score < 0.1
    assert found[ordered].score - found[mixed].score > 1
    taken = {}
    monkeypatch.setattr(suffix_tree, "score", lambda docs, training, **options: taken.update(options))
    QUERIES["op5_language_model"](spark, SMALL)
    assert taken["tree_share"] == suffix_tree.TREE >= 0.5


def test_counting_holds_a_bounded_part_of_its_texts():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{n:x}" for n in rng.integers(0, 1 << 40, 1000)) for _ in range(600)]
    given = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([at % 2 == 0 for at in range(600)])], ["text", "training"])
    counted = {"n": 0, "n_train": 0}
    tracemalloc.start()
    try:
        for part in suffix_tree.count_batches(iter([given])):
            known = part.filter(pc.is_valid(part["word"]))
            counted = {name: counted[name] + (pc.sum(known[name]).as_py() or 0) for name in counted}
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert counted == {"n": 600 * 1001, "n_train": 300 * 1001}
    assert peak < 150 << 20, peak >> 20
