from __future__ import annotations

import random

import numpy as np

import corpus_pipeline
from marginalia.llm import jaccard
from tests.conftest import SMALL
from tests.llm.frames import TEXT, awkward, documents


def plain_set(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def plain_kept(pairs):
    """Least id of each component, comparing all different sets with each other."""
    sets = sorted({plain_set(text) for _, text in pairs}, key=sorted)
    name = list(range(len(sets)))

    def root(at):
        while name[at] != at:
            at = name[at]
        return at

    for a in range(len(sets)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                name[max(x, y)] = min(x, y)
    place = {value: at for at, value in enumerate(sets)}
    least = {}
    for key, text in pairs:
        if key is not None:
            at = root(place[plain_set(text)])
            least[at] = min(key, least.get(at, key))
    return sorted(least.values())


def near_copies(rng):
    """Texts, copies with a few edits (similarity on both sides of 0.8), and a line many share."""
    words = [f"w{i}" for i in range(3000)]
    line = [f"common{i}" for i in range(12)]
    texts = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        texts.append(base)
        for _ in range(rng.randint(0, 4)):
            copy = list(rng.choice(texts[-3:]))
            for _ in range(rng.randint(1, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    texts += [line + [rng.choice(words) for _ in range(rng.randint(1, 30))] for _ in range(60)]
    centre = [rng.choice(words) for _ in range(100)]
    for _ in range(60):
        copy = list(centre)
        copy[rng.randrange(100)] = rng.choice(words)
        texts.append(copy)
    rng.shuffle(texts)
    return [(i, " ".join(text)) for i, text in enumerate(texts)]


def test_near_copies_against_brute_force(spark, tmp_path):
    rows = near_copies(random.Random(5))
    documents(spark, rows).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    kept = plain_kept(rows)
    assert len(kept) < len(rows) - 60
    assert sorted(row.doc_id for row in jaccard.deduplicate(docs).collect()) == kept
    assert sorted(row.doc_id for row in corpus_pipeline.near_duplicate_stage(spark, docs, SMALL).collect()) == kept


def test_awkward_rows(spark, tmp_path):
    rows = awkward([(1, "One two THREE four"), (2, "one two three four"), (3, "Ä ä words here now")])
    documents(spark, rows).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    out = [row.doc_id for row in jaccard.deduplicate(docs).collect()]
    assert sorted(key for key in out if key is not None) == plain_kept(rows)
    assert jaccard.deduplicate(spark.createDataFrame([], TEXT)).count() == 0


def test_long_texts_and_sketches(spark, tmp_path):
    """Texts beyond the first sketch, near copies on both sides of a power of two, hot passages."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(20000)]
    passage = rng.choices(words, k=300)
    texts = []
    for size in (400, 508, 520, 900, 1020, 1100, 4000):
        base = rng.choices(words, k=size)
        texts.append(base)
        for edits in (1, size // 60, size // 40, size // 20):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy + rng.choices(words, k=rng.choice([0, size // 50, size // 10])))
    texts += [passage + rng.choices(words, k=rng.randint(60, 400)) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(i, " ".join(text)) for i, text in enumerate(texts)]
    documents(spark, rows).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    kept = plain_kept(rows)
    assert len(rows) - 28 < len(kept) < len(rows) - 5
    assert sorted(row.doc_id for row in jaccard.deduplicate(docs).collect()) == kept


def test_sketches_never_differ_more_than_the_sets():
    rng = np.random.default_rng(2)
    for size in (10, 700, 1500, 5000):
        one = rng.integers(0, 1 << 63, size).astype(np.uint64)
        other = np.concatenate([one[: size - size // 9], rng.integers(0, 1 << 63, size // 7).astype(np.uint64)])
        hashes, starts = np.concatenate([one, other]), np.array([0, size, size + len(other)])
        apart = len(set(one.tolist()) ^ set(other.tolist()))
        for bits in (np.array([512, 512]), np.full(2, jaccard.long_bits(np.array([size]))[0])):
            longs, firsts = jaccard.sketches_of(hashes, starts, bits)
            a, b = longs[firsts[0] : firsts[1]], longs[firsts[1] : firsts[2]]
            assert sum(bin(int(x) & (1 << 64) - 1).count("1") for x in a ^ b) <= apart


def test_clashing_place(spark, tmp_path):
    docs = documents(spark, [(1, "a b c"), (2, "a b c"), (3, "d")]).selectExpr("*", "doc_id * 7 AS place", "'p' AS Place_")
    docs.write.parquet(str(tmp_path / "docs"))
    out = jaccard.deduplicate(spark.read.parquet(str(tmp_path / "docs")))
    assert out.columns == docs.columns
    assert sorted((row.doc_id, row.place, row.Place_) for row in out.collect()) == [(1, 7, "p"), (3, 21, "p")]


def test_links_of_the_simhash_search_come_first(spark, monkeypatch):
    """Near copies that fingerprints join are verified as such; the rest only by shared shingles."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(400)]
    last = [*base[:-1], "other"]
    far = list(base)
    for at in range(20, 400, 66):
        far[at] = "odd"
    rows = [(1, " ".join(base)), (2, " ".join(last)), (3, " ".join(far)), (4, "something else " * 9), (5, None)]
    docs = documents(spark, rows)
    asked = []
    searched, verified = jaccard.simhash.links, jaccard._verified

    def search(nodes, *options):
        asked.append(("search", nodes.count()))
        return searched(nodes, *options)

    def verify(pairs, *options):
        asked.append(("verify", pairs.count()))
        return verified(pairs, *options)

    monkeypatch.setattr(jaccard.simhash, "links", search)
    monkeypatch.setattr(jaccard, "_verified", verify)
    kept = corpus_pipeline.near_duplicate_stage(spark, jaccard.stage(docs, "given"), SMALL)
    assert sorted(row.doc_id for row in kept.collect()) == plain_kept(rows) == [1, 4, 5]
    assert asked[0][0] == "search" and asked[0][1] >= 3
    # The first check is that of the fingerprints' links, which leave less to the second.
    assert [kind for kind, _ in asked[1:3]] == ["verify", "verify"]
    assert asked[1][1] >= 1 and asked[2][1] <= 2


def test_components_that_are_stars_take_no_further_steps(spark, monkeypatch):
    from marginalia.llm import components

    staged, write = [], components.stage
    monkeypatch.setattr(components, "stage", lambda table, label: staged.append(label) or write(table, label))
    stars = spark.createDataFrame([(5, 1), (7, 1), (9, 2), (9, 2), (4, 4)], "u long, v long")
    roots = components.components(stars)
    assert sorted(roots.collect()) == [(5, 1), (7, 1), (9, 2)] and staged == ["edges"]
    assert components.joined(roots, stars.limit(0)) is roots
    more = spark.createDataFrame([(9, 7), (12, 11)], "u long, v long")
    assert sorted(components.joined(roots, more).collect()) == [(2, 1), (5, 1), (7, 1), (9, 1), (12, 11)]
