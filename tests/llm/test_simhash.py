from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from marginalia.llm import simhash
from tests.conftest import SMALL
from tests.llm.frames import TEXT, awkward, documents


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(gram.encode(), seed=42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    """Least id per row of (doc_id, unsigned fingerprint), comparing everything with everything."""
    codes = sorted({code for _, code in pairs})
    name = {code: code for code in codes}

    def root(code):
        while name[code] != code:
            code = name[code]
        return code

    array = np.array(codes, np.uint64)
    for place, code in enumerate(codes):
        for other in np.flatnonzero(np.bitwise_count(array[:place] ^ np.uint64(code)) <= 2):
            a, b = root(code), root(codes[other])
            name[max(a, b)] = min(a, b)
    least = {}
    for key, code in pairs:
        if key is not None:
            least[root(code)] = min(key, least.get(root(code), key))
    return sorted(((key, code, least.get(root(code))) for key, code in pairs), key=str)


def result(df):
    return sorted(((row.doc_id, row.fp % 2**64, row.component_id) for row in df.collect()), key=str)


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pairs = [(row.doc_id, plain_fingerprint(row.text)) for row in docs.collect()]
    assert result(simhash.near_duplicates(docs)) == plain_components(pairs)


def test_awkward_rows(spark):
    base = [(1, "One two THREE four"), (2, "one two three four"), (3, "Ä ä words here now")]
    rows = awkward(base)
    pairs = [(key, plain_fingerprint(text)) for key, text in rows]
    docs = documents(spark, rows).selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS part")
    assert result(simhash.near_duplicates(docs)) == plain_components(pairs)
    assert simhash.near_duplicates(spark.createDataFrame([], TEXT)).count() == 0


def chained(rng, count):
    """Fingerprints in chains and balls around a few centres, and unrelated ones."""
    codes = [rng.getrandbits(64) for _ in range(count // 2)]
    for _ in range(count - len(codes)):
        code = rng.choice(codes[-40:])
        for _ in range(rng.randint(1, 3)):
            code ^= 1 << rng.randrange(64)
        codes.append(code)
    return codes


def spanning(spark, codes, limit):
    nodes = spark.createDataFrame([(int(np.uint64(code).view(np.int64)),) for code in set(codes)], "fp long")
    parent = {code: code for code in codes}

    def root(code):
        while parent[code] != code:
            code = parent[code]
        return code

    for row in simhash.links(nodes, limit).collect():
        u, v = row.u % 2**64, row.v % 2**64
        assert (u ^ v).bit_count() <= 2
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    return {code: root(code) for code in codes}


def test_links_span_with_buckets_and_with_midpoints(spark):
    codes = chained(random.Random(3), 600)
    truth = plain_components([(code, code) for code in codes])
    for limit in (4096, 2):
        roots = spanning(spark, codes, limit)
        assert sorted(((code, code, roots[code]) for code in codes), key=str) == truth


def test_thresholds_are_the_cheapest():
    costs = [[0, 5, 9, 20], [0, 1, 50, 90], [0, 2, 3, 90]]
    cost, chosen = simhash.allocate(costs, 0)
    every = [
        (a[0] + b[0] + c[0], [a[1], b[1], c[1]])
        for a in zip(costs[0], range(-1, 3), strict=True)
        for b in zip(costs[1], range(-1, 3), strict=True)
        for c in zip(costs[2], range(-1, 3), strict=True)
        if a[1] + b[1] + c[1] == 0
    ]
    assert (cost, chosen) == min(every)


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(1)
    bits = rng.random((2000, 64)) < 0.5
    for bit in range(0, 20):
        bits[:, bit] = bits[:, 0]
    bits = bits.astype(float)
    groups = simhash.bit_groups(bits.T @ bits, bits.sum(0), 2000, 3)
    assert sorted(sum(groups, [])) == list(range(64))
    assert max(len(set(group) & set(range(20))) for group in groups) == 20


def test_one_row_of_each_component_stays(spark):
    base = [(1, "One two THREE four"), (2, "one two three four"), (3, "Ä ä words here now"), (None, "only here without an id")]
    rows = awkward(base)
    docs = documents(spark, rows).repartition(1)
    kept = simhash.deduplicate(docs.selectExpr("*", "1 AS fp", "2 AS root", "3 AS id"))
    assert kept.columns == [*docs.columns, "fp", "root", "id"]
    got = sorted(((row.doc_id, row.text) for row in kept.collect()), key=str)
    assert got == sorted([(1, "One two THREE four"), (3, base[2][1]), (None, base[3][1]), (9001, None), (9004, "x")], key=str)
    assert simhash.deduplicate(spark.createDataFrame([], TEXT)).count() == 0
