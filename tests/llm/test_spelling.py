from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa

from marginalia.llm import spelling
from tests.llm.frames import TEXT, awkward, documents


def near(a, b):
    """Exactly one inserted, deleted or replaced code point, by the definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(pairs, least_length=6, least=5):
    import re

    counts = {}
    for key, text in pairs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least}


def plain_groups(counts, ratio=5):
    forms, out = {}, {}
    for word, n in counts.items():
        found = [other for other in counts if near(word, other)]
        best = min(found, key=lambda other: (-counts[other], other), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        forms[word] = form
        out[word] = (n, len(found), form, counts[form] if form else None)
    rows = set()
    for word, (n, n_near, form, form_n) in out.items():
        root = word
        while forms[root]:
            root = forms[root]
        rows.add((word, n, n_near, form, form_n, root))
    return rows


def rows_of(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_variants_against_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdéÿ×z") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    words = []
    for word in base:
        words += [word] * rng.randint(5, 400)
        for _ in range(rng.randint(0, 3)):
            place = rng.randrange(len(word) + 1)
            other = word[:place] + rng.choice(["", "a", "é"]) + word[place + rng.randint(0, 1) :]
            words += [other] * rng.randint(1, 20)
    words += ["aaaaaa"] * 3000 + ["aaaaaaa"] * 9 + ["aaaaaaaa"] * 7 + ["Aaaaaab"] * 40
    rng.shuffle(words)
    rows = awkward([(i, ", ".join(words[i * 40 : i * 40 + 40])) for i in range(len(words) // 40 + 1)])
    counts = plain_counts(rows)
    assert len(counts) > 60 and any(n >= 5 and c[2] for n, c in ((r[1], r) for r in plain_groups(counts)))
    found = spelling.variants(documents(spark, rows))
    assert rows_of(found) == {(w, n, k, f, fn, r) for w, n, k, f, fn, r in plain_groups(counts)}


def test_chains_and_ties(spark):
    counts = {"abcdefgh": 10000, "abcdefg": 1000, "abcdef": 100, "abcdeg": 20, "zbcdefgh": 10000, "zzzzzz": 5, "zzzzzy": 25, "zzzzzx": 25}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = rows_of(spelling.group_variants(words))
    assert found == plain_groups(counts)
    assert ("abcdeg", 20, 2, "abcdefg", 1000, "abcdefgh") in found or ("abcdeg", 20, 2, "abcdefg", 1000, "zbcdefgh") in found


def test_neighbourhood_holds_every_edit():
    rng = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyzéßÿ")
    words = ["".join(rng.choice(letters, rng.integers(1, 12))) for _ in range(200)] + ["x" * 5000]
    edited = []
    for word in words:
        place, kind = int(rng.integers(0, len(word))), int(rng.integers(0, 3))
        put = str(rng.choice(letters))
        edited.append(word[:place] + (put if kind else "") + word[place + (kind < 2) :])
    found, owner = spelling.neighbourhood(*spelling.reduced(pa.array(words), 8), 8)
    wanted = spelling.codes(*spelling.reduced(pa.array(edited), 8))
    for number, code in enumerate(wanted):
        assert code in found[owner == number]


def test_long_words_and_hot_words(spark):
    long = "q" * 30000
    rows = [(i, f"{long} {long}x common common common commons") for i in range(400)]
    found = rows_of(spelling.variants(documents(spark, rows)))
    assert found == plain_groups(plain_counts(rows))


def test_empty_and_clashing(spark):
    assert spelling.variants(spark.createDataFrame([], TEXT)).count() == 0
    docs = documents(spark, awkward([(1, "letter letter letter letter letter lettre")]))
    clash = docs.withColumnsRenamed({"lang": "word", "source": "n"}).selectExpr("*", "1 AS code", "2 AS id", "3 AS run")
    assert rows_of(spelling.variants(clash)) == rows_of(spelling.variants(docs))
