from __future__ import annotations

import hashlib
import random

import pytest
import xxhash

from marginalia.llm import fingerprints
from marginalia.llm.chunking import _GEAR
from marginalia.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.frames import TEXT, awkward, documents


def plain_chunks(data):
    """Chunks byte by byte, straight from the definition."""
    sizes, start, out = fingerprints.SIZES, 0, {}
    while start < len(data):
        end = len(data)
        if len(data) - start > sizes.least:
            for stop in range(start + sizes.least, min(start + sizes.most, len(data)) + 1):
                code = sum(int(_GEAR[data[stop - 1 - back]]) << back for back in range(16)) % 2**32
                inner = stop == len(data) or data[stop] & 0xC0 != 0x80
                bits = sizes.hard if stop - start < sizes.normal else sizes.easy
                if inner and code >> (32 - bits) == 0:
                    end = stop
                    break
            else:
                end = min(start + sizes.most, len(data))
                while end < len(data) and data[end] & 0xC0 == 0x80:
                    end -= 1
        out[xxhash.xxh64_hexdigest(data[start:end])] = end - start
        start = end
    return out


def share(first, second):
    if not first:
        return float(not second)
    return sum(n for digest, n in first.items() if digest in second) / sum(first.values())


def plain(rows):
    rows = sorted(((key, text or "") for key, text in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        change = len(text) // 3
        edited = text[: len(text) - change] + after[:change]
        sets = [plain_chunks(value.encode()) for value in (text, edited, after)]
        prints = ["".join(sorted(f"{d}{n - 1:02x}" for d, n in found.items())) for found in sets]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((key, len(text), digest, prints[0], prints[1], share(sets[0], sets[1]), share(sets[0], sets[2])))
    return sorted(out, key=str)


@pytest.mark.parametrize("ranges", [1, 7])
def test_documents_against_brute_force(spark, ranges):
    texts = [(row.doc_id, row.text) for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts = sorted(texts, key=lambda row: len(row[1] or ""))[:120]
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    found = fingerprints.with_neighbours(documents(spark, texts)).collect()
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert sorted((tuple(row) for row in found), key=str) == plain(texts)


def test_query_columns(spark):
    rows = QUERIES["op1_fingerprints"](spark, SMALL).collect()
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert sorted(row.doc_id for row in rows) == sorted(texts)
    assert all(row.n_chars == len(texts[row.doc_id]) for row in rows)
    assert all(0.4 < row.near_edited <= 1 for row in rows if row.n_chars > 1000)
    by_text = {}
    for row in rows:
        assert by_text.setdefault(texts[row.doc_id], row.fingerprint) == row.fingerprint


def test_awkward_rows(spark):
    base = [(1, "One text that is long enough for two chunks or more, " * 3), (2, "ü中" * 200), (3, "ab")]
    rows = [*base, (9001, None), (9002, ""), (9003, " \n\t"), (9004, "x"), (None, base[0][1]), base[0], base[0]]
    assert rows == awkward(base)
    found = fingerprints.with_neighbours(documents(spark, rows).selectExpr("*", "1 AS range", "2 AS fingerprint"))
    assert sorted((tuple(row) for row in found.collect()), key=str) == plain(rows)
    assert fingerprints.with_neighbours(spark.createDataFrame([], TEXT)).count() == 0
    lone = fingerprints.with_neighbours(documents(spark, [(5, "alone in the table here")])).collect()
    assert [tuple(row) for row in lone] == plain([(5, "alone in the table here")])


def test_edits_keep_most_chunks(spark):
    rng = random.Random(8)
    words = [f"word{rng.randrange(5000)}" for _ in range(2000)]
    text = " ".join(words)
    moved = " ".join(["new", "words", *words[:1000], "inserted", *words[1000:]])
    rows = fingerprints.fingerprints(documents(spark, [(1, text), (2, moved), (3, text[::-1])])).collect()
    prints = {row.doc_id: fingerprints.read(row.fingerprint) for row in rows}
    assert prints[1] == plain_chunks(text.encode())
    assert fingerprints.containment(prints[1], prints[2]) > 0.95
    assert fingerprints.containment(prints[1], prints[3]) < 0.01
