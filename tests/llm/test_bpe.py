from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marginalia.llm import bpe
from marginalia.llm.chunking import Cuts, Sizes
from marginalia.llm.queries import QUERIES, VOCABULARY
from marginalia.llm.text import flat
from tests.conftest import SMALL
from tests.llm.frames import TEXT, awkward, documents

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
CODEC = bpe.Codec(VOCABULARY)


def plain(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def encoded(texts):
    return CODEC.encode(texts, *flat(pa.array(texts, pa.string())))


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    """Chunks of a few bytes, so that small texts have many joins."""
    monkeypatch.setattr(bpe, "SIZES", Sizes(2, 5, 9, 3, 1))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("ab 'stlredvm\n\t  12²_<|>İßé中 \x1c٣"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=4))
def test_ids_equal_the_library(texts):
    assert encoded(texts) == [plain(text) for text in texts]
    assert [CODEC.decode(ids) for ids in encoded(texts)] == texts


@settings(max_examples=300, deadline=None)
@given(st.text("a '\n lrev s", max_size=80))
def test_joins_in_contractions_and_white_space(text):
    assert encoded([text]) == [plain(text)]


def test_special_tokens():
    texts = ["a<|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x" * 9, "<|endoftext|", "x <|endoftext|>'s"]
    assert encoded(texts) == [plain(text) for text in texts]
    for ids in encoded(texts) + [[50256, 197, 128, 0], [250, 251, 50256, 99]]:
        assert CODEC.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_cuts_follow_content():
    sizes = Sizes(16, 40, 128, 7, 4)
    body = ("The quick brown fox. " * 3 + "Ünïcödé wörds änd möre text follows here, " * 4).encode() * 3
    shifted = b"some words in front " + body
    first = Cuts(np.frombuffer(body, np.uint8), sizes).ends(0, len(body))
    second = Cuts(np.frombuffer(shifted, np.uint8), sizes).ends(0, len(shifted))
    shared = {end - 20 for end in second} & set(first)
    assert len(shared) >= len(first) - 4
    assert all(body[:end].decode() for end in first) and first[-1] == len(body)
    assert all(16 <= b - a <= 128 for a, b in zip([0, *first], first[:-1], strict=False))


def test_query_and_round_trip(spark):
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op7_bpe"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = plain(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_awkward_rows(spark):
    rows = awkward([(1, "A text. " * 500), (2, "<|endoftext|>ok")])
    docs = documents(spark, rows).selectExpr("*", "1 AS ids")
    ids = bpe.encode(docs, VOCABULARY)
    back = sorted(((row.doc_id, row.text) for row in bpe.decode(ids, VOCABULARY).collect()), key=str)
    assert back == sorted(((key, text or "") for key, text in rows), key=str)
    assert bpe.digests(spark.createDataFrame([], TEXT), VOCABULARY, keep_ids=True).count() == 0
