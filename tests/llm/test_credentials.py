from __future__ import annotations

import hashlib
import random
import re

import pytest

from marginalia.llm import credentials
from marginalia.llm.queries import QUERIES, secret_columns
from tests.conftest import SMALL
from tests.llm.frames import TEXT, awkward, documents

ASSIGN = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text):
    """Base spans straight from the definition."""
    text, spans = text or "", []
    spans += [("assign", m.start(), m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


ODD = [
    (1, "secret=token: abcdef and Token = 'abcdef12' ſecret=abcdefgh"),
    (2, "ä password: " + "0a" * 20 + " tail AKIA" + "B2" * 9),
    (3, "AKIAAKIA" + "C" * 11 + " " + "f" * 24 + "g" + "0" * 23),
    (4, "api_key=abcde\napiKEY==abcdef"),
]


def test_base_spans_against_the_definition(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = awkward(ODD) + [(row.doc_id, row.text) for row in docs]
    found = credentials.find(documents(spark, rows).selectExpr("*", "1 AS spans")).collect()
    got = sorted(
        ((row.doc_id, [tuple(s) for s in row.spans if s.kind != "format"]) for row in found), key=str
    )
    assert got == sorted(((key, plain(text)) for key, text in rows), key=str)
    assert credentials.find(spark.createDataFrame([], TEXT)).count() == 0


def test_query_columns(spark):
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    texts |= {-key: text for key, text in ODD}
    rows = QUERIES["op10_secrets"](spark, SMALL).collect()
    rows += secret_columns(credentials.find(documents(spark, [(-key, text) for key, text in ODD]))).collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = plain(texts[row.doc_id])
        listed = ",".join(f"{kind}:{low}:{high}" for kind, low, high in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        counts = (row.n_assign, row.n_access, row.n_hex)
        assert counts == tuple(sum(s[0] == kind for s in spans) for kind in ("assign", "access", "hex"))
        assert set(listed.split(",")) <= set(row.spans.split(",")) | {""}


def test_automaton_learns_a_format():
    samples = [f"key-{i * 7919 % 1000:03d}-{'ab'[i % 2]}" for i in range(400)]
    automaton = credentials.Automaton(samples)
    assert len(automaton.kept) < 40
    assert automaton.score("key-123-a") > automaton.least - 0.2
    assert automaton.score("zzz-abc-9") < automaton.least - 1
    assert automaton.visits[0] >= 400 and sum(automaton.ends[state] for state in automaton.kept) == 400


def test_learned_spans_outside_base_patterns(spark):
    labelled = [(i, f"token={i * 2654435761 % 2**32:08x}{i * 40503 % 65536:04x}{i * 97 % 256:02x} end") for i in range(300)]
    noise = [(1000 + i, f"call 555-{i:04d}-{i * 37 % 10000:04d} now") for i in range(300)]
    hidden = [(5000, "see b7db7aa4a5fcc783 there"), (5001, "see b7db7aa4a5fcc783 there")]
    rows = credentials.find(documents(spark, labelled + noise + hidden)).collect()
    spans = {row.doc_id: [tuple(span) for span in row.spans] for row in rows}
    assert spans[5000] == spans[5001] == [("format", 4, 20)]
    assert not any(spans[key] for key, _ in noise)


@pytest.mark.parametrize(
    ("spans", "out"), [([], "abcdef"), ([("hex", 1, 3), ("assign", 0, 2)], "*def"), ([("hex", 4, 6)], "abcd*")]
)
def test_covered(spans, out):
    assert credentials.covered("abcdef", spans, "*") == out


def test_redaction_keeps_rows_and_columns(spark):
    docs = documents(spark, awkward(ODD)).selectExpr("*", "7 AS spans")
    out = credentials.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {row.doc_id: row.text for row in out.collect()}
    assert texts[9001] is None and texts[9002] == "" and texts[2] == "ä [SECRET] tail [SECRET]"


def test_short_and_letter_only_formats_and_rests_of_runs(spark):
    rng = random.Random(3)
    letters = "bcdfghjkmnpqrstvwxzBCDFGHJKMNPQRSTVWXZ"
    code = lambda size: "".join(rng.choice(letters) for _ in range(size))
    rows = [(i, f"password={code(6 + i % 12)} end") for i in range(600)]
    words = ["ordinary", "language", "sentence", "together", "document", "2024-10-11", "5550123456"]
    rows += [(1000 + i, " ".join(rng.choice(words) for _ in range(30))) for i in range(300)]
    short, rest = code(8), code(10)
    access = "AKIA" + "B2" * 8
    rows += [(5000, f"see {short} there"), (5001, f"see {access}/{rest} there")]
    rows += [(5002, f"see {rest}." + "0a" * 12)]
    found = credentials.find(documents(spark, rows)).collect()
    spans = {row.doc_id: [tuple(span) for span in row.spans] for row in found}
    rest_span = ("format", 5 + len(access), 15 + len(access))
    assert spans[5000] == [("format", 4, 12)]
    assert rest_span in spans[5001]
    assert ("format", 4, 14) in spans[5002]
    assert not any(spans[1000 + i] for i in range(300))


def test_parts_of_runs_beside_spans():
    text = "x AKIA" + "B2" * 8 + "/one-piece_ password=abcdefg"
    base = credentials.base_spans(text)
    assert [text[a:b] for a, b in credentials.candidates(text, base, 6)] == ["one-piece_"]
    assert credentials.candidates("left." + "f" * 24 + ".right", [("hex", 5, 29, "f" * 24)], 4) == [(0, 4), (30, 35)]
