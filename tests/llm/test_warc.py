from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pytest

from marginalia.llm import warc
from marginalia.llm.queries import page_columns

PAGES = "page_id long, url string, html string"


def plain(rows):
    payloads = [(key, (html or "").encode()) for key, _, html in rows]
    firsts = {}
    for key, data in payloads:
        if len(data) >= 100 and key is not None:
            firsts[data] = min(key, firsts.get(data, key))
    out, seen = [], set()
    for key, data in payloads:
        first = firsts.get(data)
        revisit = first is not None and (key != first or data in seen)
        if key == first:
            seen.add(data)
        kind = ("revisit", first) if revisit else ("response", None)
        out.append((key, len(data), hashlib.sha256(data).hexdigest(), *kind))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/ b\r\nX: y", "<p>small</p>"),
    (2, None, None),
    (3, "http://c/é", "ü中" * 9000),
    (7, "http://d/", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc" * 9),
    (5, "http://e/", "same page " * 4000),
    (4, "http://f/", "same page " * 4000),
    (4, "http://f/", "same page " * 4000),
    (6, "http://g/", "same page " * 4000),
    (8, "http://h/", ""),
    (9, "http://i/", "x" * 99),
    (10, "http://j/", "x" * 99),
    (None, "http://k/", "no id"),
]


@pytest.mark.parametrize(("segment", "per_file"), [(16384, 4000), (50, 7)])
def test_awkward_pages(spark, tmp_path, segment, per_file):
    pages = spark.createDataFrame(ROWS, PAGES).coalesce(2).selectExpr("*", "1 AS digest", "2 AS row")
    warc.write_archives(pages, str(tmp_path / "w"), segment, records_per_file=per_file)
    records = warc.read_archives(spark, str(tmp_path / "w"))
    assert {row.status for row in records.select("status").collect()} == {"ok"}
    assert sorted((tuple(row) for row in page_columns(records).collect()), key=str) == plain(ROWS)
    kinds = [fields["warc-type"] for file in (tmp_path / "w").glob("*.gz") for fields, _ in warc.parse(file.read_bytes())]
    assert kinds.count("continuation") >= (4 if segment > 1000 else 1000)
    uris = {row.page_id: row.uri for row in records.collect()}
    assert uris[1] == "http://a/%20b%0D%0AX:%20y" and uris[3] == "http://c/é" and uris[2] is None


def test_empty_table(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], PAGES), str(tmp_path / "w"))
    assert page_columns(warc.read_archives(spark, str(tmp_path / "w"))).count() == 0


def segment(fields, block):
    head = "".join(f"{key}: {value}\r\n" for key, value in fields)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_broken_segments_are_told(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nhello\r\n0\r\n\r\n"
    cut = [body[:20], body[20:45], body[45:]]

    def record(name, parts, total=len(body)):
        out = []
        for number, part in parts:
            kind = [("WARC-Type", "response"), ("WARC-Record-ID", name)]
            if number > 1:
                kind = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name}-{number}"), ("WARC-Segment-Origin-ID", name)]
            if number == 3:
                kind.append(("WARC-Segment-Total-Length", total))
            out.append(segment([*kind, ("WARC-Segment-Number", number)], part))
        return out

    whole = list(enumerate(cut, 1))
    files = [
        record("good", whole[::-1]) + record("lost", [whole[0], whole[2]]),
        record("long", whole, len(body) + 1) + record("twice", [*whole, whole[1]]),
        record("split", [*whole, (2, b"other bytes")]) + record("orphan", whole[1:]),
        [segment([("WARC-Type", "response"), ("WARC-Record-ID", "frame")], body.replace(b"5\r\n", b"6\r\n"))],
        [segment([("WARC-Type", "response"), ("WARC-Record-ID", "digest"), ("WARC-Payload-Digest", "sha256:00")], body)],
        [segment([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "info")], b"software: x")],
    ]
    for number, parts in enumerate(files):
        data = b"".join(parts)
        Path(tmp_path / f"{number}.warc.gz").write_bytes(gzip.compress(data[: len(data) // 2]) + gzip.compress(data[len(data) // 2 :]))
    rows = {row.record: (row.status, row.payload and bytes(row.payload)) for row in warc.read_archives(spark, str(tmp_path)).collect()}
    assert rows == {
        "good": ("ok", b"hello"),
        "twice": ("ok", b"hello"),
        "lost": ("missing segment", None),
        "long": ("length mismatch", None),
        "split": ("conflicting segments", None),
        "frame": ("bad framing", None),
        "digest": ("digest mismatch", None),
    }
