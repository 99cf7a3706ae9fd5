from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from marginalia.llm import alignment
from marginalia.llm.queries import PIECES, RANKS, VOCABULARY, op12_alignment, table
from tests.conftest import SMALL
from tests.llm.frames import TEXT, awkward, documents


def printable():
    """Byte-level symbols by their definition."""
    out, extra = {}, 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            out[chr(byte)] = byte
        else:
            out[chr(256 + extra)] = byte
            extra += 1
    return out


def plain(pairs):
    """All columns of the result, straight from the definitions, in time that is quadratic."""
    assert VOCABULARY == public_tokenizers.path("byte_bpe_50k.json")
    first = Tokenizer.from_file(VOCABULARY)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    symbols = printable()
    rows, held, best = [], Counter(), defaultdict(int)
    for key, text in pairs:
        a_ids = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b_ids = second.encode(text) if text else []
        a_bytes = [bytes(symbols[c] for c in first.id_to_token(i)) for i in a_ids]
        b_bytes = []
        for i in b_ids:
            piece = second.id_to_piece(i)
            is_byte = len(piece) == 6 and piece.startswith("<0x")
            b_bytes.append(bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode())
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a_ids, b_ids, a_bytes, b_bytes = [], [], [], []
        spans = []
        for ids, parts in ((a_ids, a_bytes), (b_ids, b_bytes)):
            at, found = 0, []
            for number, part in zip(ids, parts, strict=True):
                found.append((at, at + len(part), number))
                at += len(part)
            spans.append(found)
        links = []
        low = 0
        for start, stop, a in spans[0]:
            while low < len(spans[1]) and spans[1][low][1] <= start:
                low += 1
            at = low
            while at < len(spans[1]) and spans[1][at][0] < stop:
                links.append((a, spans[1][at][2]))
                at += 1
        ends = sorted({stop for _, stop, _ in spans[0]} & {stop for _, stop, _ in spans[1]})
        groups, begin = [], 0
        for end in ends:
            sides = [[i for start, stop, i in found if begin <= start and stop <= end] for found in spans]
            groups.append("|".join(",".join(map(str, side)) for side in sides))
            begin = end
        held.update(set(links))
        rows.append((key, len(a_ids), len(b_ids), groups, links))
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    return sorted(
        (
            (
                key, n_a, n_b, len(groups), len(links), sum(held[link] == best[link[0]] for link in links),
                sum(held[link] for link in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
            )
            for key, n_a, n_b, groups, links in rows
        ),
        key=str,
    )


def rows_of(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert df.columns == names
    return sorted(map(tuple, df.collect()), key=str)


ODD = [
    (1, "Hello world, hello WORLD  two  spaces\n\nnew\tline"),
    (2, "<s>[INST] </s> <|endoftext|> <unk> <0x41>"),
    (3, "tab\tand nbsp ▁ piece mark"),
    (4, "日本語のテキスト und Übergrößenträger 😀😀 é"),
    (5, " leading and trailing "),
    (6, "\n"),
    (7, "a" * 3000 + " " + "ab" * 500),
    (8, "ﬁ ligature Ω ohm ½ ½"),
    (9, "x\x00y \r\n z"),
]


def test_against_brute_force(spark):
    rows = awkward(ODD)
    assert rows_of(alignment.compare(documents(spark, rows), VOCABULARY, PIECES)) == plain(rows)


def test_given_documents(spark):
    rows = [(row.doc_id, row.text) for row in table(spark, SMALL, "documents").collect() if len(row.text or "") < 4000]
    docs = documents(spark, rows)
    wanted = plain(rows)
    assert rows_of(alignment.compare(docs, VOCABULARY, PIECES)) == wanted
    assert rows_of(alignment.compare(docs, VOCABULARY, PIECES, ranks=RANKS)) == wanted
    # Rare pairs are joined instead of broadcast; nothing changes.
    assert rows_of(alignment.compare(docs, VOCABULARY, PIECES, hot_pairs=50)) == wanted
    assert rows_of(alignment.compare(docs, VOCABULARY, PIECES, hot_pairs=0)) == wanted


def test_query(spark):
    found = op12_alignment(spark, SMALL)
    assert found.count() == table(spark, SMALL, "documents").count()


def test_forgetting_changes_nothing():
    texts = [text for _, text in ODD]
    small, large = (alignment.Aligner(VOCABULARY, PIECES, memory=memory) for memory in (1, 1 << 18))
    for _ in range(2):
        for text in texts:
            for one, other in zip(small.align_texts([text]), large.align_texts([text]), strict=True):
                assert list(one) == list(other)


def test_both_libraries_give_the_same_first_ids():
    """For every character that goes to the faster one, beside letters, digits, marks and space."""
    fast, slow = alignment.Aligner(VOCABULARY, PIECES, RANKS), alignment.Aligner(VOCABULARY, PIECES)
    rng = random.Random(1)
    near = ["a", "1", "!", " ", "\n", "\u00a0", "'s", "é", "<|endoftext|>", ""]
    texts = [" " + a + chr(code) + b + chr(code) for code in range(0x250) for a in near for b in near]
    texts += ["".join(chr(rng.randrange(0x250)) for _ in range(200)) for _ in range(3000)]
    texts += [" " + text for _, text in ODD] + ["a" * 5000, " " * 5000, "x\n" * 3000]
    assert sum(alignment.WIDE.search(text) is None for text in texts) > 60_000
    assert fast.first_ids(texts) == slow.first_ids(texts)


def test_windows_split_long_texts():
    found = alignment.Aligner(VOCABULARY, PIECES)
    text = "many common words in one long text " * 90_000
    n_a, _, n_groups, *_ = found.align_texts([text])
    assert len(text) > 3 << 20 and n_groups[0] > 600_000 and n_a[0] > 600_000
    assert len(found.groups) < 50


def test_empty_and_clashing(spark):
    assert alignment.compare(spark.createDataFrame([], TEXT), VOCABULARY, PIECES).count() == 0
    docs = documents(spark, ODD)
    clash = docs.selectExpr("*", "1 AS place", "2 AS pairs", "3 AS n_a")
    assert rows_of(alignment.compare(clash, VOCABULARY, PIECES)) == rows_of(alignment.compare(docs, VOCABULARY, PIECES))
