"""Byte-level BPE with reuse of content-defined chunks.

Texts are cut by a rolling hash, so passages that documents share give the same chunks; a task
encodes each different chunk once while it stays in its cache. A chunk's encoding is its list of
pieces (the units in which merges happen) and each piece's ids. A piece is settled by the three
characters after its end at most, so at a join the last pieces before it are taken back until
three characters are free, and the pieces after it are re-encoded together with them, one more at
a time, until an end falls on an end the right chunk has too. From there on both agree exactly.

Ids equal those of the tokenizers library for the file given (no normaliser, truncation or
padding); special tokens in a text are single ids, as there. Characters that the piece pattern
and the library class differently send their text to the library. Texts are encoded where they
lie; caches are bounded.

Defined cases: null is an empty text, which has no ids; equal rows give equal rows; null ids are
kept; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.chunking import Cuts, Sizes
from marginalia.llm.text import flat, steps, strings

SIZES = Sizes(least=64, normal=256, most=1024, hard=10, easy=6)
# The pieces of byte-level files: letters or digits or others with a space before them, contractions,
# white space but for its last one before a word. Letters are what ``re`` calls so; see ``_settle``.
PIECE = re.compile(r" ?[^\W\d_]++|'(?:s|t|re|ve|m|ll|d)| ?\d++| ?(?:[^\s\w]|_)++|\s+(?!\S)|\s+")
AHEAD = 3
PIECE_CACHE, CHUNK_CACHE_BYTES = 200_000, 16 << 20


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + place): byte for place, byte in enumerate(others)}


class Codec:
    """Encoder and decoder of one byte-level BPE file, with bounded caches."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        symbols = byte_symbols()
        self.special = {token["content"]: token["id"] for token in stored["added_tokens"]}
        self.bytes_of = [b""] * (1 + max(chain(stored["model"]["vocab"].values(), self.special.values())))
        for token, number in stored["model"]["vocab"].items():
            self.bytes_of[number] = bytes(symbols[symbol] for symbol in token)
        for token, number in self.special.items():
            self.bytes_of[number] = token.encode()
        names = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.split = re.compile(f"({names})").split if names else None
        self.ids: dict[str, tuple[int, ...]] = {}
        self.chunks: dict[str, list[str]] = {}
        self.held = 0
        self.known: set[str] = set()
        self.odd: set[str] = set()

    def _settle(self, symbols: set[str]) -> None:
        """Find out which new characters pattern and library class alike."""
        for symbol in symbols:
            self.known.add(symbol)
            for probe in (f"a{symbol}a", f"1{symbol}1", f"!{symbol}!", f" {symbol} ", f"{symbol}{symbol} "):
                pieces = [probe[low:high] for _, (low, high) in self.library.pre_tokenizer.pre_tokenize_str(probe)]
                if pieces != PIECE.findall(probe):
                    self.odd.add(symbol)

    def _pieces_of(self, chunk: str) -> list[str]:
        pieces = self.chunks.get(chunk)
        if pieces is None:
            if self.held > CHUNK_CACHE_BYTES:
                self.chunks.clear()
                self.held = 0
            pieces = self.chunks[chunk] = PIECE.findall(chunk)
            # A character costs about ten bytes with the list of its pieces.
            self.held += 10 * len(chunk)
        return pieces

    def join(self, pieces: list[str], right: list[str]) -> None:
        """Append the pieces of the next chunk, repairing the join."""
        free, tail = 0, []
        while pieces and free < AHEAD:
            tail.append(pieces.pop())
            free += len(tail[-1])
        window = "".join(reversed(tail))
        place, ends = 0, {free: 0}
        while place < len(right):
            window += right[place]
            place += 1
            ends[len(window)] = place
            again, at = PIECE.findall(window), 0
            for number, piece in enumerate(again):
                if at >= free and at in ends and at <= len(window) - AHEAD:
                    pieces += again[:number]
                    pieces += right[ends[at] :]
                    return
                at += len(piece)
        pieces += PIECE.findall(window)

    def pieces(self, texts: list[str], raw: np.ndarray, offsets: np.ndarray) -> list[list[str] | None]:
        """The pieces of each text; None for a text that goes to the library."""
        cuts = Cuts(raw, SIZES)
        data = raw.tobytes()
        out: list[list[str] | None] = []
        for row, text in enumerate(texts):
            symbols = set(text)
            if not symbols <= self.known:
                self._settle(symbols - self.known)
            if self.odd and not self.odd.isdisjoint(symbols):
                out.append(None)
                continue
            start, pieces = int(offsets[row]), []
            for number, segment in enumerate(self.split(text) if self.split else [text]):
                stop = start + (len(segment) if segment.isascii() else len(segment.encode()))
                if number % 2:
                    pieces.append(segment)
                else:
                    own: list[str] = []
                    for end in cuts.ends(start, stop):
                        found = self._pieces_of(data[start:end].decode())
                        if own:
                            self.join(own, found)
                        else:
                            own = found.copy()
                        start = end
                    pieces += own
                start = stop
            out.append(pieces)
        return out

    def encode(self, texts: list[str], raw: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
        """Ids of each text; ``raw`` and ``offsets`` are the same texts as bytes."""
        found = self.pieces(texts, raw, offsets)
        every = set(chain.from_iterable(filter(None, found)))
        fresh = every.difference(self.ids)
        if len(self.ids) + len(fresh) > PIECE_CACHE:
            self.ids.clear()
            fresh = every
        ordered = list(fresh)
        encodings = self.library.encode_batch_fast(ordered, add_special_tokens=False)
        self.ids.update(zip(ordered, (tuple(encoding.ids) for encoding in encodings), strict=True))
        look = self.ids.__getitem__
        return [
            list(chain.from_iterable(map(look, pieces)))
            if pieces is not None
            else self.library.encode(text, add_special_tokens=False).ids
            for text, pieces in zip(texts, found, strict=True)
        ]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``, special tokens included; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of ``path`` in this worker, made once."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``ids``) of each row; ``path`` is a tokenizer file every executor can open."""

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                ids = codec(path).encode(strings(part.column("text")), *flat(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
                )

    return _texts(docs, id_col, text_col).mapInArrow(scan, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(``doc_id``, ``text``) of each row of ids; null ids give an empty text."""
    source = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))

    def scan(batches):
        for batch in batches:
            texts = [codec(path).decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return source.mapInArrow(scan, "doc_id long, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``) of each row, encoded and
    decoded in one pass; with ``keep_ids`` the ``ids`` too."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def scan(batches):
        number = [str(value) for value in range(len(codec(path).bytes_of))]
        for batch in batches:
            for part in steps(batch, "text"):
                every = codec(path).encode(strings(part.column("text")), *flat(part.column("text")))
                columns = [
                    part.column("doc_id"),
                    pa.array(map(len, every), pa.int64()),
                    pa.array(digest(",".join(map(number.__getitem__, ids))) for ids in every),
                    pa.array(digest(codec(path).decode(ids)) for ids in every),
                ]
                if keep_ids:
                    columns.append(pa.array(every, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _texts(docs, id_col, text_col).mapInArrow(scan, kinds + ", ids array<int>" * keep_ids)
