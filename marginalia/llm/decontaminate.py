"""Benchmark items inside documents: containment search with size-partitioned MinHash sketches.

A shingle is five consecutive words, lower-cased; a word is a run of ASCII letters or digits and
bytes beyond ASCII. An item is in a document if at least 80 % of its different shingles are.

Items are partitioned by their number of shingles n. The sketch of an item holds its smallest
hashes, ``n - ceil(0.8 n) + 1`` of them: a document that contains the item misses at most
``n - ceil(0.8 n)`` shingles, so it must hold one of the sketch, however long the document is.
Documents with fewer than ``ceil(0.8 n)`` shingles are out by size. What is left is verified by
exact containment of the shingles themselves. Documents are scanned where they lie; the items,
a stated query set, go to the tasks in blocks of bounded size.

Defined cases: null or empty texts have no shingle and match nothing; an item of fewer than five
words is one shingle of all its words and must occur whole; repeated documents give repeated
rows, equal items (same id and text) count once; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.text import flat, gram_hashes, steps, word_hashes

WIDTH, THRESHOLD = 5, 0.8
# Characters of item text that one block, and so one task's index, holds.
BLOCK_CHARS = 16_000_000
FILTER_BITS = 22

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
WORD_BYTE = np.array([bool(WORD.match(bytes([code]))) for code in range(256)])


def _grams(words: list[bytes], width: int) -> list[bytes]:
    return [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]


class Index:
    """Sketches of one block of items, by shingle width."""

    def __init__(self, items: pa.Table, threshold: float):
        self.items: list[tuple[int | None, int, frozenset[bytes], int]] = []
        sketches: dict[int, list[tuple[int, int]]] = {}
        lowered = pc.utf8_lower(pc.fill_null(items.column("text"), ""))
        for item_id, text in zip(items.column("item_id").to_pylist(), lowered.to_pylist(), strict=True):
            words = WORD.findall(text.encode())
            if not words:
                continue
            width = min(WIDTH, len(words))
            grams = sorted(set(_grams(words, width)))
            raw, offsets = flat(pa.array([gram.decode() for gram in grams]))
            hashes, rows, _ = word_hashes(raw, offsets, WORD_BYTE)
            codes = np.sort(gram_hashes(hashes, rows, width)[0])
            least = math.ceil(threshold * len(grams) - 1e-9)
            number = len(self.items)
            self.items.append((item_id, width, frozenset(grams), least))
            for code in codes[: len(grams) - least + 1]:
                sketches.setdefault(width, []).append((int(code), number))
        self.widths = {}
        for width, entries in sketches.items():
            entries.sort()
            codes = np.array([code for code, _ in entries], np.uint64)
            mask = np.zeros(1 << FILTER_BITS, bool)
            mask[(codes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
            self.widths[width] = (codes, np.array([number for _, number in entries]), mask)

    def candidates(self, texts: pa.Array) -> np.ndarray:
        """Pairs (row, item number) that share a sketch hash and may match by size."""
        raw, offsets = flat(texts)
        words, rows, _ = word_hashes(raw, offsets, WORD_BYTE)
        found = []
        for width, (codes, numbers, mask) in self.widths.items():
            hashes, owners = gram_hashes(words, rows, width)
            hit = np.flatnonzero(mask[(hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
            low = np.searchsorted(codes, hashes[hit], side="left")
            high = np.searchsorted(codes, hashes[hit], side="right")
            sizes = np.bincount(owners, minlength=len(texts))
            for place in np.flatnonzero(high > low):
                row = int(owners[hit[place]])
                for number in numbers[low[place] : high[place]]:
                    if sizes[row] >= self.items[number][3]:
                        found.append((row, int(number)))
        return np.unique(np.array(found, np.int64).reshape(-1, 2), axis=0)

    def matches(self, texts: pa.Array) -> list[tuple[int, int, float]]:
        """(row, item number, containment) of all true matches among ``texts``."""
        if not self.widths or not len(texts):
            return []
        texts = pc.utf8_lower(pc.fill_null(texts, ""))
        out, current, held = [], -1, {}
        for row, number in self.candidates(texts).tolist():
            if row != current:
                current, held = row, {}
                words = WORD.findall(texts[row].as_py().encode())
            _, width, grams, least = self.items[number]
            if width not in held:
                held[width] = set(_grams(words, width))
            shared = len(grams & held[width])
            if shared >= least:
                out.append((row, number, shared / len(grams)))
        return out


def _blocks(items: DataFrame, threshold: float) -> Iterator[Index]:
    """Indexes over bounded blocks of the different items."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_CHARS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for number in range(blocks):
        yield Index(items.filter(block == number).toArrow(), threshold)


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Pairs (``doc_id``, ``item_id``, ``containment``) of all documents that contain an item."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("containment", pa.float64())])
    found = None
    for index in _blocks(items, threshold):
        shared = spark.sparkContext.broadcast(index)

        def scan(batches, shared=shared):
            for batch in batches:
                for part in steps(batch, "text"):
                    rows = shared.value.matches(part.column("text"))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id").take(pa.array([row for row, _, _ in rows], pa.int64())),
                            pa.array([shared.value.items[number][0] for _, number, _ in rows], pa.int64()),
                            pa.array([value for _, _, value in rows], pa.float64()),
                        ],
                        schema=schema,
                    )

        block = source.mapInArrow(scan, "doc_id long, item_id long, containment double")
        found = block if found is None else found.unionByName(block)
    return found


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, that contain no benchmark item."""
    spark = docs.sparkSession
    for index in _blocks(items, threshold):
        shared = spark.sparkContext.broadcast(index)

        def scan(batches, shared=shared):
            for batch in batches:
                for part in steps(batch, text_col):
                    keep = np.ones(part.num_rows, bool)
                    keep[[row for row, _, _ in shared.value.matches(part.column(text_col))]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs
