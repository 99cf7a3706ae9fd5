"""Alignment of two tokenizers' ids over the same bytes, and counts of aligned id pairs.

A text is tokenised in full by both. Where tokens of both end at the same byte and the next tokens
of both begin with a space, the text is cut into windows: about a word each. A window is known by
its ids alone, so its alignment (the groups between shared ends, and the pairs of tokens that
overlap) is worked out once and remembered by the tuple of its ids; a text's alignment is the
sequence of its windows'. The memory is emptied when it is full, which costs time alone.

Every document's different id pairs, with how often each occurs in it, are staged with its other
results. A pair's count is the number of documents that hold it; it is summed in the map tasks.
The most frequent pairs, ``HOT_PAIRS`` at most, are broadcast to look up counts where the staged
rows lie, so that a pair that most documents hold is never shuffled; the rest are joined.

Defined cases: null and empty texts, and texts whose tokens of either kind do not spell a space and
the text, have no tokens: zeros and an empty digest; their ids count nowhere. Special tokens in a
text are plain text. Repeated rows count each time; null ids are kept; long texts are tokenised
whole; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.bpe import byte_symbols
from marginalia.llm.text import steps, strings
from marginalia.storage import stage

# Pairs whose counts every executor holds, of 24 bytes each.
HOT_PAIRS = 1 << 20
# Windows a task remembers.
MEMORY = 1 << 19
# Characters below U+0250, which every Unicode version classes alike.
WIDE = re.compile("[^\x00-\u024f]")
# What tells ids of the second kind in a window's tuple.
SECOND = 1 << 24
# An id pair is one number: the first id above this many bits, the second below.
ID_BITS = 31

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


class Aligner:
    """Both tokenizers and the remembered windows of one worker.

    ``ranks`` may name a file of the first vocabulary as ranks and its piece pattern: a faster
    library then encodes texts of characters that both libraries are sure to class alike.
    """

    def __init__(self, a_path: str, b_path: str, ranks: tuple[str, str] | None = None, memory: int = MEMORY):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        symbols = byte_symbols()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (1 + max(vocabulary.values()))
        for token, number in vocabulary.items():
            known = all(symbol in symbols for symbol in token)
            self.a_bytes[number] = bytes(symbols[symbol] for symbol in token) if known else token.encode()
        self.b_bytes = []
        for number in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(number)
            plain = piece.replace("▁", " ").encode()
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else plain)
        self.a_size, self.b_size = (np.array([len(item) for item in items]) for items in (self.a_bytes, self.b_bytes))
        self.a_space, self.b_space = (
            np.array([item.startswith(b" ") for item in items]) for items in (self.a_bytes, self.b_bytes)
        )
        # Ids as written inside a group and at its end.
        self.a_text, self.b_text = (
            np.array([[f"{i}{mark}" for i in range(len(items))] for mark in marks], object)
            for items, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;"))
        )
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks[0], "rb") as file:
                merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("first", pat_str=ranks[1], mergeable_ranks=merges, special_tokens={})
        self.memory = memory
        self.forget()

    def forget(self) -> None:
        """Empty the memory: numbers of windows by their ids, written groups, sizes and pairs."""
        self.known: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.n_groups, self.pairs, self.starts = array("q"), array("q"), array("q", [0])

    def first_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of the first kind of each text."""
        sure = [self.fast is not None and WIDE.search(text) is None for text in texts]
        slow = iter(self.a.encode_batch_fast([text for text, known in zip(texts, sure, strict=True) if not known], add_special_tokens=False))
        return [self.fast.encode_ordinary(text) if known else next(slow).ids for text, known in zip(texts, sure, strict=True)]

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both kinds of each text; none where they do not spell a space and the text."""
        spaced = [" " + text for text in texts]
        every_a = self.first_ids(spaced)
        every_b = self.b.encode(texts, num_threads=1)
        a_look, b_look = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for row, (text, a, b) in enumerate(zip(texts, every_a, every_b, strict=True)):
            whole = spaced[row].encode()
            if not text or b"".join(map(a_look, a)) != whole or b"".join(map(b_look, b)) != whole:
                every_a[row], every_b[row] = [], []
        return every_a, every_b

    def windows(self, a: np.ndarray, b: np.ndarray, a_rows: np.ndarray, b_rows: np.ndarray):
        """First token of each window and behind the last, of both kinds; the rows' ends cut too.

        ``a_rows`` and ``b_rows`` are the token offsets of the rows.
        """
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        shared, a_at, b_at = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        a_next, b_next = a_at + 1, b_at + 1
        last = np.zeros(len(a) + 1, bool)
        last[a_rows] = True
        cut = last[a_next]
        inner = np.flatnonzero(~cut)
        cut[inner] = self.a_space[a[a_next[inner]]] & self.b_space[b[b_next[inner]]]
        zero = np.zeros(1, np.int64)
        return np.concatenate([zero, a_next[cut]]), np.concatenate([zero, b_next[cut]])

    def align(self, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray):
        """Groups, numbers of groups and overlapping pairs, with their offsets, of windows that
        lie one after another; both sides of each spell the same bytes.

        A byte end of either kind closes exactly one overlap of two tokens; an end of both closes a
        group.
        """
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.union1d(a_ends, b_ends)
        a_of, b_of = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        pairs = a[a_of].astype(np.int64) << ID_BITS | b[b_of]
        shared = (a_ends[a_of] == ends) & (b_ends[b_of] == ends)
        closed = ends[shared]
        limits = a_ends[a_cuts[1:] - 1]
        n_groups = np.diff(np.searchsorted(closed, limits, side="right"), prepend=0)
        starts = np.searchsorted(ends, limits, side="right")
        # A group is written as its first ids and then its second ids, each with what follows it.
        a_group, b_group = np.searchsorted(closed, a_ends), np.searchsorted(closed, b_ends)
        a_last, b_last = np.diff(a_group, append=-1) != 0, np.diff(b_group, append=-1) != 0
        texts = np.empty(len(a) + len(b), object)
        texts[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = self.a_text[a_last.astype(np.int64), a]
        texts[np.arange(len(b)) + np.searchsorted(a_group, b_group, side="right")] = self.b_text[b_last.astype(np.int64), b]
        listed, bounds = texts.tolist(), (a_cuts + b_cuts).tolist()
        groups = ["".join(listed[low:high]) for low, high in zip(bounds[:-1], bounds[1:], strict=True)]
        return groups, n_groups, pairs, starts

    def learn(self, keys: list[bytes]) -> None:
        """Align windows that are met for the first time, all at once, and remember them."""
        ids = np.frombuffer(b"".join(keys), np.int32)
        ends = np.cumsum([len(key) // 4 for key in keys])
        second = ids >= SECOND
        b_cuts = np.concatenate([np.zeros(1, np.int64), np.cumsum(second)[ends - 1]])
        a_cuts = np.concatenate([np.zeros(1, np.int64), ends]) - b_cuts
        groups, n_groups, pairs, starts = self.align(ids[~second], ids[second] - SECOND, a_cuts, b_cuts)
        self.known.update(zip(keys, range(len(self.groups), len(self.groups) + len(keys)), strict=True))
        self.groups += groups
        self.n_groups.frombytes(n_groups.astype(np.int64).tobytes())
        self.starts.frombytes((starts + len(self.pairs)).astype(np.int64).tobytes())
        self.pairs.frombytes(pairs.tobytes())

    def align_texts(self, texts: list[str]):
        """Per text: numbers of tokens, groups and links, the written groups; and per text its
        different pairs with their occurrences, as flat arrays with offsets."""
        if len(self.groups) > self.memory:
            self.forget()
        every_a, every_b = self.tokens(texts)
        n_a, n_b = (np.array([len(ids) for ids in every], np.int64) for every in (every_a, every_b))
        a_rows, b_rows = (np.concatenate([[0], np.cumsum(sizes)]) for sizes in (n_a, n_b))
        a, b = (
            np.fromiter(chain.from_iterable(every), np.int32, sizes.sum()) for every, sizes in ((every_a, n_a), (every_b, n_b))
        )
        a_cuts, b_cuts = self.windows(a, b, a_rows, b_rows)
        # The ids of a window, first kind and then second, lie side by side: its key is one slice.
        ids = np.empty(len(a) + len(b), np.int32)
        ids[np.arange(len(a)) + np.repeat(b_cuts[:-1], np.diff(a_cuts))] = a
        ids[np.arange(len(b)) + np.repeat(a_cuts[1:], np.diff(b_cuts))] = b + SECOND
        raw, bounds = ids.tobytes(), (4 * (a_cuts + b_cuts)).tolist()
        keys = [raw[low:high] for low, high in zip(bounds[:-1], bounds[1:], strict=True)]
        fresh = [key for key in dict.fromkeys(keys) if key not in self.known]
        if fresh:
            self.learn(fresh)
        numbers = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        owners = np.searchsorted(a_rows, a_cuts[:-1], side="right") - 1
        starts, pairs = np.frombuffer(self.starts, np.int64), np.frombuffer(self.pairs, np.int64)
        sizes = starts[1:] - starts[:-1]
        n_groups = np.bincount(owners, np.frombuffer(self.n_groups, np.int64)[numbers], len(texts)).astype(np.int64)
        n_links = np.bincount(owners, sizes[numbers], len(texts)).astype(np.int64)
        bounds = np.searchsorted(owners, np.arange(len(texts) + 1)).tolist()
        listed = numbers.tolist()
        look = self.groups.__getitem__
        written = ["".join(map(look, listed[low:high]))[:-1] for low, high in zip(bounds[:-1], bounds[1:], strict=True)]
        # A text's windows are made distinct before their pairs are.
        windows, often = np.unique(owners * len(self.groups) + numbers, return_counts=True)
        rows, windows = np.divmod(windows, max(len(self.groups), 1))
        lengths = sizes[windows]
        places = np.repeat(starts[windows] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        rows, held, often = np.repeat(rows, lengths), pairs[places], np.repeat(often, lengths)
        # Rows fit above a pair's 47 bits unless a batch has many thousands of them.
        order = np.argsort(rows << 47 | held, kind="stable") if len(texts) < 1 << 16 else np.lexsort((held, rows))
        rows, held, often = rows[order], held[order], often[order]
        first = np.ones(len(rows), bool)
        first[1:] = (rows[1:] != rows[:-1]) | (held[1:] != held[:-1])
        at = np.flatnonzero(first)
        times = np.add.reduceat(often, at) if len(at) else often
        offsets = np.searchsorted(rows[at], np.arange(len(texts) + 1))
        # The views must go before the arrays grow again.
        result = (n_a, n_b, n_groups, n_links, written, held[at].copy(), times, offsets)
        del starts, pairs
        return result


_aligners: dict[tuple, Aligner] = {}


def aligner(*files) -> Aligner:
    """The aligner of these files in this worker, made once."""
    if files not in _aligners:
        _aligners[files] = Aligner(*files)
    return _aligners[files]


def aligned(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: tuple[str, str] | None = None,
) -> DataFrame:
    """Per document the numbers of tokens, groups and links, the digest of its groups, and its
    different id ``pairs`` with the ``times`` each occurs. Both files must be on every executor."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                found = aligner(a_path, b_path, ranks).align_texts(strings(part.column("text")))
                n_a, n_b, n_groups, n_links, written, pairs, times, offsets = found
                digests = [hashlib.sha256(text.encode()).hexdigest() if text else "" for text in written]
                offsets = pa.array(offsets.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *(pa.array(values) for values in (n_a, n_b, n_groups, n_links)),
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(pairs)),
                        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                    ],
                    COLUMNS,
                )

    return source.mapInArrow(scan, SCHEMA)


def pair_counts(documents: DataFrame) -> DataFrame:
    """(``pair``, ``n``, ``best``): documents that hold each pair, and whether no pair of its first
    id is held by more. ``documents`` has a ``pairs`` column as of ``aligned``."""
    counts = stage(documents.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    first = F.shiftright("pair", ID_BITS)
    # One row per id of the first vocabulary, which the tokenizer file bounds.
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), first == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def hot_bound(counts: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` pairs have that count or more."""
    level = F.floor(F.log2("n")).cast("int").alias("level")
    levels = {row.level: row.rows for row in counts.groupBy(level).agg(F.count("*").alias("rows")).collect()}
    held, bound = 0, max(levels, default=0) + 1
    while bound > 0 and held + levels.get(bound - 1, 0) <= most:
        bound -= 1
        held += levels.get(bound, 0)
    return 1 << bound


def _sums(links: DataFrame) -> DataFrame:
    return links.groupBy("place").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("n") * F.col("times")).cast("long").alias("count_sum"),
    )


def compare(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: tuple[str, str] | None = None,
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """Per document (``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum``, ``groups_sha256``): how its alignment agrees with all documents' alignments."""
    documents = stage(aligned(docs, a_path, b_path, id_col, text_col, ranks), "aligned").withColumn("place", F.monotonically_increasing_id())
    counts = stage(pair_counts(documents), "counts")
    bound = hot_bound(counts, hot_pairs)
    hot, cold = counts.filter(F.col("n") >= bound), counts.filter(F.col("n") < bound)
    links = documents.select("place", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("place", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    sums = _sums(links.join(F.broadcast(hot), "pair"))
    if bound > 1:
        rest = links.join(F.broadcast(hot.select("pair")), "pair", "left_anti")
        sums = sums.unionByName(_sums(rest.join(cold.hint("merge"), "pair")))
        sums = sums.groupBy("place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return documents.join(sums.hint("merge"), "place", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
