"""Byte-level helpers the operators share: bounded slices of Arrow columns, words, hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes one numpy step works on; a longer single text is a step of its own.
STEP_BYTES = 2 << 20
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = 0x9E3779B97F4A7C15


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with about ``limit`` bytes of ``column`` each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) one after another, and row offsets."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def strings(column: pa.Array) -> list[str]:
    """Python strings; null is empty."""
    return [value or "" for value in column.to_pylist()]


def unused_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores behind it until no column (in any case) has it."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(values: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on all input bits."""
    values = (values ^ (values >> np.uint64(30))) * MIX_A
    values = (values ^ (values >> np.uint64(27))) * MIX_B
    return values ^ (values >> np.uint64(31))


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, STEP_BYTES + 1)
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"][:n]


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


def word_hashes(raw: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray):
    """64-bit hash, row and place of every word.

    A word is a longest run of bytes for which ``word_byte`` (256 flags) holds; rows of
    ``offsets`` end words. Sums of prefixes give all hashes without a loop over words.
    """
    n = len(raw)
    if not n:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty
    inside = word_byte[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    up, down = _power_tables(n)
    sums = np.cumsum(_BYTE_CODES[raw] * up, dtype=np.uint64)
    before = np.where(first > 0, sums[np.maximum(first, 1) - 1], np.uint64(0))
    hashes = mix((sums[last] - before) * down[first] + (last - first).astype(np.uint64))
    rows = np.searchsorted(offsets, first, side="right") - 1
    return hashes, rows, first


def gram_hashes(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of ``width`` words inside one row."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(count, np.uint64)
    for place in range(width):
        total += words[place : place + count] * np.uint64(pow(_ODD, 2 * place + 1, 1 << 64))
    whole = rows[:count] == rows[width - 1 :]
    return mix(total[whole]), rows[:count][whole]
