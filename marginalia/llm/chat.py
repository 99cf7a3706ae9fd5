"""Conversations as training windows: turn-aligned spans within a token budget.

Turns are taken in the order of (turn, role, text). Running sums of turn tokens decide where a
window ends: it holds the system turn, repeated turns of at most ``HISTORY`` tokens, and as many
new turns as ``BUDGET`` leaves room for, at least one. A conversation's leading system turn is
retained in every window. Only assistant turns that are new in a window are targets; repeated ones
are masked, so each assistant text is learned once.

A turn is written as ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end.
Control strings in texts and roles, of this template and of other common ones, get a backslash
after their first character, and backslashes are doubled, which ``unescape`` reverses.

A task streams over its conversations, sorted, and holds one window at a time, however long a
conversation is. Tokens are those of the turn as written, marks and escapes included, in a given
byte-level BPE file. Its pieces never reach over the line end between two turns, so the tokens of
a window are the sum of its turns'. They are counted where the rows lie, before the shuffle. Without
a file they are estimated: words or a quarter of the code points, whichever is more, and four for
the marks.

Defined cases: null texts and roles are empty; rows of a null conversation id form one
conversation; repeated rows are turns of their own; an empty table gives none; a turn over the
budget has a window of its own (with the system turn), never cut; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.alignment import WIDE
from marginalia.llm.bpe import codec
from marginalia.llm.text import flat, steps, strings

BUDGET, HISTORY, MARKS = 512, 128, 4
START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = re.compile(r"\\|<\|(?:im_start|im_end|endoftext|system|user|assistant)\|>|</?s>|\[/?INST\]|<</?SYS>>")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)

WINDOWS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int64()),
        ("text", pa.string()),
        ("repeated", pa.int32()),
        ("targets", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)
WINDOW_COLUMNS = "conv_id long, window long, text string, repeated int, targets array<struct<start: int, end: int>>"

Turn = tuple[str, str, int]


def escape(text: str) -> str:
    return CONTROL.sub(lambda match: match[0][0] + "\\" + match[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def tokens(text: str) -> int:
    """An estimate, for want of a vocabulary."""
    return max(len(text.split()), -(-len(text) // 4)) + MARKS


def windows(turns: Iterable[Turn], budget: int = BUDGET, history: int = HISTORY) -> Iterator[tuple[list[Turn], list[Turn]]]:
    """(repeated, new) turns of each window of one conversation, from (role, text, tokens)."""
    system: list[Turn] = []
    # Turns of the open window but for the system turn, of which ``old`` are repeated, and the
    # running sums of their tokens.
    held: list[Turn] = []
    sums, old, first = [0], 0, True
    for turn in turns:
        fixed = sum(size for _, _, size in system)
        if (first and system or len(held) > old) and fixed + sums[-1] + turn[2] > budget:
            yield held[:old] if first else system + held[:old], (system if first else []) + held[old:]
            room = max(0, min(history, budget - fixed - turn[2]))
            start = bisect_left(sums, sums[-1] - room)
            held, sums = held[start:], [value - sums[start] for value in sums[start:]]
            old, first = len(held), False
        if first and not system and not held and turn[0] == "system":
            system = [turn]
            continue
        held.append(turn)
        sums.append(sums[-1] + turn[2])
    if first and system or len(held) > old:
        yield held[:old] if first else system + held[:old], (system if first else []) + held[old:]


def head(role: str) -> str:
    """What comes before a turn's text."""
    return START + json.dumps(escape(role), ensure_ascii=False)[1:-1] + "\n"


def write(repeated: list[Turn], new: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """The text of a window and the places of its targets."""
    parts: list[str] = []
    targets, at = [], 0
    for number, (role, text, _) in enumerate([*repeated, *new]):
        before = head(role)
        body = escape(text)
        if role == "assistant" and number >= len(repeated):
            targets.append((at + len(before), at + len(before) + len(body)))
        parts += [before, body, END]
        at += len(before) + len(body) + len(END)
    return "".join(parts), targets


def read(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a window."""
    turns = []
    for part in text.split(END)[:-1]:
        head, body = part.removeprefix(START).split("\n", 1)
        turns.append((unescape(json.loads(f'"{head}"')), unescape(body)))
    return turns


def _conversations(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """(conversation id, its rows) from rows sorted by id; both are streams."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(name).to_pylist() for name in ("conv_id", *columns)), strict=True)

    stream = rows()
    ahead = next(stream, None)

    def group(key):
        nonlocal ahead
        while ahead is not None and ahead[0] == key:
            yield ahead[1:]
            ahead = next(stream, None)

    while ahead is not None:
        key = ahead[0]
        members = group(key)
        yield key, members
        for _ in members:
            pass


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(values), field.type) for values, field in zip(zip(*held, strict=True), schema, strict=True)],
            schema=schema,
        )

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


@lru_cache(maxsize=1)
def _ranked(path: str, pattern: str):
    """The encoder of a file of ranks in this worker, made once."""
    import tiktoken

    with open(path, "rb") as file:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def token_counts(texts: list[str], path: str, ranks: tuple[str, str] | None = None) -> list[int]:
    """Tokens of each text, see ``format_windows`` for ``path`` and ``ranks``."""
    sure = [ranks is not None and WIDE.search(text) is None for text in texts]
    others = [text for text, known in zip(texts, sure, strict=True) if not known]
    slow = iter(codec(path).encode(others, *flat(pa.array(others, pa.large_string()))) if others else [])
    return [
        len(_ranked(*ranks).encode_ordinary(text) if known else next(slow)) for text, known in zip(texts, sure, strict=True)
    ]


def count_tokens(turns: DataFrame, path: str | None = None, ranks: tuple[str, str] | None = None) -> DataFrame:
    """``turns`` (``conv_id``, ``turn``, ``role``, ``text``) with the tokens of each as written (``size``)."""

    def sizes(part: pa.RecordBatch) -> list[int]:
        texts = strings(part.column("text"))
        if path is None:
            return [tokens(text) for text in texts]
        roles = strings(part.column("role"))
        written = [head(role) + escape(text) + END for role, text in zip(roles, texts, strict=True)]
        return token_counts(written, path, ranks)

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(sizes(part), pa.int64())], [*part.schema.names, "size"]
                )

    return turns.mapInArrow(scan, "conv_id long, turn long, role string, text string, size long")


def format_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    path: str | None = None,
    ranks: tuple[str, str] | None = None,
) -> DataFrame:
    """Windows of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``): ``conv_id``,
    ``window`` from 0, ``text``, number of leading ``repeated`` turns, ``targets`` in code points.

    ``path`` is a byte-level BPE file every executor can open; ``budget`` and ``history`` count its tokens.
    ``ranks`` may name the same vocabulary as a file of ranks and its piece pattern: a faster library then
    counts texts of characters that both libraries are sure to class alike.
    """
    source = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("role", "text")),
    )
    ordered = count_tokens(source, path, ranks).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def rows(batches):
        for key, turns in _conversations(batches, "role", "text", "size"):
            for number, (repeated, new) in enumerate(windows(turns, budget, history)):
                text, targets = write(repeated, new)
                yield key, number, text, len(repeated), [{"start": low, "end": high} for low, high in targets]

    return ordered.mapInArrow(lambda batches: _batches(rows(batches), WINDOWS), WINDOW_COLUMNS)


def read_turns(formatted: DataFrame) -> DataFrame:
    """(``conv_id``, ``window``, ``place``, ``role``, ``text``) of the turns that are new in their window."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("window", pa.int64()), ("place", pa.int32()), ("role", pa.string()), ("text", pa.string())]
    )

    def rows(batches):
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "window", "text", "repeated"))
            for key, window, text, repeated in zip(*columns, strict=True):
                for place, (role, body) in enumerate(read(text)[repeated:]):
                    yield key, window, place, role, body

    return formatted.select("conv_id", "window", "text", "repeated").mapInArrow(
        lambda batches: _batches(rows(batches), schema), "conv_id long, window long, place int, role string, text string"
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: ``n_turns``, ``turns_sha256`` (role, line end,
    text, line end), ``loss_chars`` and ``loss_sha256`` of the targets, ``formatted_chars``."""
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window")

    def rows(batches):
        for key, members in _conversations(batches, "text", "repeated", "targets"):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            count = learned = chars = 0
            for text, repeated, targets in members:
                chars += len(text)
                for role, body in read(text)[repeated:]:
                    turns.update(f"{role}\n{body}\n".encode())
                    count += 1
                for target in targets:
                    body = unescape(text[target["start"] : target["end"]])
                    loss.update(body.encode())
                    learned += len(body)
            yield key, count, turns.hexdigest(), learned, loss.hexdigest(), chars

    return ordered.mapInArrow(
        lambda batches: _batches(rows(batches), schema),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
