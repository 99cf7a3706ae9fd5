"""Secrets in texts: fixed patterns, and formats learned from what they catch.

Base spans, leftmost and non-overlapping per kind, are ``assign`` (a named value), ``access``
(access keys) and ``hex`` (long hexadecimal runs); offsets are code points, the end exclusive.
Their strings are labelled credentials. Per kind, a prefix tree of a sample of them is turned into
a probabilistic automaton: states whose end and next-symbol frequencies the Hoeffding bound cannot
tell apart are merged, from the root outwards. Every other run of credential characters is a
candidate, and so is what a base span leaves of a run on either side, without the glue characters
next to the span. A candidate has at least as many characters as the shortest labelled string or
``RUN_LEAST``, whichever is less. It becomes a ``format`` span if some automaton finds it as likely,
per symbol, as all but the least likely ``OUTLIERS`` of its labelled strings, and clearly likelier
than the neighbouring symbols of all candidates of ``ASSIGN_LEAST`` characters in the corpus make it:
ordinary words and numbers are rejected by that margin, not by a filter.

The automata are fitted on at most ``SAMPLE`` different strings per kind, those with the least
hash; base spans, symbol counts and scores cover all texts. Texts are scanned where they lie; only
labelled strings and counts of symbol pairs are shuffled, summed in the map tasks first.

Defined cases: null and empty texts have no span; equal rows give equal rows; a corpus without
labelled strings has no ``format`` span; null ids are kept; other columns are ignored by
``find`` and kept by ``redact``.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.text import flat, steps, strings
from marginalia.storage import stage

# The patterns of the base kinds and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "format")
# Every match of ASSIGN holds one of these, whatever its case.
NAMED = ("passw", "secret", "token", "api")

RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
GLUE = "+/_.=-"
RUN_LEAST = 12
# Different strings whose decisions a task remembers.
REMEMBERED = 200_000
SAMPLE, ALPHA, CERTAIN = 1000, 0.05, 10
OUTLIERS, MARGIN = 0.05, 0.35
SPANS = "array<struct<kind: string, start: int, end: int>>"

_HEX_BYTE = np.isin(np.arange(256), list(b"0123456789abcdef"))


def base_spans(text: str, may_hold_hex: bool = True) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of the fixed patterns."""
    found = []
    folded = text.lower()
    if any(name in folded for name in NAMED):
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= ASSIGN_LEAST:
                found.append(("assign", match.start(), match.end(), match[2]))
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if len(match[0]) >= ACCESS_LEAST:
                found.append(("access", match.start(), match.end(), match[0]))
    if may_hold_hex:
        for match in HEX.finditer(text):
            if len(match[0]) >= HEX_LEAST:
                found.append(("hex", match.start(), match.end(), match[0]))
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


def candidates(text: str, base: list[tuple[str, int, int, str]], least: int = RUN_LEAST) -> list[tuple[int, int]]:
    """Runs of ``least`` or more credential characters, and such parts of runs beside base spans."""
    out, ahead, high = [], 0, 0
    for run in RUN.finditer(text):
        start, stop = run.span()
        if stop - start < least:
            continue
        # Spans are sorted by start; ``high`` is the furthest end of those before the run.
        while ahead < len(base) and base[ahead][1] < start:
            high = max(high, base[ahead][2])
            ahead += 1
        at, cut, place = start, high > start, ahead
        if cut:
            at = min(high, stop)
        while place < len(base) and base[place][1] < stop:
            low, end = base[place][1:3]
            if low > at:
                out.append(_trimmed(text, at, low, cut, True))
            at, cut, place = max(at, min(end, stop)), True, place + 1
        if at < stop:
            out.append(_trimmed(text, at, stop, cut, False))
    return [(low, end) for low, end in out if end - low >= least]


def _trimmed(text: str, low: int, high: int, left: bool, right: bool) -> tuple[int, int]:
    """The part without glue characters on the sides where a base span is."""
    if right:
        high = low + len(text[low:high].rstrip(GLUE))
    if left:
        low = high - len(text[low:high].lstrip(GLUE))
    return low, high


def _rows(column: pa.Array):
    """(text, may it hold a long hexadecimal run) of each row."""
    raw, offsets = flat(column)
    count = len(column)
    # Places that end a run: other bytes, and row bounds.
    stop = np.ones(len(raw) + 1, bool)
    stop[:-1] = ~_HEX_BYTE[raw]
    stop[offsets] = True
    stops = np.flatnonzero(stop)
    long_runs = stops[:-1][np.diff(stops) >= HEX_LEAST]
    has_hex = np.zeros(count, bool)
    has_hex[np.clip(np.searchsorted(offsets, long_runs, side="right") - 1, 0, max(count - 1, 0))] = True
    return zip(strings(column), has_hex.tolist(), strict=True)


SYMBOLS = [chr(code) for code in range(128) if RUN.match(chr(code))]


class Automaton:
    """A probabilistic automaton over characters, merged from the prefix tree of ``samples``."""

    def __init__(self, samples: list[str], alpha: float = ALPHA):
        self.visits, self.ends, self.next = [0], [0], [{}]
        for sample in samples:
            state = 0
            self.visits[0] += 1
            for symbol in sample:
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.visits)
                    self.visits.append(0)
                    self.ends.append(0)
                    self.next.append({})
                state = self.next[state][symbol]
                self.visits[state] += 1
            self.ends[state] += 1
        # How often each arc is taken, kept apart from the visits of the state it leads to.
        self.taken = [{symbol: self.visits[to] for symbol, to in arcs.items()} for arcs in self.next]
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        alphabet = {symbol for arcs in self.next for symbol in arcs}
        self.size = len(alphabet) + 1
        shares = [self.visits[state] + 0.1 * self.size + 1 for state in range(len(self.visits))]
        best = {symbol: 0.1 / min(shares) for symbol in SYMBOLS}
        for share, arcs in zip(shares, self.taken, strict=True):
            for symbol, times in arcs.items():
                best[symbol] = max(best[symbol], (times + 0.1) / share)
        # No string scores higher than its symbols do in the states that suit them best.
        self.best = {symbol: math.log(value) for symbol, value in best.items()}
        self.best_end = math.log(max((ends + 0.1) / share for ends, share in zip(self.ends, shares, strict=True)))
        self.least = 0.0
        likely = sorted(self.score(sample) for sample in samples)
        if likely:
            self.least = likely[int(OUTLIERS * len(likely))]

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        if n1 < CERTAIN or n2 < CERTAIN:
            return False
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, first: int, second: int) -> bool:
        pairs = [(first, second)]
        while pairs:
            a, b = pairs.pop()
            if self.visits[a] < CERTAIN or self.visits[b] < CERTAIN:
                continue
            if self._differ(self.ends[a], self.visits[a], self.ends[b], self.visits[b]):
                return False
            for symbol in sorted(self.taken[a].keys() | self.taken[b].keys()):
                if self._differ(
                    self.taken[a].get(symbol, 0), self.visits[a], self.taken[b].get(symbol, 0), self.visits[b]
                ):
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    pairs.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add the subtree ``tree`` to the states reached from ``into``."""
        todo = [(into, tree)]
        while todo:
            a, b = todo.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for symbol, to in self.next[b].items():
                self.taken[a][symbol] = self.taken[a].get(symbol, 0) + self.taken[b][symbol]
                if symbol in self.next[a]:
                    todo.append((self.next[a][symbol], to))
                else:
                    self.next[a][symbol] = to

    def _merge_states(self) -> None:
        kept, seen = [0], {0}
        edge = deque((0, symbol) for symbol in sorted(self.next[0]))
        while edge:
            state, symbol = edge.popleft()
            to = self.next[state][symbol]
            if to in seen:
                continue
            for other in kept:
                if self._compatible(other, to):
                    self.next[state][symbol] = other
                    self._fold(other, to)
                    # Folding may hang new subtrees below kept states.
                    edge.extend((k, s) for k in kept for s in sorted(self.next[k]) if self.next[k][s] not in seen)
                    break
            else:
                kept.append(to)
                seen.add(to)
                edge.extend((to, s) for s in sorted(self.next[to]))
        self.kept = kept

    def score(self, text: str) -> float:
        """Mean natural log probability per symbol, the end included; unseen symbols are smoothed."""
        state, total = 0, 0.0
        for symbol in text:
            visits = self.visits[state]
            total += math.log((self.taken[state].get(symbol, 0) + 0.1) / (visits + 0.1 * self.size + 1))
            state = self.next[state].get(symbol, state)
        total += math.log((self.ends[state] + 0.1) / (self.visits[state] + 0.1 * self.size + 1))
        return total / (len(text) + 1)


class Formats:
    """The automata, the least length, and the shares of symbol pairs in all candidates."""

    def __init__(self, labelled: dict[str, list[str]], pairs: dict[tuple[str, str], int], least: int = RUN_LEAST):
        self.least = min(least, RUN_LEAST)
        self.automata = [Automaton(sorted(samples)) for _, samples in sorted(labelled.items()) if samples]
        # A space is before the first and after the last symbol.
        befores, symbols = Counter(), Counter()
        for (before, symbol), n in pairs.items():
            befores[before] += n
            symbols[symbol] += n
        total, kinds = sum(symbols.values()), len(SYMBOLS) + 1
        self.pairs = {
            (before, symbol): math.log(
                (pairs.get((before, symbol), 0) + kinds * (symbols[symbol] + 1) / (total + kinds)) / (befores[before] + kinds)
            )
            for before in [" ", *SYMBOLS]
            for symbol in [" ", *SYMBOLS]
        }
        self.known: dict[str, bool] = {}

    def plain(self, text: str) -> float:
        """Mean natural log probability per symbol, the end included, in candidates of the corpus."""
        return sum(map(self.pairs.__getitem__, zip(" " + text, text + " ", strict=True))) / (len(text) + 1)

    def accepts(self, text: str) -> bool:
        known = self.known.get(text)
        if known is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            known = self.known[text] = self._likely(text)
        return known

    def _likely(self, text: str) -> bool:
        bar = self.plain(text) + MARGIN
        for automaton in self.automata:
            needed = max(bar, automaton.least)
            best = sum(map(automaton.best.__getitem__, text)) + automaton.best_end
            if best / (len(text) + 1) >= needed - 1e-9 and automaton.score(text) >= needed:
                return True
        return False

    def spans(self, text: str, may_hold_hex: bool = True) -> list[tuple[str, int, int]]:
        base = base_spans(text, may_hold_hex)
        spans = [span[:3] for span in base]
        if self.automata:
            parts = candidates(text, base, self.least)
            spans += [("format", low, high) for low, high in parts if self.accepts(text[low:high])]
            spans.sort(key=lambda span: (span[1], KINDS.index(span[0])))
        return spans


def _pair_counts(found: list[str]) -> np.ndarray:
    """How often one byte follows another (128 x 128) in ``found``, with spaces around each."""
    raw = np.frombuffer((" " + " ".join(found) + " ").encode(), np.uint8).astype(np.int64)
    return np.bincount(raw[:-1] * 128 + raw[1:], minlength=1 << 14)


def _found(docs: DataFrame, text_col: str) -> DataFrame:
    """(``kind``, ``string``, ``n``): credentials of the base kinds, and symbol pairs of candidates."""
    source = docs.select(F.col(text_col).cast("string").alias("text"))

    def scan(batches):
        pairs = np.zeros(1 << 14, np.int64)
        for batch in batches:
            for part in steps(batch, "text"):
                counts: Counter = Counter()
                others = []
                for text, has_hex in _rows(part.column("text")):
                    base = base_spans(text, has_hex)
                    counts.update((kind, string) for kind, _, _, string in base)
                    others += [text[low:high] for low, high in candidates(text, base, ASSIGN_LEAST)]
                if others:
                    pairs += _pair_counts(others)
                yield rows_of(counts)
        used = np.flatnonzero(pairs).tolist()
        yield rows_of({("pair", chr(code >> 7) + chr(code & 127)): int(pairs[code]) for code in used})

    def rows_of(counts):
        return pa.RecordBatch.from_arrays(
            [
                pa.array([kind for kind, _ in counts], pa.string()),
                pa.array([string for _, string in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            ["kind", "string", "n"],
        )

    rows = source.mapInArrow(scan, "kind string, string string, n long")
    return rows.groupBy("kind", "string").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Formats:
    """Automata from at most ``sample`` labelled strings per kind; lengths and pair counts from all texts."""
    found = stage(_found(docs, text_col), "credentials")
    labelled = {}
    for kind in KINDS[:3]:
        rows = found.filter(F.col("kind") == kind).orderBy(F.xxhash64("string"), "string").limit(sample)
        labelled[kind] = [row.string for row in rows.select("string").collect()]
    # Symbols are 67 and the space, so pairs are 4,624 at most.
    pairs = {(row.string[0], row.string[1]): row.n for row in found.filter("kind = 'pair'").collect()}
    least = found.filter("kind <> 'pair'").agg(F.min(F.length("string"))).first()[0]
    return Formats(labelled, pairs, least or RUN_LEAST)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", formats: Formats | None = None) -> DataFrame:
    """(``doc_id``, ``spans``) of each row, spans sorted by start and then by kind."""
    formats = formats or fit(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(formats)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                spans = [
                    [{"kind": name, "start": low, "end": high} for name, low, high in shared.value.spans(*row)]
                    for row in _rows(part.column("text"))
                ]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return source.mapInArrow(scan, f"doc_id long, spans {SPANS}")


def covered(text: str, spans: list[tuple[str, int, int]], mask: str) -> str:
    """``text`` with every span, overlapping ones together, replaced by ``mask``."""
    out, at = [], 0
    for _, low, high in sorted(spans, key=lambda span: span[1]):
        if low >= at:
            out += [text[at:low], mask]
        at = max(at, high)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", formats: Formats | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the secrets of ``text_col`` masked."""
    formats = formats or fit(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(formats)

    def scan(batches):
        for batch in batches:
            for part in steps(batch, text_col):
                column = part.column(text_col)
                found = [(text, shared.value.spans(text, has_hex)) for text, has_hex in _rows(column)]
                texts = [covered(text, spans, mask) if spans else None for text, spans in found]
                masked = pa.array(texts, pa.string()).cast(column.type)
                place = part.schema.get_field_index(text_col)
                yield part.set_column(place, part.schema.field(place), pc.coalesce(masked, column))

    return docs.mapInArrow(scan, docs.schema)
