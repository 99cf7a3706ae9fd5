"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme values.

Tokens are lower-cased runs of ASCII letters or digits and bytes beyond ASCII, hashed to
``2 ** TABLE_BITS`` cells, and so are their first ``PREFIXES`` bytes, in tables of their own. A
cell's score is its log-odds in toxic against clean texts under a Dirichlet prior: short prefixes
shrink to the overall share of toxic tokens, longer ones to shorter ones, tokens to the longest.
Scores under ``LIFT``, or that a G-test cannot tell from the overall share, become ``-STEP``.
Ruzzo and Tompa's scan finds all maximal segments of a text in linear time.

Scores of chance segments follow an extreme-value law, P(S >= s) ~ 1 - exp(-K m e^(-lambda s)) for
m tokens. lambda and K are fitted on clean texts; segments are kept above their text's location
ln(K m), and a logistic curve of the sum and the maximum of these heights is fitted to the labels.
Each half of the labelled texts is calibrated with log-odds of the other half.

The fit reads at most ``SAMPLE`` labelled texts, those with the least hash of their id, and of
equal ones the one with the least id, so that copies are no evidence; every text is scored whole, where it lies. The tables have a fixed size, so what tasks receive does not grow.

Defined cases: null and empty texts have no segment and get the score of such texts; a text
labelled twice is toxic if one label says so; labels without text and null labels do not count; without
toxic or without clean labels all scores are 0; equal rows give equal rows; null ids are kept and
never labelled; other columns are ignored by ``score`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.decontaminate import WORD_BYTE
from marginalia.llm.text import flat, mix, steps, word_hashes

TABLE_BITS = 18
CELLS = 1 << TABLE_BITS
SAMPLE = 100_000
THRESHOLD = 0.7
PREFIXES = (4, 6)
PRIOR = 4.0
# Least root of the G statistic and least log-odds that count, and the cost of other tokens.
CERTAIN, LIFT, STEP = 4.0, 2.0, 0.05


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells, one per table (prefixes from short to long, then the token), and row of each token."""
    raw, offsets = flat(pc.utf8_lower(pc.fill_null(column, "")))
    hashes, rows, first = word_hashes(raw, offsets, WORD_BYTE)
    padded = np.concatenate([raw, np.full(max(PREFIXES), 32, np.uint8)])
    head, open_ = np.zeros(len(first), np.uint64), np.ones(len(first), bool)
    shift, cells = np.uint64(64 - TABLE_BITS), []
    for place in range(max(PREFIXES)):
        byte = padded[first + place]
        open_ &= WORD_BYTE[byte] & (first + place < offsets[rows + 1])
        head = head * np.uint64(256) + np.where(open_, byte, 0).astype(np.uint64)
        if place + 1 in PREFIXES:
            cells.append(mix(head + np.uint64(1)) >> shift)
    return np.stack([*cells, hashes >> shift]).astype(np.int64), rows


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), by the linear scan of Ruzzo and Tompa.

    Only positive scores can open a segment, so the sums between them are taken at once.
    """
    totals = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float]] = []
    for place in np.flatnonzero(scores > 0).tolist():
        start, end, low, high = place, place + 1, float(totals[place]), float(totals[place + 1])
        while True:
            before = len(found) - 1
            while before >= 0 and found[before][2] >= low:
                before -= 1
            if before < 0 or found[before][3] >= high:
                found.append((start, end, low, high))
                break
            start, low = found[before][0], found[before][2]
            del found[before:]
    return [(start, end, high - low) for start, end, low, high in found]


def certain(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Where a G-test tells the counts from the overall share of toxic tokens."""
    both = np.maximum(toxic + clean, 1)
    left = toxic * np.log(np.maximum(toxic, 1e-9) / (both * share))
    right = clean * np.log(np.maximum(clean, 1e-9) / (both * (1 - share)))
    return 2 * (left + right) >= CERTAIN**2


@dataclass
class Model:
    """Tables and curves; everything a task needs to score a text.

    ``counts`` is (tables, cells, 2 classes); a model without counts scores 0.
    """

    counts: np.ndarray | None = None
    share: float = 0.0
    scale: float = 1.0
    location: float = 0.0
    curve: np.ndarray = field(default_factory=lambda: np.zeros(3))

    @staticmethod
    def of(counts: np.ndarray) -> Model:
        share = float(counts[-1][:, 1].sum() / counts[-1].sum())
        return Model(counts.astype(np.float32), share)

    def weights(self, cells: np.ndarray) -> np.ndarray:
        """The score of each token, from its cells in all tables."""
        middle, known = self.share, np.zeros(cells.shape[1], bool)
        for table, places in zip(self.counts, cells, strict=True):
            clean, toxic = table[places, 0].astype(np.float64), table[places, 1].astype(np.float64)
            known |= certain(toxic, clean, self.share)
            middle = (toxic + PRIOR * middle) / (toxic + clean + PRIOR)
        score = np.log(middle / (1 - middle)) - math.log(self.share / (1 - self.share))
        return np.where(known & (score >= LIFT), score, -STEP)

    def heights(self, column: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int, float]]], np.ndarray]:
        """Token counts, segments and (sum, maximum) of the heights over the location, per row."""
        cells, rows = tokens(column)
        scores = self.weights(cells)
        sizes = np.bincount(rows, minlength=len(column))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        found, out = [], np.zeros((len(column), 2))
        positive = np.bincount(rows[scores > 0], minlength=len(column))
        for row in range(len(column)):
            parts = segments(scores[bounds[row] : bounds[row + 1]]) if positive[row] else []
            found.append(parts)
            if parts:
                level = self.location + math.log(sizes[row])
                over = [max(0.0, self.scale * score - level) for _, _, score in parts]
                out[row] = sum(over), max(over)
        return sizes, found, out

    def probabilities(self, column: pa.Array) -> np.ndarray:
        if self.counts is None:
            return np.zeros(len(column))
        return curve_value(self.curve, self.heights(column)[2])


def curve_value(curve: np.ndarray, heights: np.ndarray) -> np.ndarray:
    inputs = np.column_stack([np.ones(len(heights)), np.log1p(heights)])
    return 1 / (1 + np.exp(-np.clip(inputs @ curve, -30, 30)))


def fit_scale(scores: np.ndarray, times: np.ndarray) -> float:
    """lambda: the positive root of E[exp(lambda s)] = 1 for scores of clean tokens."""
    if not (scores[times > 0] > 0).any():
        return 1.0
    share = times / times.sum()
    low, high = 1e-3, 8.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if share @ np.exp(middle * scores) < 1 else (low, middle)
    return max(0.05, high)


def fit_curve(heights: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a weak ridge."""
    inputs = np.column_stack([np.ones(len(heights)), np.log1p(heights)])
    curve = np.zeros(3)
    ridge = np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(inputs @ curve, -30, 30)))
        slope = inputs.T @ (labels - p) - ridge @ curve
        bend = (inputs * (p * (1 - p))[:, None]).T @ inputs + ridge + 1e-9 * np.eye(3)
        step = np.linalg.solve(bend, slope)
        curve = curve + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return curve


def remainder(column: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> Model:
    """A model of ``labels`` (``doc_id``, ``toxic``); every label given may be used."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # At most ``sample`` narrow rows are broadcast, and as many come back.
    texts = source.select("doc_id", F.xxhash64("text").alias("copy")).join(F.broadcast(known), "doc_id")
    texts = texts.groupBy("copy").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    known = texts.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).toArrow()
    ids, toxic = known.column("doc_id").to_numpy(), known.column("toxic").to_numpy() > 0
    if not toxic.any() or toxic.all():
        return Model()
    order = np.argsort(ids)
    shared = docs.sparkSession.sparkContext.broadcast((ids[order], toxic[order]))

    def labelled(part):
        """The labelled rows of a slice, their labels and halves."""
        ids, toxic = shared.value
        here = pc.fill_null(part.column("doc_id"), ids[0] - 1 if ids[0] > -(2**63) else ids[-1] + 1).to_numpy()
        place = np.minimum(np.searchsorted(ids, here), len(ids) - 1)
        known = ids[place] == here
        half = (mix(here[known].view(np.uint64)) >> np.uint64(63)).astype(np.int64)
        return part.column("text").filter(pa.array(known)), toxic[place[known]].astype(np.int64), half

    tables = len(PREFIXES) + 1

    def count(batches):
        total = np.zeros(tables * CELLS * 4, np.int64)
        for batch in batches:
            for part in steps(batch, "text"):
                texts, toxic, half = labelled(part)
                if not len(texts):
                    continue
                cells, rows = tokens(texts)
                kind = 2 * half[rows] + toxic[rows]
                for number, places in enumerate(cells):
                    here = slice(number * CELLS * 4, (number + 1) * CELLS * 4)
                    total[here] += np.bincount(4 * places + kind, minlength=CELLS * 4)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    # The result has a row per cell of tables of fixed size.
    cells = source.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(tables * CELLS * 4)
    counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    counts = counts.reshape(tables, CELLS, 2, 2)
    whole = counts.sum(2)
    if not (whole[-1].sum(0) > 0).all():
        return Model()
    # A half without one of the classes has no log-odds of its own.
    halves = [other if (other[-1].sum(0) > 0).all() else whole for other in (counts[:, :, 1], counts[:, :, 0])]
    halves = [Model.of(half) for half in halves]
    pair = docs.sparkSession.sparkContext.broadcast(halves)

    def chance(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                texts, toxic, half = labelled(part)
                columns: dict[str, list] = {"toxic": [], "size": [], "segments": [], "scores": []}
                for number, model in enumerate(pair.value):
                    chosen = half == number
                    own = texts.filter(pa.array(chosen))
                    sizes, found, _ = model.heights(own)
                    columns["toxic"] += toxic[chosen].tolist()
                    columns["size"] += sizes.tolist()
                    columns["segments"] += [[score for _, _, score in parts] for parts in found]
                    cells, rows = tokens(own)
                    scores = np.round(model.weights(cells), 1)
                    hit = scores > 0
                    columns["scores"] += [scores[hit & (rows == row)].tolist() if found[row] else [] for row in range(len(own))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns["toxic"], pa.int32()),
                        pa.array(columns["size"], pa.int64()),
                        pa.array(columns["segments"], pa.list_(pa.float64())),
                        pa.array(columns["scores"], pa.list_(pa.float64())),
                    ],
                    ["toxic", "size", "segments", "scores"],
                )

    # One narrow row for each labelled text.
    rows = source.mapInArrow(chance, "toxic int, size long, segments array<double>, scores array<double>").toArrow()
    toxic = rows.column("toxic").to_numpy()
    size = np.maximum(rows.column("size").to_numpy(), 1)
    segments_of = rows.column("segments").to_pylist()
    positive = np.array([v for label, values in zip(toxic, rows.column("scores").to_pylist(), strict=True) if not label for v in values])
    plain = max(int(size[toxic == 0].sum()), 1)
    values, times = np.unique(np.append(positive, -STEP), return_counts=True)
    times = np.where(values < 0, plain - len(positive), times)
    model = Model.of(whole)
    model.scale = fit_scale(values, times)
    heights = [[model.scale * value for value in values] for values in segments_of]
    clean = sum(value >= 1 for label, values in zip(toxic, heights, strict=True) if not label for value in values)
    model.location = math.log(max(clean, 1) * math.e / plain)
    over = np.zeros((len(toxic), 2))
    for row, values in enumerate(heights):
        if values:
            above = [max(0.0, value - model.location - math.log(size[row])) for value in values]
            over[row] = sum(above), max(above)
    model.curve = fit_curve(over, toxic.astype(float))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``score``) of each row, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                values = shared.value.probabilities(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values)], ["doc_id", "score"])

    return source.mapInArrow(scan, "doc_id long, score double")


def passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``start``, ``end``, ``p_value``): the segments above chance, in tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(batches):
        model = shared.value
        for batch in batches:
            for part in steps(batch, "text"):
                out = []
                sizes, found, _ = model.heights(part.column("text")) if model.counts is not None else ([], [], None)
                for doc_id, size, parts in zip(part.column("doc_id").to_pylist(), sizes, found, strict=False):
                    for start, end, value in parts:
                        chance = -math.expm1(-math.exp(min(50.0, model.location + math.log(size) - model.scale * value)))
                        if chance < 0.5:
                            out.append((doc_id, start, end, chance))
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64())
                columns = list(zip(*out, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(values), kind) for values, kind in zip(columns, kinds, strict=True)],
                    ["doc_id", "start", "end", "p_value"],
                )

    return source.mapInArrow(scan, "doc_id long, start int, end int, p_value double")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        for batch in batches:
            for part in steps(batch, text_col):
                keep = shared.value.probabilities(part.column(text_col).cast(pa.string())) < threshold
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(scan, docs.schema)
