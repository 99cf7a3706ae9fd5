"""Language-model scores from token counts and a probabilistic suffix tree over their bytes.

A-Z are lower-cased, words are runs of bytes other than white space, and a text is its words, each
followed by a space, and an end symbol. The tree predicts each byte from the bytes before it,
back to the start of the text. Contexts of up to ``DEPTH`` bytes are counted over all training
texts; those with at least ``SHARE`` of all symbols are candidates, so there are ``1 / SHARE`` per
depth at most. A candidate is retained if its next-symbol distribution differs from that of its
suffix (count times Kullback-Leibler divergence over ``DIVERGENCE``) or if a longer retained one
ends in it. Distributions are discounted and interpolated with those of the suffix, down to all
256 bytes. A byte is scored in the state of the longest retained suffix of what precedes it, and
the bytes of a token give its spelling a probability p. Tokens are whole symbols too: c of N
training tokens, with ``DISCOUNT`` d taken from each of the V different ones. The tree has the
weight ``t + (1 - t) d V / N`` for a given ``tree_share`` t, so that a known token has the probability
``(1 - t) max(c - d, 0) / N + (t + (1 - t) d V / N) p``. With t = 0 only what is discounted is left
to the tree, little in a large corpus; with ``TREE`` the tree's view of a token in its context weighs
as much as its count. All unknown tokens are one symbol, as in the base score, with the rest: the
spellings that are not known tokens. Their share of all spellings is at least that of new tokens in
text, estimated by N1 / N (N1: tokens seen once), which is what they get of the tree's weight. So the
probabilities of all symbols add up to one at most.

The base score adds one to token counts. Tokens with ``FREQUENT`` of all occurrences or more
(``1 / FREQUENT`` at most) go to the tasks with their counts; the others are joined by a shuffle.
Gram and token counts are summed in the map tasks before they are shuffled.

Defined cases: null is an empty text, which is its end only; a null id counts as an empty text
for the fold and is kept; equal rows are scored and counted each; without training texts scores
are those of the uniform distribution and counts are zero; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.text import steps, strings
from marginalia.storage import stage

DEPTH, SHARE, DIVERGENCE, DISCOUNT = 5, 1 / 32000, 20.0, 0.75
# The tree's share of a token's probability beyond what counts are discounted by.
TREE = 0.5
FREQUENT = 1e-6
# Text bytes that one step of counting and scoring works on, which memory goes with, and different
# tokens (and four times as many grams) that a task holds before it sends them on.
COUNT_BYTES, SCORE_BYTES, COUNTER_WORDS = 1 << 20, 1 << 19, 100_000
END = "\n"
_PAD = b"\n" * DEPTH


def words(text: str) -> list[bytes]:
    return text.encode().lower().split()


def symbols(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each after ``DEPTH`` end symbols, and where each text begins."""
    data = [_PAD + b"".join([word + b" " for word in text]) + b"\n" for text in texts]
    sizes = np.array([len(text) for text in data], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return np.frombuffer(b"".join(data), np.uint8), starts


def grams(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different (context, next) byte strings, packed with the next byte lowest, and their counts."""
    packed = np.zeros(max(len(raw) - DEPTH, 0), np.uint64)
    for place in range(DEPTH + 1):
        packed |= raw[place : len(raw) - DEPTH + place].astype(np.uint64) << np.uint64(8 * (DEPTH - place))
    real = np.ones(len(packed), bool)
    # The next byte of a gram that starts in the last bytes of a text is padding.
    for text_start in range(DEPTH):
        ends = starts[1:-1] - DEPTH + text_start
        real[ends[ends < len(real)]] = False
    return np.unique(packed[real], return_counts=True)


@dataclass
class Tree:
    """States as tables: ``child[state, class]`` for an older byte (-1: none), and natural log
    probabilities ``log_p[state, class]``; ``classes`` maps bytes to columns."""

    classes: np.ndarray
    child: np.ndarray
    log_p: np.ndarray

    def states(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and state of every byte; the state is the longest retained suffix before it."""
        width = self.child.shape[1]
        kinds = self.classes.astype(np.int32).take(raw)
        child = self.child.ravel()
        state = np.zeros(len(raw), np.int32)
        active, here = np.arange(len(raw), dtype=np.int32), state
        for back in range(1, DEPTH + 1):
            if len(active) and active[0] < back:
                inside = active >= back
                active, here = active[inside], here[inside]
            here = child.take(here * width + kinds.take(active - back))
            found = np.flatnonzero(here >= 0)
            active, here = active.take(found), here.take(found)
            state[active] = here
        return kinds, state

    def spelled(self, texts: list[list[bytes]]) -> np.ndarray:
        """log10 probability of each token's bytes, tokens (with ends) of all texts in order."""
        raw, starts = symbols(texts)
        kinds, state = self.states(raw)
        value = self.log_p.ravel().take(state * self.log_p.shape[1] + kinds).astype(np.float64)
        for place in range(DEPTH):
            value[starts[:-1] + place] = 0
        sizes = [size for text in texts for size in (*(len(word) + 1 for word in text), 1)]
        sizes = np.array(sizes, np.int64)
        sizes[np.cumsum([len(text) + 1 for text in texts]) - [len(text) + 1 for text in texts]] += DEPTH
        return np.add.reduceat(value, np.cumsum(sizes) - sizes) / math.log(10)


def build(levels: list[dict[int, dict[int, int]]], divergence: float = DIVERGENCE, discount: float = DISCOUNT) -> Tree:
    """The tree of ``levels[d]``: counts of next bytes by packed context of ``d`` bytes."""
    seen = sorted({byte for counts in levels[0].values() for byte in counts})
    # Bytes never seen share the last column; each has its probability.
    classes = np.full(256, len(seen), np.int64)
    classes[seen] = np.arange(len(seen))
    width = len(seen) + 1
    unseen = 256 - len(seen)
    root = np.zeros(width)
    for byte, count in levels[0].get(0, {}).items():
        root[classes[byte]] = count
    share = np.append(np.ones(len(seen)), unseen)
    rows = {(0, 0): (root + 0.5 * np.minimum(share, 1)) / (root.sum() + 128)}
    kept = {(0, 0)}
    for depth in range(1, len(levels)):
        mask = (1 << 8 * (depth - 1)) - 1
        for context, counts in levels[depth].items():
            above = rows.get((depth - 1, context & mask))
            if above is None:
                continue
            count = np.zeros(width)
            for byte, times in counts.items():
                count[classes[byte]] = times
            total, kinds = count.sum(), np.count_nonzero(count)
            row = (np.maximum(count - discount, 0) + discount * kinds * above) / total
            rows[depth, context] = row
            if total * float((row * share * np.log(row / above)).sum()) > divergence:
                while (depth, context) not in kept:
                    kept.add((depth, context))
                    context, depth = context & ((1 << 8 * (depth - 1)) - 1), depth - 1
                depth = (mask.bit_length() // 8) + 1
    order = sorted(kept)
    number = {key: place for place, key in enumerate(order)}
    child = np.full((len(order), width), -1, np.int32)
    for depth, context in order[1:]:
        oldest = context >> 8 * (depth - 1)
        above = (depth - 1, context & ((1 << 8 * (depth - 1)) - 1))
        child[number[above], classes[oldest]] = number[depth, context]
    return Tree(classes, child, np.log(np.stack([rows[key] for key in order])).astype(np.float32))


def count_batch(word_counts: dict, train_counts: dict, found: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    names = list(word_counts)
    codes, times = found
    blank = len(codes)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*names, *[None] * blank], pa.binary()).cast(pa.string()),
            pa.concat_arrays([pa.nulls(len(names), pa.int64()), pa.array(codes.view(np.int64))]),
            pa.concat_arrays([pa.array([train_counts.get(name, 0) for name in names], pa.int64()), pa.array(times)]),
            pa.concat_arrays([pa.array(list(word_counts.values()), pa.int64()), pa.array(times)]),
        ],
        ["word", "gram", "n_train", "n"],
    )


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the tokens and grams of (``text``, ``training``), in parts of bounded size."""
    nothing = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    every: Counter = Counter()
    train: Counter = Counter()
    held = [nothing]
    for given in batches:
        for part in steps(given, "text", COUNT_BYTES):
            texts = [words(text) for text in strings(part.column("text"))]
            taken = part.column("training").to_pylist()
            for text, training in zip(texts, taken, strict=True):
                every.update(text)
                every[b"\n"] += 1
                if training:
                    train.update(text)
                    train[b"\n"] += 1
            chosen = [text for text, training in zip(texts, taken, strict=True) if training]
            if chosen:
                held.append(grams(*symbols(chosen)))
            if len(every) > COUNTER_WORDS or sum(len(codes) for codes, _ in held) > 4 * COUNTER_WORDS:
                yield count_batch(every, train, merged(held))
                every, train, held = Counter(), Counter(), [nothing]
    yield count_batch(every, train, merged(held))


def _counted(source: DataFrame) -> DataFrame:
    """(``word``, ``gram``, ``n_train``, ``n``): counts of tokens (all texts) and grams (training)."""
    rows = source.mapInArrow(count_batches, "word string, gram long, n_train long, n long")
    return rows.groupBy("word", "gram").agg(F.sum("n_train").alias("n_train"), F.sum("n").alias("n"))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts over several (sorted codes, counts)."""
    codes, back = np.unique(np.concatenate([codes for codes, _ in parts]), return_inverse=True)
    total = np.bincount(back, np.concatenate([times for _, times in parts]), len(codes))
    return codes, total.astype(np.int64)


def fit_tree(gram_counts: DataFrame, share: float = SHARE) -> Tree:
    """The tree of (``gram``, ``n``); only contexts of a bounded number reach the driver."""
    total = gram_counts.agg(F.sum("n")).first()[0] or 0
    levels: list[dict[int, dict[int, int]]] = [{} for _ in range(DEPTH + 1)]
    current = gram_counts
    for depth in range(DEPTH, -1, -1):
        if depth < DEPTH:
            mask = (1 << 8 * (depth + 1)) - 1
            current = current.groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.sum("n").alias("n"))
            current = stage(current, f"grams-{depth}")
        pairs = F.struct((F.col("gram").bitwiseAND(F.lit(255))).cast("int").alias("byte"), "n")
        contexts = current.groupBy(F.shiftright("gram", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.collect_list(pairs).alias("next")
        )
        bar = share * total if depth else 0
        for row in contexts.filter(F.col("total") >= bar).select("context", "next").toLocalIterator():
            levels[depth][row.context] = {pair.byte: pair.n for pair in row.next}
    return build(levels)


def score(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: float = FREQUENT,
    tree_share: float = 0.0,
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``, learning from the rows for which ``training`` holds."""
    spark = docs.sparkSession
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        training.alias("training"),
    )
    counts = stage(_counted(source), "counts")
    tokens = counts.filter("word IS NOT NULL").select("word", F.col("n_train").alias("c"), "n")
    sums = tokens.agg(F.sum("c"), F.sum("n"), F.sum(F.when(F.col("c") > 0, 1)), F.sum(F.when(F.col("c") == 1, 1))).first()
    train_tokens, all_tokens, kinds, once = (value or 0 for value in sums)
    tree = fit_tree(counts.filter("gram IS NOT NULL").select("gram", "n"))
    # At most 1 / frequent tokens.
    common = tokens.filter(F.col("n") >= frequent * all_tokens).select("word", "c").toArrow()
    table = {word.encode(): place for place, word in enumerate(common.column("word").to_pylist())}
    shared = spark.sparkContext.broadcast((tree, table, np.append(common.column("c").to_numpy(), 0)))
    # The tree's weight, and what a count is divided by; without counts spelling is all.
    spare = tree_share + (1 - tree_share) * DISCOUNT * kinds / train_tokens if train_tokens else 1.0
    whole = max(train_tokens, 1) / (1 - tree_share)
    unknown = spare * max(once, 1) / max(train_tokens, 1)

    def scan(batches):
        tree, table, c = shared.value
        log_c, known = np.log10(c + 1.0), (c > 0).astype(np.int64)
        counted = np.maximum(c - DISCOUNT, 0) / whole
        other = len(c) - 1
        for batch in batches:
            for part in steps(batch, "text", SCORE_BYTES):
                texts = [words(text) for text in strings(part.column("text"))]
                tokens = [token for text in texts for token in (*text, b"\n")]
                place = np.array([table.get(token, other) for token in tokens], np.int64)
                spelled = tree.spelled(texts)
                unseen = unknown if train_tokens else 10.0**spelled
                value = np.log10(np.where(c[place] > 0, counted[place] + spare * 10.0**spelled, unseen))
                sizes = np.array([len(text) + 1 for text in texts], np.int64)
                starts = np.cumsum(sizes) - sizes
                open_ = np.flatnonzero(place == other)
                value[open_] = 0
                owners = np.searchsorted(starts, open_, side="right") - 1
                bounds = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(texts)))])
                rare = pa.StructArray.from_arrays(
                    [pa.array([tokens[at].decode() for at in open_.tolist()], pa.string()), pa.array(spelled[open_].astype(np.float32))],
                    ["word", "spelled"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("training"),
                        pa.array(sizes),
                        pa.array(np.add.reduceat(known[place], starts)),
                        pa.array(np.add.reduceat(np.where(place == other, 0.0, log_c[place]), starts)),
                        pa.array(np.add.reduceat(value, starts)),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rare),
                    ],
                    ["doc_id", "training", "n_tokens", "known", "logs", "score", "rare"],
                )

    columns = (
        "doc_id long, training boolean, n_tokens long, known long, logs double, score double, "
        "rare array<struct<word: string, spelled: float>>"
    )
    scored = source.mapInArrow(scan, columns).withColumn("row", F.monotonically_increasing_id())
    scored = stage(scored, "scored")
    rest = scored.select("row", F.explode("rare").alias("rare")).select("row", "rare.word", "rare.spelled")
    rest = rest.join(tokens.select("word", "c"), "word")
    spelling = F.pow(F.lit(10.0), F.col("spelled"))
    likely = F.when(F.col("c") > 0, (F.col("c") - DISCOUNT) / whole + spare * spelling)
    likely = likely.otherwise(F.lit(unknown) if train_tokens else spelling)
    rest = rest.groupBy("row").agg(
        F.sum(F.log10(F.col("c") + 1)).alias("rare_logs"),
        F.sum(F.when(F.col("c") > 0, 1)).alias("rare_known"),
        F.sum(F.log10(likely)).alias("rare_score"),
    )
    zero = F.lit(0)
    logs = F.col("logs") + F.coalesce("rare_logs", zero)
    return scored.join(rest, "row", "left").select(
        "doc_id",
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", zero)).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(train_tokens + kinds + 1)).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", zero)).alias("score"),
    )
