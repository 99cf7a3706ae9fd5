"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols. Two words one edit apart have reduced words that are
equal or one edit apart, so the full one-edit neighbourhood of every different reduced word
(deletions, replacements, insertions, and the word itself) is joined with the reduced vocabulary
and no pair is missed. Neighbours are 64-bit codes computed from sums of prefixes, so a word of n
letters costs n * SYMBOLS numbers however long it is; codes that collide only add candidates.

Classes of words behind two matching reduced words are never paired as a whole: two words one edit
apart share the first half of the shorter one or the rest of it at the other end, so members meet
on that half. What meets is verified on the original strings.

A word's form is its most frequent near word (ties: the first in code-point order) if that is
``RATIO`` times as frequent; following forms to the last gives the root. Frequencies rise at least
``RATIO`` times with each step, so pointer doubling ends after a few joins.

Defined cases: null and empty texts have no words; a null id is written as nothing in the typo
rule; repeated rows count each time; an empty table gives an empty table; a run of letters may
have any length; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.text import flat, mix, steps
from marginalia.storage import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = r"[A-Za-zÀ-ÿ]+"
TYPO = 199
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
# Symbols of the reduced alphabet. More symbols mean more neighbours, fewer mean more candidates.
SYMBOLS = 8
# Letters by falling frequency in Latin-script text, dealt to the symbols in turn.
FREQUENT = "etaoinsrhldcumfpgwybvkxjqz"
# An odd number whose powers weigh the places of a reduced word, and its inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
BACK = np.uint64(pow(BASE, -1, 1 << 64))
# Bytes of words whose neighbours one numpy step holds.
STEP_WORDS = 1 << 15


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least: int = LEAST_COUNT
) -> DataFrame:
    """(``word``, ``n``) of the words that are long and frequent enough, typos made by rule."""
    text = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(key.alias("id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.withColumn("draw", F.crc32(F.concat("id", F.lit(":"), "run")))
    cut = F.expr("concat(left(run, cast(draw % length(run) as int)), substring(run, cast(draw % length(run) as int) + 2))")
    words = runs.select(F.when(F.col("draw") % TYPO == 0, cut).otherwise(F.col("run")).alias("word"))
    words = words.filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def symbol_table(symbols: int) -> np.ndarray:
    """Symbol (from 1) of each code point below 256; others follow from the code point."""
    table = np.arange(256) % symbols
    for place, letter in enumerate(FREQUENT):
        table[ord(letter)] = place % symbols
    return (table + 1).astype(np.uint64)


def reduced(words: pa.Array, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words one after another, and word offsets in code points."""
    raw, offsets = flat(words)
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    table = symbol_table(symbols)
    wide = (points % symbols + 1).astype(np.uint64)
    return np.where(points < 256, table[np.minimum(points, 255)], wide), starts[offsets]


def _powers(base: int, n: int) -> np.ndarray:
    """The powers 0 to n - 1 of ``base``, modulo 2 ** 64."""
    table = np.full(n, base, np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


def _sums(symbols: np.ndarray, offsets: np.ndarray):
    """Per letter: its word, its place, and the sum of symbol * base ** place before it; per word
    the whole sum."""
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(symbols)) - offsets[owner]
    up = _powers(BASE, int(lengths.max(initial=0)) + 2)
    terms = symbols * up[place]
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    before = running[:-1] - running[offsets[owner]]
    return lengths, owner, place, before, running[offsets[1:]] - running[offsets[:-1]], up


def _code(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return mix(sums + mix(lengths.astype(np.uint64)))


def codes(symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One code per reduced word."""
    lengths, _, _, _, whole, _ = _sums(symbols, offsets)
    return _code(whole, lengths)


def neighbourhood(symbols: np.ndarray, offsets: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of every word's full one-edit neighbourhood and of itself, with the word's number.

    Equal codes of one word may repeat.
    """
    lengths, owner, place, before, whole, up = _sums(symbols, offsets)
    numbers = np.arange(len(lengths))
    own = symbols * up[place]
    rest = whole[owner] - before
    found = [(_code(whole, lengths), numbers), (_code(before + (rest - own) * BACK, lengths[owner] - 1), owner)]
    for symbol in range(1, alphabet + 1):
        letter = np.uint64(symbol)
        put = before + letter * up[place]
        other = symbols != letter
        found.append((_code((put + rest - own)[other], lengths[owner[other]]), owner[other]))
        # Before each letter, and behind the last one.
        found.append((_code(put + rest * np.uint64(BASE), lengths[owner] + 1), owner))
        found.append((_code(whole + letter * up[lengths], lengths + 1), numbers))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _coded(words: DataFrame, symbols: int) -> DataFrame:
    """``words`` with the ``code`` of their reduced word."""

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "word"):
                code = pa.array(codes(*reduced(part.column("word"), symbols)).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("word"), part.column("n"), code], ["word", "n", "code"])

    return words.select("word", "n").mapInArrow(scan, "word string, n long, code long")


def _reduced_pairs(classes: DataFrame, symbols: int) -> DataFrame:
    """(``code``, ``other``) of reduced words that are equal or one edit apart, code <= other."""

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "word", STEP_WORDS):
                near, owner = neighbourhood(*reduced(part.column("word"), symbols), symbols)
                code = part.column("code").to_numpy()[owner]
                # A pair is found from both sides; the lesser code keeps it.
                near = near.view(np.int64)
                kept = near >= code
                yield pa.RecordBatch.from_arrays([pa.array(code[kept]), pa.array(near[kept])], ["code", "other"])

    near = classes.select("code", "word").mapInArrow(scan, "code long, other long")
    present = classes.select(F.col("code").alias("other"))
    # Neighbours outnumber the vocabulary a hundred times: they are looked up, then made distinct.
    return near.join(present.hint("shuffle_hash"), "other").distinct()


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(``word``, ``other``, ``n``, ``other_n``): every unordered pair of words exactly one edit apart.

    ``words`` has different ``word`` values with their count ``n``.
    """
    vocabulary = stage(_coded(words, symbols).withColumn("size", F.length("word")), "reduced")
    classes = stage(vocabulary.groupBy("code", "size").agg(F.min("word").alias("word")), "classes")
    pairs = _reduced_pairs(classes, symbols)
    sizes = classes.select("code", "size")
    pairs = pairs.join(sizes, "code").join(sizes.toDF("other", "other_size"), "other").filter("abs(size - other_size) <= 1")
    pairs = stage(pairs.withColumn("head", F.explode(F.array(F.lit(True), F.lit(False)))), "pairs")
    half = "cast(least(size, other_size) div 2 as int)"
    share = F.expr(f"if(head, left(word, {half}), right(word, least(size, other_size) - {half}))").alias("half")
    key = ["code", "size", "other", "other_size", "head"]
    left = pairs.join(vocabulary, ["code", "size"]).select(*key, share, "word", "n")
    right = pairs.join(vocabulary.toDF("other_word", "other_n", "other", "other_size"), ["other", "other_size"])
    right = right.withColumnRenamed("other_word", "word").select(*key, share, F.col("word").alias("other_word"), "other_n")
    met = left.join(right, [*key, "half"])
    # Within one class a pair meets twice; a pair with an equal head is left to that side.
    once = (F.col("code") < F.col("other")) | (F.col("word") < F.col("other_word"))
    first = F.col("head") | F.expr(f"left(word, {half}) <> left(other_word, {half})")
    near = F.levenshtein("word", "other_word", 1) == 1
    return met.filter(once & first & near).select("word", F.col("other_word").alias("other"), "n", "other_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``) of every word that has a form, by doubling the followed steps."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(ahead, "root", "left")
        moved = stage(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")), "roots")
        now = moved.drop("more")
        if moved.filter("more").isEmpty():
            return now


def group_variants(words: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """(``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``) of each row of ``words``."""
    words = stage(words.select("word", "n"), "words")
    pairs = stage(near_pairs(words, symbols), "near")
    both = pairs.unionByName(pairs.selectExpr("other AS word", "word AS other", "other_n AS n", "n AS other_n"))
    # The largest count first, then the first word in code-point order, which is that of UTF-8.
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form"))).alias("best")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    known = words.join(near, "word", "left")
    kept = -F.col("best.rank") >= ratio * F.col("n")
    known = known.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(kept, F.col("best.form")).alias("form"),
        F.when(kept, -F.col("best.rank")).alias("form_n"),
    )
    known = stage(known, "forms")
    roots = _roots(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The spelling variants among all words of ``docs``; see ``word_counts`` and ``group_variants``."""
    return group_variants(word_counts(docs, id_col, text_col))
