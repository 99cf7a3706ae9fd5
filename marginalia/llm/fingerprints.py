"""Document fingerprints: sets of content-defined chunk digests, weighted by chunk length.

A text is cut where the rolling hash of its last 16 bytes says so (see ``chunking``), so an edit
changes the chunks it touches and the text after it is cut as before. The fingerprint lists each
different chunk once, sorted: 16 hex digits of the chunk's XXH64 and 2 of its length less one.
The containment of a fingerprint in another is the share of its length whose chunks the other has.

Defined cases: null is an empty text; its fingerprint is empty, and contained wholly in an empty
and not at all in any other fingerprint; equal texts have equal fingerprints; documents of equal
id are ordered as they are read; null ids come last; a lone
document is its own next one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.chunking import Cuts, Sizes
from marginalia.llm.text import steps, strings

SIZES = Sizes(least=16, normal=40, most=128, hard=7, easy=4, window=16)

# Keys sampled for each range of documents; the driver holds as many and the ranges' bounds.
SAMPLES = 100

Chunks = list[tuple[str, int]]


def chunked(texts: list[bytes]) -> list[tuple[Chunks, list[int]]]:
    """Digest and length of the chunks of each text, in order, and where they end."""
    data = b"".join(texts)
    cuts = Cuts(np.frombuffer(data, np.uint8), SIZES)
    digest = xxhash.xxh64_hexdigest
    out, start = [], 0
    for text in texts:
        stop = start + len(text)
        ends = cuts.ends(start, stop)
        chunks, low = [], start
        for high in ends:
            chunks.append((digest(data[low:high]), high - low))
            low = high
        out.append((chunks, [end - start for end in ends]))
        start = stop
    return out


def written(chunks: dict[str, int]) -> str:
    return "".join(sorted([f"{digest}{length - 1:02x}" for digest, length in chunks.items()]))


def read(fingerprint: str) -> dict[str, int]:
    """Digests and lengths of a fingerprint."""
    parts = [fingerprint[at : at + 18] for at in range(0, len(fingerprint), 18)]
    return {part[:16]: int(part[16:], 16) + 1 for part in parts}


def containment(first: dict[str, int], second: dict[str, int]) -> float:
    """Share of the length of ``first`` whose chunks are in ``second``."""
    if not first:
        return float(not second)
    return sum(length for digest, length in first.items() if digest in second) / sum(first.values())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``fingerprint``) of each row."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                found = chunked([text.encode() for text in strings(part.column("text"))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([written(dict(chunks)) for chunks, _ in found], pa.string())],
                    ["doc_id", "fingerprint"],
                )

    return source.mapInArrow(scan, "doc_id long, fingerprint string")


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
RESULT_COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compared(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
    """Result rows of all texts but the last, each with the one after it."""
    data = [text.encode() for text in texts]
    found = chunked(data)
    tails, heads, digests = [], [], []
    for text, raw, after, (_, ends) in zip(texts, data, texts[1:], found, strict=False):
        change = len(text) // 3
        kept = len(raw) if not change else len(text[: len(text) - change].encode())
        patch = after[:change].encode()
        # Chunks that end before the edit stay; the rest is cut anew.
        same = bisect_left(ends, kept)
        start = ends[same - 1] if same else 0
        heads.append(same)
        tails.append(raw[start:kept] + patch)
        digests.append(hashlib.sha256(raw[:kept] + patch).hexdigest())
    edited = chunked(tails)
    sets = [dict(chunks) for chunks, _ in found]
    anew = [dict(chunks[:same] + tail) for (chunks, _), same, (tail, _) in zip(found, heads, edited, strict=False)]
    columns = [
        ids[:-1],
        [len(text) for text in texts[:-1]],
        digests,
        [written(chunks) for chunks in sets[:-1]],
        [written(chunks) for chunks in anew],
        [containment(one, two) for one, two in zip(sets, anew, strict=False)],
        [containment(one, two) for one, two in zip(sets, sets[1:], strict=False)],
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, RESULT, strict=True)], schema=RESULT
    )


def _ranges(keys: DataFrame, count: int):
    """The number of the range that a (``doc_id``, ``row``) falls in, in the order of documents.

    Bounds are quantiles of a sample of keys whose size follows from the number of ranges.
    """
    total = keys.count()
    taken = F.pmod(F.xxhash64("row", "doc_id"), F.lit(max(1, total // (SAMPLES * count)))) == 0
    sample = keys.filter(taken).toArrow()

    def ordered(ids, rows):
        return [(key is None, -(key or 0), row) for key, row in zip(ids, rows, strict=True)]

    sample = sorted(ordered(sample.column("doc_id").to_pylist(), sample.column("row").to_pylist()))
    bounds = [sample[len(sample) * number // count] for number in range(1, count)] if sample else []

    @F.pandas_udf("int")
    def number(ids: pd.Series, missing: pd.Series, rows: pd.Series) -> pd.Series:
        found = [None if gone else key for key, gone in zip(ids.tolist(), missing.tolist(), strict=True)]
        return pd.Series([bisect_right(bounds, key) for key in ordered(found, rows.tolist())], dtype="int32")

    return number(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), F.col("row"))


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how much of it the edited text and
    the next document hold.

    Documents stand in descending order of their id. The edited text has its last third of code
    points replaced by as many (or all) first ones of the next document, after the last one the
    first. Documents are dealt by ranges of this order, a range to a task, and each range gets a copy
    of the next one's first document. Texts are shuffled once. Ties are told apart by their place,
    so ``docs`` has to be a table that is read in the same order each time, such as files.
    """
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    keys = source.select("doc_id", "row")
    number = _ranges(keys, count)
    place = F.struct(F.col("doc_id").isNull().alias("missing"), F.bitwise_not("doc_id").alias("order"), "row")
    # One row for each range in use.
    heads = keys.withColumn("range", number).groupBy("range").agg(F.min(place).alias("first"))
    heads = heads.select("range", "first.row").orderBy("range").collect()
    before = [head.range for head in heads[-1:] + heads[:-1]]
    copies = spark.createDataFrame(
        [(head.row, last) for head, last in zip(heads, before, strict=True)], "row long, before int"
    )
    homes = F.filter(
        F.array(
            F.struct(F.col("range"), F.lit(False).alias("copy")),
            F.struct(F.col("before").alias("range"), F.lit(True).alias("copy")),
        ),
        lambda home: home.range.isNotNull(),
    )
    dealt = source.withColumn("range", number).join(F.broadcast(copies), "row", "left")
    dealt = dealt.select("doc_id", "text", "row", F.explode(homes).alias("home")).select("doc_id", "text", "row", "home.*")
    order = (F.col("copy"), F.col("doc_id").desc_nulls_last(), F.col("row"))
    dealt = dealt.repartitionById(count, "range").sortWithinPartitions(*order).select("doc_id", "text")

    def scan(batches) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[str] = []
        for batch in batches:
            for part in steps(batch, "text"):
                ids = ids[-1:] + part.column("doc_id").to_pylist()
                texts = texts[-1:] + strings(part.column("text"))
                yield compared(ids, texts)

    return dealt.mapInArrow(scan, RESULT_COLUMNS)
