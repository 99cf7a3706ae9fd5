"""The corpus pipeline: each stage works on all documents its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns the documents with its decisions applied; the last
returns their tokens. Each stage's result is to be written and read again as the next one's input.

Defined cases: null, empty and blank texts are documents without words, which are near-duplicates of
each other and keep the row of the least id, null ids last; equal rows are copies; texts of any
length pass whole; columns beyond those of documents are kept, whatever their names, up to the last
stage; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marginalia.llm import bpe, credentials, decontaminate, jaccard, toxicity
from marginalia.llm.queries import VOCABULARY, table, toxicity_model
from marginalia.storage import stage as written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score reaches the threshold."""
    return toxicity.drop_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of each group of near-duplicates: texts linked by a
    Jaccard similarity of 0.8 or more of their five-word shingles. SimHash finds the near ones, as in
    ``op8``; the whole sets confirm them, and rare shingles find the links it misses."""
    return jaccard.deduplicate(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; ``n_chars`` follows the text."""
    return credentials.redact(docs).selectExpr(
        *("CAST(length(text) AS LONG) AS n_chars" if name == "n_chars" else name for name in docs.columns)
    )


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    return bpe.digests(docs, VOCABULARY, keep_ids=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("secrets", secret_stage),
    ("tokens", token_stage),
]

# Segments, similarity links, sketches, automata and merges have no SQL form; the tests hold
# run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
