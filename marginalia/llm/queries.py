"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import alignment, bpe, chat, credentials, decontaminate, fingerprints, pages, sharding, simhash, spelling, suffix_tree, toxicity, warc
from marginalia.storage import new_path, stage

# The tokenizer files of op7 and op12, installed on every machine.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
# The first one's merges as ranks, and its pattern of pieces.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

SHARDS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprints.with_neighbours(table(spark, sf_dir, "documents"))


def page_columns(records: DataFrame) -> DataFrame:
    """Per page: payload bytes and digest, record type and, of revisits, the response's page.

    A revisit's payload is that of the response it refers to.
    """
    bytes_, digest = F.octet_length("payload").cast("long"), F.sha2("payload", 256)
    read = records.select("record", "type", "page_id", "refers_to", bytes_.alias("bytes"), digest.alias("sha256"))
    read = stage(read, "records")
    responses = read.filter("type = 'response'").select(
        F.col("record").alias("refers_to"),
        F.col("page_id").alias("origin"),
        F.col("bytes").alias("origin_bytes"),
        F.col("sha256").alias("origin_sha256"),
    )
    return read.join(responses, "refers_to", "left").select(
        "page_id",
        F.coalesce("bytes", "origin_bytes").alias("payload_bytes"),
        F.coalesce("sha256", "origin_sha256").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("origin").alias("refers_to"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to WARC archives and read back."""
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return page_columns(warc.read_archives(spark, path))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, shards of near equal bytes, tokens and rows."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Fitted on the labels whose remainder of the id is not 1."""
    return toxicity.fit(docs, labels.filter(toxicity.remainder("doc_id", 3) != 1))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (toxicity.remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every document."""
    docs = table(spark, sf_dir, "documents")
    return suffix_tree.score(docs, toxicity.remainder("doc_id", 7) != 2, tree_share=suffix_tree.TREE)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds at least 80 % of a benchmark item's shingles, with the item."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted windows."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.range(2).selectExpr(
        "-7L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role", f"'{text}' AS text"
    )
    return chat.digests(chat.format_windows(given.unionByName(more), path=VOCABULARY, ranks=RANKS))


def secret_columns(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, their digest and all spans, from the operator's spans."""

    def of(kind):
        return F.filter("spans", lambda span: span.kind == kind)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(listed(F.filter("spans", lambda span: span.kind != "format")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base kinds and all spans of every document."""
    return secret_columns(credentials.find(table(spark, sf_dir, "documents")))


def op11_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of both tokenizers on every document, with counts over all documents."""
    return alignment.compare(table(spark, sf_dir, "documents"), VOCABULARY, PIECES, ranks=RANKS)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of the corpus with its near words, form and root."""
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_fingerprints,
        op2_warc,
        op3_sharding,
        op4_toxicity,
        op5_language_model,
        op6_decontaminate,
        op7_bpe,
        op8_simhash,
        op9_chat,
        op10_secrets,
        op11_html,
        op12_alignment,
        op13_spelling,
    )
}
