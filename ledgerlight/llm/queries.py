"""The registered queries of the operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import (
    chat_format,
    class_lm,
    cover_tree,
    fill_middle,
    html_text,
    minhash_dedup,
    mixing,
    packing,
    quality_rules,
    secret_ledger,
    suffix_dedup,
    token_counts,
    vantage_kmeans,
)
from ledgerlight.llm.common import table
from ledgerlight.session import shared_dir


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix-array dedup over all documents."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").cast("bigint").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of all pages."""
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts.counted(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-based n-gram scores of all documents."""
    return class_lm.scored(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents to the weights of their sources."""
    return mixing.taken(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations from the perspective of each participant."""
    return chat_format.perspectives(table(spark, sf_dir, "conversations"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash near-duplicates over all documents."""
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding near-duplicates over all vectors."""
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum-of-squares packing of all documents."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk-controlled quality rules over all documents."""
    rows = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return rows.select(*base, *[f"max_{rule}" for rule in quality_rules.RULES])


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle forms of all documents, and the texts told back from them."""
    rows = fill_middle.fill_middle(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


def op12_vantage_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all vectors after ten rounds."""
    return vantage_kmeans.clustered(table(spark, sf_dir, "embeddings"))


def op13_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, by a ledger that begins empty."""
    rows = secret_ledger.scan_history(table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/ledger-{uuid4().hex}")
    kinds = [rule.kind for rule in secret_ledger.BASE]
    base = F.filter("findings", lambda x: x["kind"].isin(kinds))

    def number(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return rows.select(
        F.col("row.doc_id").alias("doc_id"),
        *map(number, kinds),
        F.sha2(secret_ledger.as_text(base), 256).alias("base_sha256"),
        secret_ledger.as_text(F.col("findings")).alias("spans"),
    )


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op")}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
