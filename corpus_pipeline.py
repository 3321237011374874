"""From raw documents to packed sequences: stages over the tables of a folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import minhash_dedup, mixing, packing, quality_rules, suffix_dedup
from ledgerlight.llm.common import stored, table


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.quality_filter(docs, table(spark, sf_dir, "labels"))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash_dedup.keep_first(docs)


def _repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that an earlier document has."""
    rest = suffix_dedup.without_repeats(docs)
    return rest.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    rows = mixing.remixed(docs)
    return rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", _quality),
    ("near_duplicates", _near_duplicates),
    ("repeats", _repeats),
    ("mix", _mix),
    ("pack", _pack),
]

#: The stages fit cutoffs, draw and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each on the stored rows of the one before."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stage(spark, rows, sf_dir)
        if name != STAGES[-1][0]:
            rows = stored(rows)
    return rows
