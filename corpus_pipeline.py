"""The corpus pipeline: language ID, line dedup, near-dedup, packing. Each stage works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import langid, line_dedup, packing, simhash
from palimpsest.llm.common import read, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; those without a letter, or as close to a second language as to the best, go. Each row is judged on its own, whatever its id."""
    docs = docs.select(*COLUMNS)
    learned = langid.fit_dictionaries(docs, F.lit(True))
    return langid.identify(docs, learned, keep=COLUMNS[1:]).filter("NOT rejected").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that others repeat; n_chars is that of the text kept. Rows that repeat an id count as one document, each keeps its own lines."""
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS), keep=["lang", "source"])
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.char_length("kept").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id. Rows are told apart by id and text: one that repeats a copy's id with another text stays."""
    return simhash.deduplicate(docs.select(*COLUMNS), simhash.NEAR)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens. Rows that repeat an id are packed each on its own."""
    return packing.pack(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language ID", language), ("line dedup", lines), ("SimHash near-dedup", near_duplicates), ("packing", packed)]

#: Compression, SimHash and tokenisation have no SQL form; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result stored as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
