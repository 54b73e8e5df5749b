"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns a table that is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``; the last returns the pieces of the remaining texts with their places in the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import langid, lines, ngram_join, packing, suffix_dedup
from millrace.llm.common import stored
from millrace.llm.queries import public_tokenizer, table

#: Texts whose languages are closer than this are rejected (but no exact ties), as are those without a letter.
MIN_MARGIN = 0.002


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language can't be told; the model learns from the rows that have one."""
    return langid.keep_identified(docs, langid.fit(docs), MIN_MARGIN)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 characters or more that five documents hold stay in the one with the largest id alone."""
    return lines.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at a similarity of 0.8, the one with the smallest id stays."""
    return ngram_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes or more that start at two places are cut from both."""
    return suffix_dedup.remove_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_common_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack_sequences),
]

#: Compression sizes and token ids can't be had in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
