"""The corpus pipeline: five stages, each on the documents its predecessor kept.

1. Quality rules: documents that fail the base rules or lose most of their words with the lines their
   host repeats are rejected.
2. Near duplicates: one document of each component of near copies stays.
3. Suffix array: bytes covered by a 100-byte string that starts earlier are cut out.
4. Mixing: sources are brought to their target weights; a document may come more than once.
5. Tokens: documents are encoded and decoded.

All but the last give the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweir.llm import bpe, line_quality, mixing, near_dup, suffix_dedup
from logweir.llm.common import reachable, stored, table, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.deduplicated(docs)


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, the ids (joined by a space) and the decoded text of every row."""
    return bpe.encode(docs, tokenizer_path(), ("lang", "source"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_bytes", repeated_bytes),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: SQL cannot cut repeated bytes or encode tokens; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared folder and read again."""
    reachable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
