"""A corpus pipeline over `documents`: each stage works on all that the one before has kept.

Documents without letters, or too short to tell their language, go; lines that many documents share go from all but one; of near copies
one stays; sources are brought to their target shares, some documents more than once; and what
is left is encoded. Stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadstrata.llm.bpe import bpe_report
from roadstrata.llm.lang_id import keep_identified
from roadstrata.llm.line_dedup import drop_repeated_lines
from roadstrata.llm.mixing import mix_documents
from roadstrata.llm.simhash import keep_one
from roadstrata.workspace import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null, without letters, or so short that no learned language is clearly likelier.

    Longer texts pass, also gibberish or a language that was not learned: languages are only compared with each other.
    """
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines out that at least three documents hold, but for one of them."""
    return drop_repeated_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of near copies."""
    return keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves documents out, or repeats them, until each source has its share of the words."""
    return mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of what they decode to, a row per row of the mix."""
    return bpe_report(docs, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: Three of the five stages have no form in SQL (a learned model, pivotal draws, BPE merges).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
