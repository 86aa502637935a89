"""The corpus pipeline: documents in five stages, each a table that the next one reads.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame. All stages but the last return the columns of ``docs``; the last adds ``copies`` (how
often the mix takes the document) and ``target`` (its source's words).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripledger.llm import decontam, dedup, langid, mixing, simhash
from tripledger.llm.common import stage, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that can be told go."""
    return langid.drop_rejected(docs, stage(spark))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the largest doc_id stays."""
    return dedup.drop_copies(docs, stage(spark), largest=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that fingerprints of 4 words link, at up to 4 differing bits, the
    smallest doc_id stays. Empty texts link like any other."""
    return simhash.drop_near_copies(docs, stage(spark), width=4, radius=4)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage within a fifth of a benchmark item's words go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), stage(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 3, 1, 2 in turn and share 150 % of all words, at most two copies of each."""
    return mixing.mixed_documents(docs, stage(spark), weights=[3, 1, 2], share=1.5, cap=2.0)


STAGES = [("language_id", identify_language), ("exact_dedup", drop_exact_copies),
          ("simhash_near_dedup", drop_near_copies), ("benchmark_decontamination", drop_benchmark_passages),
          ("source_mix", mix_sources)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(spark).put(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
