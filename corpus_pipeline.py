"""Corpus pipeline: the stages that turn ``documents`` into a training mix.

Each stage takes (spark, docs, sf_dir), works on all that the stage before
kept and returns a DataFrame; ``run`` writes each result as Parquet into the
shared folder (``spark.checkpoint.dir``) and reads it again for the next.
All but the last return the columns of ``documents``.  The last tells how often
the mix takes each document (``copies``, 0: not at all); ``training_corpus``
carries that out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenurekit.llm import decontam, mixing, near_dup, pii_weak, quality_rules
from tenurekit.llm.base import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_rules.apply_rules(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles) stays."""
    return near_dup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    return pii_weak.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them."""
    sized = docs.select("doc_id", "text", "source", mixing.word_count(docs["text"]).alias("size"))
    return mixing.repeated(mixing.take(sized))


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", deduplicate),
    ("benchmark_decontamination", decontaminate),
    ("personal_data", redact),
    ("mixing", mix),
]

#: the span classifier of the PII stage is trained by expectation-maximisation,
#: which SQL does not express; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
