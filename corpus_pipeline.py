"""A corpus in five stages: quality, near duplicates, personal data, mix, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrasift.llm.bpe import encode_documents
from terrasift.llm.common import saved, table
from terrasift.llm.mixing import mixed_documents
from terrasift.llm.ngram_join import one_of_each_group
from terrasift.llm.pii import sanitised
from terrasift.llm.quality_classifier import accepted_documents
from terrasift.session import ship_code

# Near duplicates share 80 % of their five-word shingles.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality, by a classifier fitted on the labelled ones among ``docs``."""
    ship_code(spark)
    return accepted_documents(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the least doc_id; rows count by their texts, whatever doc_ids they share or lack."""
    return one_of_each_group(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data generalised and disclosing terms removed."""
    return sanitised(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources by weight, documents as often as they are taken."""
    return mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and digests of ids and decoded text."""
    return encode_documents(docs, keep_ids=True).drop("decoded")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("pii", pii),
    ("mix_sources", mix_sources),
    ("bpe", bpe),
]

# The classifier's network and the tokenizer are not SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
