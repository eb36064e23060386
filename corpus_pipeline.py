"""The training-text pipeline: five stages, each an operator of ``wardbook.llm``.

Documents that the quality classifier rejects go, then those that the quality rules reject; of each group of
near copies one document stays; passages that repeat an earlier document are cut out; what is left is packed
into sequences. A stage gets all rows its predecessor kept, and its result is stored before the next one.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardbook.llm import knn_quality, ngram_join, packing, quality_rules, suffix_dedup
from wardbook.llm.scratch import stored, table

VOCABULARY = "byte_bpe_50k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return knn_quality.kept(docs, table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words a shingle, a similarity of 0.8 or more."""
    return ngram_join.one_per_group(docs, n=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", best_fit_packing),
]

# Votes, divergences and tokens are beyond SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
