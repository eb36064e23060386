"""The registered queries of this subpackage, over whole tables, and the SQL some are checked against."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.llm import knn_quality, licenses, ngram_join, packing, periodic, pieces, quality_rules, recompression, suffix_dedup, token_counts, topk, url_filter, whitening
from wardbook.llm.scratch import table

URL_RULES = [
    url_filter.Rule(url_filter.BLOCK, "net/"),
    url_filter.Rule(url_filter.ALLOW, "example.net/en/"),
    url_filter.Rule(url_filter.BLOCK, "example.com/de/"),
    url_filter.Rule(url_filter.ALLOW, "org/fr/"),
]


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passage of 50 or more words that repeats an earlier document."""
    found = suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "first_word", "n_words", "first_doc_id", F.sha2("passage", 256).alias("passage_sha256"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digest(pieces.decoded(pieces.encoded(table(spark, sf_dir, "documents"), path), path))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"), n=4, percent=85)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.digest(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES)


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's texts: in about a tenth of the documents (by ``h``) the words from the ``a``-th on repeat
    the first ``p`` of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    period = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    planted = F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(period), F.lit(1), n - a))
    chosen = (F.pmod(h, F.lit(10)) == 0) & (n > 0)
    return docs.select("doc_id", F.when(chosen, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.with_runs(_with_planted_runs(table(spark, sf_dir, "documents"))))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scanned(table(spark, sf_dir, "documents")))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_array_dedup": op1_suffix_array_dedup,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_token_counts": op3_token_counts,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_ngram_join": op5_ngram_join,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_exact_top_k": op7_exact_top_k,
        "op8_quality_rules": op8_quality_rules,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_url_filter": op10_url_filter,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_license_scan": op12_license_scan,
        "op13_embedding_whitening": op13_embedding_whitening,
    }


def all_oracles() -> dict[str, str]:
    return {}
