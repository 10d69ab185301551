"""One query per operator, over its whole table, and the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skirmish.llm.decontaminate import decontaminate
from skirmish.llm.hard_negatives import hard_negatives, quantised
from skirmish.llm.html_template import extract_main_text
from skirmish.llm.jaccard import jaccard_components
from skirmish.llm.lang_id import predict_languages
from skirmish.llm.packing import pack_documents
from skirmish.llm.quality_classifier import quality_scores
from skirmish.llm.quality_rules import quality_rules
from skirmish.llm.simhash import simhash_components
from skirmish.llm.spelling import spelling_variants
from skirmish.llm.sql import OP1_SQL, OP10_SQL, OP11_SQL, OP12_SQL, OP13_SQL
from skirmish.llm.tokens import count_tokens
from skirmish.llm.url_filter import filter_urls, host_of
from skirmish.llm.warc import round_trip
from skirmish.session import scratch_dir

#: Words of a host name that put its pages on the URL list.
LISTED_HOSTS = r"(^|[.-])(adult|casino|bets|pills|spam|ads)([.-]|$)"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through WARC archives and back."""
    return round_trip(_table(spark, sf_dir, "pages"), scratch_dir(spark, "warc")).drop("digest_ok")


def op2_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents."""
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked benchmark items of all documents."""
    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "coverage", F.col("leaks.item").alias("item_ids"))


def op6_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules on all documents."""
    return quality_rules(_table(spark, sf_dir, "documents"))


def op7_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents."""
    return simhash_components(_table(spark, sf_dir, "documents"))


def op8_empirical_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; source is the host, language the path below it."""
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_segmentation_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    return predict_languages(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_bloom_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URLs of all pages; listed are those of hosts with a listed word."""
    pages = _table(spark, sf_dir, "pages")
    return filter_urls(pages, pages.where(host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url"))


def op11_prefix_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by the Jaccard similarity of their 3-word shingles."""
    return jaccard_components(_table(spark, sf_dir, "documents"), words=3, percent=90)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector; every 7th vector's label is moved by one."""
    rows = quantised(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", scale=256)
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), every=50, positives=5, negatives=3)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling_variants(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline on all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_warc, op2_html_template, op3_token_counts, op4_retrieval_packing, op5_string_tiling, op6_robust_outliers,
    op7_simhash_bktree, op8_empirical_bayes, op9_segmentation_lang_id, op10_bloom_url_filter,
    op11_prefix_jaccard, op12_hard_negatives, op13_spelling_variants, pipeline)}

ORACLE: dict[str, str] = {"op1_warc": OP1_SQL, "op10_bloom_url_filter": OP10_SQL, "op11_prefix_jaccard": OP11_SQL,
                          "op12_hard_negatives": OP12_SQL, "op13_spelling_variants": OP13_SQL}
