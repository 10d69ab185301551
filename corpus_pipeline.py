"""Corpus pipeline: quality classifier, quality rules, near-duplicates,
benchmark decontamination, packing.

Each stage works on all documents that the one before it kept and returns the
columns of documents; the last one returns the packed pieces. A document is a
row, so repeated ids with other texts are judged on their own, and rows with a
null id take part like any other. Where a verdict is a row's own, the row
itself is the operator's id and passes through it; the classifier's and the
near-duplicates' verdicts come back by a join on id, text hash, language and
source, all that a verdict depends on. That join is a sort-merge join at every
size: the verdicts grow with the documents.

Null, empty and very long texts, null ids, repeated rows, extra columns and
empty tables take the course that each stage's operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skirmish.llm.decontaminate import decontaminate
from skirmish.llm.packing import pack_documents
from skirmish.llm.quality_classifier import quality_scores
from skirmish.llm.quality_rules import quality_rules
from skirmish.llm.simhash import simhash_components
from skirmish.llm.storage import stored
from skirmish.session import scratch_dir, ship_package


def _with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` and a new column that names each row."""
    name = "row"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn(name, F.struct("doc_id", F.xxhash64(text).alias("h"), "lang", "source")), name


def _without(docs: DataFrame, row: str, rejected: DataFrame) -> DataFrame:
    """Rows whose name is not among the rejected ones."""
    gone = stored(rejected.select(F.col(row)).distinct(), "rejected")
    return docs.join(gone.hint("merge"), row, "left_anti").drop(row)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the quality classifier keeps."""
    ship_package(spark)
    named, row = _with_row(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = quality_scores(named, labels, id_col=row, key_col="doc_id")
    return _without(named, row, scores.where("not kept"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what passes the base rules and is no outlier."""
    ship_package(spark)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), "text", "lang", "source")
    return quality_rules(whole, id_col="whole").where("kept").select("whole.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each SimHash component: that of the least id (a row
    given several times: one of them)."""
    ship_package(spark)
    named, row = _with_row(docs)
    found = simhash_components(named, id_col=row, words=3, radius=2)
    least = found.where(F.col(row) == F.col("component_id")).groupBy(row).agg(F.count("*").alias("n"))
    least = stored(least, "representatives")
    kept = named.join(least.select(row).hint("merge"), row, "left_semi")
    repeated = least.where("n > 1").select(row)
    if repeated.isEmpty():
        return kept.drop(row)
    once = kept.join(repeated, row, "left_anti")
    return once.unionByName(kept.join(repeated, row, "left_semi").dropDuplicates([row])).drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a leaked benchmark item."""
    ship_package(spark)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    whole = docs.select(F.struct(*others).alias("others"), "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = decontaminate(whole, benchmark, id_col="others", with_text=True).where("not contaminated")
    return clean.select("others.*", "text").select([f"`{c}`" for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents."""
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality_classifier), ("quality rules", quality_filter),
          ("near-duplicates", near_duplicates), ("decontamination", decontamination), ("packing", packing)]

#: The stages use fitted models, trees and tokenizers: not SQL. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_dir(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
