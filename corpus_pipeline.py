"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir); docs are the rows that the stage before kept, and all of them are judged anew there: labels,
line counts, links and contamination are those of the stage's own input. All but the last return the columns of documents. n_chars is
kept true where a stage changes texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.decontaminate import clean_documents
from tallymart.llm.jaccard import one_of_each_group
from tallymart.llm.line_dedup import without_repeated_lines
from tallymart.llm.packing import packed
from tallymart.llm.quality_gam import good_documents
from tallymart.llm.shared import folder, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels of the documents that are here."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that a later document repeats."""
    out = without_repeated_lines(docs)
    if "n_chars" not in docs.columns:
        return out
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(n_chars)).select(docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items do not contaminate."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packed(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: A trained model and a tokenizer cannot be said in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        path = folder(spark, f"pipeline-{k}")
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
