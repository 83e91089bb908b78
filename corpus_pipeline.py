"""The corpus pipeline: five stages over ``documents``, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import decontaminate, jaccard_join, packing, quality, secrets
from shelfline.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects."""
    return quality.classify(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"), whole=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest key of each group; those without words are groups of one."""
    named = jaccard_join.jaccard_components(docs)
    gone = named.where("doc_id <> component_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.clean_rows(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets; no document goes. ``n_chars`` follows the text."""
    return secrets.mask_secrets(docs.select(*COLUMNS)).selectExpr("doc_id", "text", "lang", "source", "cast(char_length(text) as long) as n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of what is left."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_masking),
    ("packing", packed),
]

#: The first stage is a fitted model and the last needs a tokenizer; SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
