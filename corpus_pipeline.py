"""The corpus pipeline: documents in, packed pieces out.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. Results are
written as Parquet and read again between stages. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import jaccard, language, mixing, packing, quality
from millrace.llm.common import written
from millrace.llm.queries import TOKENIZER


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and lie near the cloud of their language and source."""
    return quality.accepted(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the field, fitted on this stage's input, can tell."""
    return language.accepted(docs, language.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents."""
    return jaccard.unique(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, one or two rows each."""
    return mixing.mixture(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    return packing.pieces(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("packing", best_fit),
]

#: Fitted models decide in the first two stages, so no SQL gives the same rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
