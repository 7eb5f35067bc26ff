"""From raw documents to encoded training text, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as
Parquet and read back as the next stage's docs. All but the last keep the columns of
`documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landfall.llm.common import saved, ship, small_batches, table
from landfall.llm.mixing import sample_documents
from landfall.llm.near_dedup import keep_first
from landfall.llm.pieces import encode_documents, load_vocabulary
from landfall.llm.quality_rules import keep_good
from landfall.llm.secrets import mask_secrets


def ready(spark: SparkSession) -> None:
    """What Python workers need: this library, and batches that are small beside their memory."""
    ship(spark)
    small_batches(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    ready(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    ready(spark)
    return keep_first(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; all documents stay."""
    ready(spark)
    return mask_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled towards the target weights."""
    return sample_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces."""
    ready(spark)
    return encode_documents(docs, load_vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("mixing", mixing),
    ("encoding", encoding),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
