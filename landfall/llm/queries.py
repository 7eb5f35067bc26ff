"""One query for each operator of this package, with SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .boosted_trees import score_documents
from .common import ship, table
from .conversations import repair
from .fingerprints import fingerprint_documents
from .hard_negatives import mine
from .licenses import scan_licences
from .mixing import mix
from .near_dedup import near_duplicates
from .pieces import encode_documents, load_vocabulary
from .quality_rules import quality_rules
from .repeats import remove_repeats
from .secrets import scan_secrets
from .token_files import store_documents
from .warc import archive_pages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its own name, with its SQL if there is one."""

    def register(run: Query) -> Query:
        @wraps(run)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = shipped
        if oracle is not None:
            ORACLES[run.__name__] = oracle
        return shipped

    return register


@query(oracles.MIXING)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


@query()
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(oracles.WARC)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


@query()
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query()
def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents")).drop("spans")


@query()
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_documents(table(spark, sf_dir, "documents"), load_vocabulary())
    return found.withColumn("ids_sha256", F.sha2(F.array_join("ids", ","), 256))


@query()
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


@query(oracles.SUBSTRINGS)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return left.withColumnRenamed("kept", "kept_sha256")


@query()
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query(oracles.HARD_NEGATIVES)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


@query()
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return store_documents(table(spark, sf_dir, "documents"), vocabulary)


@query(oracles.REPAIR)
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))
