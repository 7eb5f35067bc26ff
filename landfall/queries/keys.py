"""Content keys over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.keys import add_key
from .registry import PART, compat_text, query, strict_text, table

# Parts with gaps, so that the two encodings differ.
_GAPPED = (
    "p_partkey",
    "p_name",
    "CASE WHEN p_size > 25 THEN NULL ELSE p_brand END AS p_brand",
    "CASE WHEN p_size < 10 THEN NULL ELSE p_type END AS p_type",
    "p_size",
    "p_retailprice",
)
_PARTS = f"(SELECT {', '.join(_GAPPED)} FROM part) p"


def _parts(spark, folder):
    return table(spark, folder, "part").selectExpr(*_GAPPED)


@query(f"SELECT sha256({compat_text(*PART)}) AS part_key, * FROM {_PARTS}")
def content_key_skip_nulls(spark, folder):
    return add_key(_parts(spark, folder), "part_key", encoding="compat", digest="sha2_256")


@query(f"SELECT sha256({strict_text(*PART)}) AS part_key, * FROM {_PARTS}")
def content_key_strict(spark, folder):
    return add_key(_parts(spark, folder), "part_key", digest="sha2_256")


_LINE = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


@query(f"SELECT sha256({strict_text(*_LINE)}) AS line_key, l_orderkey, l_linenumber FROM lineitem")
def content_key_wide(spark, folder):
    keyed = add_key(table(spark, folder, "lineitem"), "line_key", digest="sha2_256")
    return keyed.select("line_key", "l_orderkey", "l_linenumber")


@query()
def content_key_sha3(spark, folder):
    """DuckDB has no SHA-3; the tests compare with ``hashlib``."""
    return add_key(table(spark, folder, "lineitem"), "line_key", encoding="compat")


@query("SELECT sha256(concat_ws('||', text, lang, source)) AS doc_key, doc_id FROM documents")
def content_key_long_text(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    keyed = add_key(
        documents,
        "doc_key",
        encoding="compat",
        digest="sha2_256",
        columns=("text", "lang", "source"),
    )
    return keyed.select("doc_key", "doc_id")


@query(f"SELECT sha256({strict_text('text', 'conv_id')}) AS turn_key, conv_id, turn FROM conversations")
def content_key_picked_columns(spark, folder):
    turns = table(spark, folder, "conversations")
    keyed = add_key(turns, "turn_key", digest="sha2_256", columns=("text", "conv_id"))
    return keyed.select("turn_key", "conv_id", "turn")


@query("SELECT count(*) AS row_count, count(DISTINCT md5(text)) AS text_count FROM documents")
def distinct_content(spark, folder):
    """A3: copies of a text fall on one key."""
    texts = table(spark, folder, "documents").select("text")
    keyed = add_key(texts, "text_key", encoding="compat", digest="sha3_512")
    per_key = keyed.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("row_count"), F.count("n").alias("text_count"))
