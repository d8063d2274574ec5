"""The queries of the corpus operators, and their DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmill.llm.bpe import decode, encode
from crawlmill.llm.common import table
from crawlmill.llm.conversations import damage, repair_conversations
from crawlmill.llm.exact_dedup import exact_groups
from crawlmill.llm.licenses import oracle_sql as license_oracle_sql, scan_licenses
from crawlmill.llm.neighbours import nearest_neighbours
from crawlmill.llm.order_minhash import compare_with_next
from crawlmill.llm.packing import pack, text_cluster, word_count
from crawlmill.llm.passages import passage_classes
from crawlmill.llm.quality import score_quality
from crawlmill.llm.secrets import KINDS, secret_spans, spans_text
from crawlmill.llm.simhash import simhash_components
from crawlmill.llm.url_filter import Rule, judge_urls, oracle_sql as url_oracle_sql
from crawlmill.llm.whitening import whiten

BPE_FILE = "byte_bpe_50k.json"
WORDS_FILE = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLE_SQL[name] = sql
        return function

    return register


@_query(
    "op1_exact_dedup",
    """
    SELECT doc_id,
           max(doc_id) OVER copies AS keep_id,
           count(*) OVER copies AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER copies AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW copies AS (PARTITION BY coalesce(text, ''))
    """,
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@_query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


@_query("op10_secrets")
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS_FILE))
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(spans_text(F.filter(spans, lambda s: s["kind"] != "guess")), 256).alias("base_sha256"),
        spans_text(spans).alias("spans"),
    )


URL_RULES = [
    Rule.parse("allow", "com/"),
    Rule.parse("block", "example.com/en/"),
    Rule.parse("allow", "www.example.com/en/"),
    Rule.parse("block", "net/es/"),
    Rule.parse("block", "net/fr/"),
]


@_query("op8_url_filter", url_oracle_sql(URL_RULES))
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@_query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@_query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("n_words"), text_cluster(F.col("text")).alias("cluster")
    )
    return pack(docs)


@_query("op6_neighbours")
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BPE_FILE)
    encoded = encode(table(spark, sf_dir, "documents"), path).withColumn("n_tokens", F.size("ids").cast("long"))
    decoded = decode(encoded, path, carry=["n_tokens"], digests=True)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


@_query("op5_licenses", license_oracle_sql("SELECT doc_id AS id, concat_ws('/', source, lang, doc_id) AS path, coalesce(text, '') AS text FROM documents"))
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source and language are the directories."""
    docs = table(spark, sf_dir, "documents")
    return scan_licenses(docs.withColumn("path", F.concat_ws("/", "source", "lang", "doc_id")))


@_query("op7_passages")
def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_classes(table(spark, sf_dir, "documents"))


@_query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair_conversations(damage(rows), rows)


@_query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@_query("op13_order_minhash")
def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))
