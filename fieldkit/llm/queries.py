"""One registered query per operator, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkit.llm import (bpe, embed_dedup, html_text, line_dedup, lm, mixing, oracles, packing, prefix_trie, quality, secrets, simhash,
                          toxicity, vector_codes)
from fieldkit.llm.common import read_documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    return simhash.simhash_components(read_documents(spark, sf_dir))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated line runs, and the spans taken out."""
    done = line_dedup.dedup_lines(read_documents(spark, sf_dir))
    span = F.transform("removed", lambda s: F.concat_ws(":", s["from"], s["to"]))
    return done.select("doc_id", "n_lines", F.concat_ws(",", span).alias("removed"), "text")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 tokens."""
    return packing.pack(read_documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality figures and verdict for every document."""
    return quality.quality(read_documents(spark, sf_dir)).drop("text_key", "host")


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-count and context-mixing scores of every document."""
    return lm.lm_scores(read_documents(spark, sf_dir))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes every document."""
    return mixing.mix_sources(read_documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "labels"))


def op8_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    return embed_dedup.near_duplicates(read_documents(spark, sf_dir, "embeddings"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.secrets(read_documents(spark, sf_dir))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return html_text.page_text(read_documents(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code of every embedding, and the hash of the codebooks."""
    coded, codebooks = vector_codes.compress(read_documents(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_errors(coded).withColumn("codebooks_sha256", F.lit(vector_codes.digest(codebooks)))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.conversation_trie(read_documents(spark, sf_dir, "conversations"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the bytes they decode to, as hashes."""
    return bpe.round_trip(read_documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": oracles.LINE_DEDUP, "op4_quality_rules": oracles.QUALITY,
            "op8_embedding_neardup": oracles.EMBEDDINGS, "op11_vector_codes": oracles.VECTOR_CODES,
            "op12_conversation_trie": oracles.CONVERSATIONS}
