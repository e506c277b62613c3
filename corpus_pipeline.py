"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the documents it hands on
(the last one: the pieces and their places); ``run`` writes each result as a
table in the shared checkpoint folder and reads it back for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldkit.llm import line_dedup, mixing, packing, quality, simhash
from fieldkit.llm.common import read_documents, save


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs."""
    return line_dedup.remove_repeats(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, each document as often as the mix takes it."""
    return mixing.mix_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of the mix in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", without_repeated_lines),
    ("simhash near-dedup", one_of_each_group),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents table."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs


ORACLE_SQL = None  # fingerprints and tokenizers are beyond SQL; tests hold every stage against brute force
