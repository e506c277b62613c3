"""Corpus-level text operators (TX-1..3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import fieldkit
from fieldkit.functions.text import chunks
from fieldkit.operators.frames import spread

# functions travel with the task (by value), so executors need no installed copy of this package
cloudpickle.register_pickle_by_value(fieldkit)


def word_count(docs: DataFrame, tokens: Column, name: str = "word") -> DataFrame:
    """Token frequencies over a corpus: explode, then a hash aggregate whose
    partial (map-side) step is the MapReduce combiner, so a very frequent
    word is pre-summed in every task before the shuffle."""
    return spread(docs).select(F.explode(tokens).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


WORDS = 1 << 20   # words whose n-grams are counted together before the shuffle, about


def _counted_ngrams(lists: pa.ListArray, n: int, sep: str) -> pa.RecordBatch:
    """Distinct n-grams of token lists with their counts: words become numbers, n-grams numbers made of those."""
    size = pc.list_value_length(lists).to_numpy()
    coded = lists.flatten().dictionary_encode(null_encoding="encode")
    code, many = coded.indices.to_numpy().astype(np.int64), max(len(coded.dictionary), 1)
    ends = np.repeat(np.cumsum(size), size)
    at = np.flatnonzero(np.arange(code.size) + n <= ends)   # where an n-gram begins
    key, kinds = code[at], many
    for k in range(1, n):
        if kinds * many >= 1 << 62:
            held, key = np.unique(key, return_inverse=True)
            kinds = held.size
        key, kinds = key * many + code[at + k], kinds * many
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    words = [coded.dictionary.take(pa.array(code[at[first] + k])) for k in range(n)]
    return pa.RecordBatch.from_arrays([pc.binary_join_element_wise(*words, sep, null_handling="skip"), pa.array(count)], names=["ngram", "n"])


def ngram_count(docs: DataFrame, tokens: Column, n: int, sep: str = " ") -> DataFrame:
    """Frequencies of word n-grams (within each document) over a corpus.

    Most n-grams are rare, so a task's hash table of them would hold nearly
    its whole input as strings and go to disk before the shuffle. They are combined as
    numbers instead, over some words at a time, and dealt into partitions in proportion to the
    scan, whose tables fit in memory: the shuffle is all that is written.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        words = 0
        for b in batches:
            lists = b.column("_tok").drop_null()
            upto = np.cumsum(pc.list_value_length(lists).to_numpy())
            begin = 0
            while begin < len(lists):
                before = int(upto[begin - 1]) if begin else 0
                end = max(begin + 1, int(np.searchsorted(upto, before + WORDS - words, side="right")))
                held.append(lists.slice(begin, end - begin))
                words += int(upto[end - 1]) - before
                begin = end
                if words >= WORDS or end < len(lists):
                    yield _counted_ngrams(pa.concat_arrays(held), n, sep)
                    held, words = [], 0
        if held:
            yield _counted_ngrams(pa.concat_arrays(held), n, sep)

    wide = spread(docs).select(tokens.cast("array<string>").alias("_tok"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8 * wide.rdd.getNumPartitions())
    return (wide.mapInArrow(run, "ngram string, n bigint").repartition(parts, "ngram")
            .groupBy("ngram").agg(F.sum("n").alias("n")))


def token_chunks(docs: DataFrame, key: str, tokens: Column, n: int) -> DataFrame:
    """Non-overlapping n-token chunks per document with their position."""
    return (spread(docs).select(key, tokens.alias("_tok"))
            .select(key, F.posexplode(chunks("_tok", n)).alias("chunk_no", "chunk")))
