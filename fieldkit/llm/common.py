"""Helpers shared by the text operators: words, shared tables, row keys."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import fieldkit
from fieldkit.session import ensure_checkpoint_dir

# functions travel with the task (by value), so executors need no installed copy of this package
cloudpickle.register_pickle_by_value(fieldkit)

WORD_BREAKS = b" \t\n\x0b\x0c\r"  # words are runs of any other byte


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python process. Module globals may not: functions can be shipped to
    the executors by value, and then each task has globals of its own."""
    return sys.modules.setdefault("fieldkit_worker_cache", ModuleType("fieldkit_worker_cache")).__dict__.setdefault(name, {})


def tidied(run: Callable) -> Callable:
    """A function over Arrow batches that gives back memory when its task ends: Python processes outlive their tasks,
    and what their allocators keep adds to the next stage's."""
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):   # where there is another C library
                ctypes.CDLL("libc.so.6").malloc_trim(0)
    return tidy


def words_of(text: bytes) -> list[bytes]:
    """Runs of bytes other than U+0020 and U+0009-U+000D (what bytes.split() takes as white space)."""
    return text.split()


def save(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage: later stages survive lost executors without redoing the
    work above, and non-deterministic columns (partition numbers) are fixed.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The kept columns and the text as UTF-8 bytes (null: empty), for Arrow functions."""
    return df.select(*keep, F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))


def in_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Arrow batches gathered into tables of about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def word_counts(col: pa.Array) -> np.ndarray:
    """Words per element of a binary Arrow array without nulls, from its byte buffer."""
    if len(col) == 0:
        return np.zeros(0, np.int64)
    at = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    word = data != 32
    word &= (data < 9) | (data > 13)
    first = word.copy()
    first[1:] &= ~word[:-1]
    some = at[:-1] < at[1:]
    starts = at[:-1][some]
    first[starts] = word[starts]  # a word never spans two elements
    counts = np.zeros(len(col), np.int64)
    if starts.size:
        counts[some] = np.add.reduceat(first.view(np.int8), starts, dtype=np.int64)
    return counts


def bucket_of(doc_id: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (the fold of a document)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(modulus)


def read_documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
