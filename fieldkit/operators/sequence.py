"""Order-based window steps that stay parallel when one key is huge.

``lead`` / ``row_number`` over ``Window.partitionBy(keys)`` put a whole key in
one task. With ``chunked=True`` the rows are first range-partitioned on
(keys, order) into contiguous chunks, the window runs per (keys, chunk), and
the chunk boundaries are stitched from a per-(key, chunk) summary — a table
with one row per key plus one per chunk split, whose windows hold at most
one row per chunk for any key. Results equal the plain windows exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldkit.session import cut_lineage

_PART = "_chunk"


def _chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int | None) -> DataFrame:
    """Range chunks with their id, materialised once: the chunk boundaries
    come from sampling, and both branches that read this frame (the local
    window and the chunk summary) must see the same boundaries."""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *keys, *order).withColumn(_PART, F.spark_partition_id()))


def with_next(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], prefix: str = "next_",
              chunked: bool = False, n_chunks: int | None = None) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the next row of the same key
    (by ``order``, a total order within the key); NULL on the last row."""
    keys, order, cols = list(keys), list(order), list(cols)
    if not chunked:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[F.lead(c).over(w).alias(prefix + c) for c in cols])
    r = _chunks(df, keys, order, n_chunks)
    w = Window.partitionBy(*keys, _PART).orderBy(*order)
    local = r.select("*", *[F.lead(c).over(w).alias(prefix + c) for c in cols],
                     F.lead(F.lit(1)).over(w).isNull().alias("_last"))
    # first row of every (key, chunk), and for each chunk the next chunk's first row
    first_row = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c).alias(c) for c in cols])
    firsts = r.groupBy(*keys, _PART).agg(F.min(first_row).alias("_f"))
    wk = Window.partitionBy(*keys).orderBy(_PART)
    succ = firsts.select(*keys, _PART, F.lead("_f").over(wk).alias("_succ"))
    out = local.join(succ, [*keys, _PART], "left")
    for c in cols:
        out = out.withColumn(prefix + c, F.when(F.col("_last"), F.col("_succ." + c)).otherwise(F.col(prefix + c)))
    return out.drop("_last", "_succ", _PART)


def with_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
                    chunked: bool = False, n_chunks: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of the row within its key by ``order``."""
    keys, order = list(keys), list(order)
    if not chunked:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    r = _chunks(df, keys, order, n_chunks)
    local = r.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, _PART).orderBy(*order)))
    counts = r.groupBy(*keys, _PART).agg(F.count(F.lit(1)).alias("_n"))
    wk = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, _PART, F.coalesce(F.sum("_n").over(wk), F.lit(0)).alias("_off"))
    return (local.join(offsets, [*keys, _PART])
            .withColumn(name, (F.col("_off") + F.col("_rn")).cast("int"))
            .drop("_rn", "_off", _PART))
