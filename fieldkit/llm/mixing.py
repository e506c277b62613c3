"""Mixing sources to target weights.

Targets are filled from the whole table's words by weight, none above a
multiple of its source's size. A source is taken in whole passes and a last
part of a pass: its documents lie in 2^12 blocks by a keyed hash, a random
permutation, and the part is the longest run of blocks, and of documents in
the block at its end, that stays within the target; one more document, the one
whose size comes closest to the words still missing, rounds it off.

Output shards get their quotas of blocks through a splitting tree: at each
node the blocks of all sources bound for it are split between its two halves by a
multivariate hypergeometric draw, so quotas add up exactly. Each source's
blocks, permuted once more per pass, are then dealt to the shards by quota:
disjoint, without replacement. Inside a shard copies are ordered by hash.

Only figures per source (sources x shards) pass through the driver; whether
and where a document goes is computed in the scan, without moving texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldkit.llm.common import save, tidied, word_counts

WEIGHTS = (5.0, 2.0, 1.0)   # by source in code-point order, repeating; null last
MAX_PASSES = 3
SHARDS = 16
BLOCK_BITS = 12
SLICE_WORDS = 1 << 20     # words of an output shard that a task writes, about
BROADCAST_SOURCES = 10_000
SEED = 20240611


def fill(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what is cut off is shared again."""
    targets = [0.0] * len(sizes)
    open_ = [k for k in range(len(sizes)) if weights[k] > 0]
    rest = float(total)
    while open_:
        unit = rest / sum(weights[k] for k in open_)
        full = [k for k in open_ if unit * weights[k] > most * sizes[k]]
        if not full:
            for k in open_:
                targets[k] = unit * weights[k]
            break
        for k in full:
            targets[k] = float(most * sizes[k])
            rest -= targets[k]
        open_ = [k for k in open_ if k not in set(full)]
    return targets


def split_quotas(blocks: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources) block quotas by a hypergeometric splitting tree; columns sum to ``blocks``."""
    if shards == 1:
        return blocks.reshape(1, -1)
    near = shards // 2
    take = round(int(blocks.sum()) * near / shards)
    left = rng.multivariate_hypergeometric(blocks, take, method="marginals")
    return np.vstack([split_quotas(left, near, rng), split_quotas(blocks - left, shards - near, rng)])


@dataclass
class Mix:
    """Per source: its words, target, whole passes, and the keys below which one pass more is taken."""
    sources: list[str | None]
    sizes: list[int]
    targets: list[float]
    passes: list[int]
    cuts: list[int]          # documents with a (signed 64-bit) key below it get one more copy,
    last: list[int | None]   # and so do those with this key
    deal: np.ndarray         # [source][pass] -> bounds of the shards in dealt block order


def sized(docs: DataFrame, *keep: str, seed: int = SEED) -> DataFrame:
    """The kept columns, ``size`` (words) and ``key`` (position of the row in its source's permutation)."""
    def run(batches):
        for b in batches:
            size = pa.array(word_counts(b.column("__text")), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], size], names=[*b.schema.names[:-1], "size"])
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    base = docs.select(*[F.col(f"`{c}`") for c in keep], order_key("doc_id", "text", seed).alias("key"), text.alias("__text"))
    schema = base.drop("__text").schema.add("size", LongType())
    return base.mapInArrow(tidied(run), schema)


def order_key(doc_id: str, text: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), F.col(text))


def _block(key: Column) -> Column:
    """Block number 0 .. 2^BLOCK_BITS - 1 in key order."""
    return (F.shiftright(key, 64 - BLOCK_BITS) + F.lit(1 << (BLOCK_BITS - 1))).cast("int")


def _side(table: DataFrame, sources: int) -> DataFrame:
    """A table of a row per source, broadcast while there are not too many."""
    return F.broadcast(table) if sources <= BROADCAST_SOURCES else table


def plan(rows: DataFrame, weights=WEIGHTS, most: float = MAX_PASSES, shards: int = SHARDS, seed: int = SEED) -> Mix:
    """The mix of ``rows(source, size, key)``, kept as a saved table by the caller."""
    blocks = save(rows.groupBy("source", _block(F.col("key")).alias("block")).agg(F.sum("size").alias("words")), "blocks")
    found = blocks.groupBy("source").agg(F.sum("words").alias("words")).collect()  # a row per source
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    names, sizes = [r["source"] for r in found], [int(r["words"]) for r in found]
    w = [float(weights[k % len(weights)]) for k in range(len(names))]
    targets = fill(sizes, w, sum(sizes), most)
    passes = [int(t // s) if s else 0 for t, s in zip(targets, sizes, strict=True)]
    parts = [max(0.0, t - p * s) for t, p, s in zip(targets, passes, sizes, strict=True)]
    cuts, last = _cuts(rows, blocks, names, parts)
    units = np.zeros((len(names), int(most) + 1), np.int64)
    n = 1 << BLOCK_BITS
    for s, p in enumerate(passes):
        units[s, :p] = n
        if parts[s] > 0 and p <= most:
            units[s, p] = ((cuts[s] >> (64 - BLOCK_BITS)) + n // 2) + 1 if cuts[s] < 2**63 - 1 else n
    rng = np.random.default_rng(seed)
    flat = units.reshape(-1)
    quotas = split_quotas(flat, shards, rng) if flat.sum() else np.zeros((shards, flat.size), np.int64)
    deal = np.cumsum(quotas, axis=0).T.reshape(len(names), int(most) + 1, shards)
    return Mix(names, sizes, targets, passes, cuts, last, deal)


def _cuts(rows: DataFrame, blocks: DataFrame, names: list, parts: list[float]) -> tuple[list[int], list[int | None]]:
    """Per source the key below which documents hold at most ``part`` words, and the key of the one that is added.

    First the block where the running sum over blocks (2^BLOCK_BITS rows at most) passes
    the part, then the documents of that one block, then the closest size among those left.
    A row per source comes to the driver each time.
    """
    low = -(2**63)
    if not names:
        return [], []
    spark = rows.sparkSession
    want = spark.createDataFrame([(s, float(p)) for s, p in zip(names, parts, strict=True)], "s string, part double")
    run = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    edge = (blocks.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
            .join(_side(want, len(names)), F.col("source").eqNullSafe(F.col("s")))
            .where("before < part AND before + words >= part").select("s", "block", "before", "part"))
    inside = (rows.withColumn("block", _block(F.col("key"))).alias("r")
              .join(edge.alias("e"), F.col("r.source").eqNullSafe(F.col("e.s")) & (F.col("r.block") == F.col("e.block")))
              .groupBy("s", "before", "part", "key").agg(F.sum("size").alias("size")))
    upto = F.sum("size").over(Window.partitionBy("s").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    within = (inside.withColumn("sum", F.col("before") + upto).where("sum <= part")
              .groupBy("s").agg(F.max(F.struct("key", "sum")).alias("m")))
    cuts, missing = {}, dict(zip(names, parts, strict=True))
    for r in edge.collect():
        cuts[r["s"]] = (int(r["block"]) - (1 << (BLOCK_BITS - 1))) << (64 - BLOCK_BITS)
        missing[r["s"]] = r["part"] - r["before"]
    for r in within.collect():
        cuts[r["s"]] = int(r["m"]["key"]) + 1
        missing[r["s"]] = parts[names.index(r["s"])] - r["m"]["sum"]
    gaps = spark.createDataFrame([(s, cuts[s], float(missing[s])) for s in names if s in cuts and missing[s] >= 1],
                                 "s string, cut bigint, gap double")
    rest = rows.join(_side(gaps, len(names)), F.col("source").eqNullSafe(F.col("s"))).where("key >= cut AND size > 0")
    off = F.abs(F.col("size") - F.col("gap"))
    close = rest.where(off < F.col("gap")).groupBy("s").agg(F.min(F.struct(off.alias("off"), "key")).alias("m")).collect()
    last = {r["s"]: int(r["m"]["key"]) for r in close}
    return [cuts.get(s, low) for s in names], [last.get(s) for s in names]


def mixed(rows: DataFrame, mix: Mix, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with source_size, target, copies, taken and the output shard of each copy.

    Everything is looked up by source in a table of a row per source.
    """
    spark = rows.sparkSession
    table = spark.createDataFrame(
        [(s, z, t, p, c, e, [[int(x) for x in q] for q in d]) for s, z, t, p, c, e, d in
         zip(mix.sources, mix.sizes, mix.targets, mix.passes, mix.cuts, mix.last, mix.deal.tolist(), strict=True)],
        "__s string, source_size bigint, target double, __passes int, __cut bigint, __last bigint, __deal array<array<bigint>>")
    out = rows.join(_side(table, len(mix.sources)), F.col("source").eqNullSafe(F.col("__s")))
    more = (F.col("key") < F.col("__cut")) | F.coalesce(F.col("key") == F.col("__last"), F.lit(False))
    copies = F.col("__passes") + more.cast("int")
    block = _block(F.col("key"))
    n = 1 << BLOCK_BITS

    def place(k: Column) -> Column:
        # a pass deals its blocks in an order of its own: an odd multiplier permutes block numbers
        odd = F.lit(2) * F.pmod(F.xxhash64(F.lit(seed), k), F.lit(n // 2)) + F.lit(1)
        whole = F.pmod(block * odd + k, F.lit(n))
        dealt = F.when(k < F.col("__passes"), whole).otherwise(block.cast("bigint"))
        bounds = F.element_at("__deal", (k + 1).cast("int"))
        # the document that rounds a source off may lie beyond the blocks dealt: it goes to the last shard
        return F.least(F.size(F.filter(bounds, lambda b: b <= dealt)), F.lit(shards - 1))

    places = F.when(F.col("__copies") > 0,
                    F.transform(F.sequence(F.lit(0), F.col("__copies") - 1), place)).otherwise(F.array().cast("array<int>"))
    return (out.withColumn("__copies", copies).withColumn("shards", places)
            .withColumn("copies", F.col("__copies")).withColumn("taken", F.col("size") * F.col("__copies"))
            .drop("__s", "__passes", "__cut", "__last", "__deal", "__copies"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, most: float = MAX_PASSES, shards: int = SHARDS,
                seed: int = SEED) -> DataFrame:
    """Per row of ``docs(doc_id, text, source, ...)``: doc_id, size, source_size, target, taken, copies, shards.

    ``shards`` lists the output shard of each copy. Null text has size 0; rows
    without a source form the last source; rows equal in doc_id and text go
    together; an empty table gives no rows; other columns are ignored.
    """
    rows = save(sized(docs, "doc_id", "source", seed=seed), "sized")
    return mixed(rows, plan(rows, weights, most, shards, seed), shards, seed).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "shards")


def mix_rows(docs: DataFrame, weights=WEIGHTS, most: float = MAX_PASSES, shards: int = SHARDS,
             seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as taken, with all their columns, dealt to the
    output shards (each in slices of about ``SLICE_WORDS`` words) and shuffled inside them by a hash of the row and its copy."""
    plan_rows = save(sized(docs, "source", seed=seed), "sized")
    mix = plan(plan_rows, weights, most, shards, seed)
    names = docs.columns
    whole = docs.select(F.col("source"), order_key("doc_id", "text", seed).alias("key"), F.lit(0).alias("size"),
                        F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"))
    out = mixed(whole, mix, shards, seed).select("__row", "key", F.posexplode("shards").alias("copy", "shard"))
    local = F.xxhash64(F.lit(seed), "key", "copy")
    slices = max(1, -(-int(sum(mix.targets)) // (shards * SLICE_WORDS)))
    return (out.withColumn("__order", local).repartition(F.col("shard"), F.pmod(F.col("__order"), F.lit(slices)))
            .sortWithinPartitions("shard", "__order").select("__row.*"))
