"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised; equal vectors form one class. Each of several tables
buckets the classes by a few quantised Gaussian projections
floor((a.x + b) / r). Two vectors in one bucket of any table are compared by
their exact cosine in double precision. A pair is counted in the first table
that holds both, so link counts add up without a list of pairs; of the links
only a spanning star per bucket is handed on for the components.

Projections per table follow from the number of classes (about ``bucket``
unrelated vectors in a bucket), the number of tables from the wanted recall
for a pair right at the threshold. Buckets above ``cell`` classes are cut into
chunks, and every pair of chunks is compared as a group of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.common import save
from fieldkit.llm.components import components

MIN_COSINE = 0.95
RECALL = 0.95      # of pairs right at the threshold; closer pairs are found more often
WIDTH = 1.0        # of a quantisation step
BUCKET = 64
CELL = 1024
SEED = 7


def collision(distance: float, width: float) -> float:
    """Probability that a Gaussian projection puts two points at this distance into one step."""
    s = width / distance
    tail = 0.5 * math.erfc(s / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * s) * (1 - math.exp(-s * s / 2))


def table_plan(classes: int, min_cosine: float, recall: float, width: float, bucket: int) -> tuple[int, int]:
    """(projections per table, tables)."""
    near = collision(math.sqrt(max(2 - 2 * min_cosine, 1e-9)), width)
    far = collision(math.sqrt(2), width)
    k = max(2, math.ceil(math.log(max(classes / bucket, 1)) / -math.log(far)))
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near**k)))


def projections(dim: int, k: int, tables: int, seed: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, k * tables)), rng.uniform(0, width, k * tables)


def unit(v: list | None) -> np.ndarray | None:
    """The normalised vector in double precision; None if it can link with nothing."""
    if not v or None in v:
        return None
    x = np.asarray(v, np.float64)
    top = np.abs(x).max()
    if not np.isfinite(top) or top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def table_keys(x: np.ndarray, dim_at: dict, k: int, tables: int, seed: int, width: float) -> np.ndarray:
    """(rows, tables) bucket keys of normalised vectors of one dimension."""
    dim = x.shape[1]
    if dim not in dim_at:
        dim_at[dim] = projections(dim, k, tables, seed, width)
    a, b = dim_at[dim]
    steps = np.floor((x @ a + b) / width).astype(np.int64).view(np.uint64).reshape(len(x), tables, k)
    key = np.full((len(x), tables), dim, np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for c in range(k):
        key = (key ^ steps[:, :, c]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def compare(x: np.ndarray, keys: np.ndarray, table: int, min_cosine: float, side: np.ndarray | None,
            weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(links per row counted here, smallest row reachable here) for the rows of one bucket.

    ``side``: the chunk of each row where two chunks meet; then only pairs across count.
    """
    near = x @ x.T >= min_cosine
    np.fill_diagonal(near, False)
    if side is not None:
        near &= side[:, None] != side[None, :]
    here = near.copy()
    for t in range(table):
        here &= keys[:, t][:, None] != keys[:, t][None, :]
    links = here @ weight
    label = np.arange(len(x))
    if near.any():
        while True:
            new = np.minimum(label, np.where(near, label[None, :], len(x)).min(axis=1))
            if (new == label).all():
                break
            label = new
    return links, label


def hashed(vectors: DataFrame, seed: int) -> DataFrame:
    """vec_id, hash of the vector (null if it links with nothing), its normalised components as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            units = [unit(v) for v in b.column("embedding").to_pylist()]
            raw = [None if u is None else u.tobytes() for u in units]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array([None if r is None else xxhash.xxh3_128_digest(r) for r in raw], pa.binary()),
                 pa.array(raw, pa.binary())], names=["vec_id", "h", "v"])
    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, h binary, v binary")


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, recall: float = RECALL, width: float = WIDTH,
                    bucket: int = BUCKET, cell: int = CELL, seed: int = SEED) -> DataFrame:
    """Per row of ``vectors(vec_id, embedding, ...)``: vec_id, n_links, component_id, kept (vec_id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without a vec_id, link with nothing and are components of their
    own; vectors of different lengths never link; each row of a repeated vec_id
    counts as a vector; an empty table gives no rows; other columns are ignored.
    """
    rows = save(hashed(vectors, seed), "vectors")
    good = rows.where("h IS NOT NULL AND vec_id IS NOT NULL")
    classes = save(good.groupBy("h").agg(F.count("*").alias("m"), F.min("vec_id").alias("first_id"),
                                         F.first("v").alias("v"))
                   .withColumn("c", F.monotonically_increasing_id()), "classes")
    k, tables = table_plan(classes.count(), min_cosine, recall, width, bucket)

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim_at: dict = {}
        for b in batches:
            raw = b.column("v").to_pylist()
            keys: list = [None] * len(raw)
            by_dim: dict[int, list[int]] = {}
            for i, r in enumerate(raw):
                by_dim.setdefault(len(r), []).append(i)
            for at in by_dim.values():
                x = np.stack([np.frombuffer(raw[i], np.float64) for i in at])
                for i, row in zip(at, table_keys(x, dim_at, k, tables, seed, width), strict=True):
                    keys[i] = row
            yield pa.RecordBatch.from_arrays([b.column("c"), b.column("m"), b.column("v"),
                                              pa.array(keys, pa.list_(pa.int64()))], names=["c", "m", "v", "keys"])

    keyed = save(classes.select("c", "m", "v").mapInArrow(
        bucketed, "c bigint, m bigint, v binary, keys array<bigint>"), "keys")
    at = keyed.select("c", F.posexplode("keys").alias("tab", "key"))
    shared = (at.groupBy("tab", "key").agg(F.count("*").alias("n")).where("n > 1")
              .select("tab", "key", F.ceil(F.col("n") / F.lit(cell)).cast("int").alias("g")))
    own = F.pmod(F.xxhash64("c", F.lit(3)), F.col("g")).cast("int")
    cells = (at.join(shared, ["tab", "key"])
             .select("c", "tab", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("o"))
             .select("c", "tab", "key", "own", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j")))
    full = cells.join(keyed, "c")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def close() -> pa.RecordBatch | None:
            c = np.array([r[5] for r in held], np.int64)
            if len(held) < 2:
                return None
            side = np.array([r[4] for r in held]) if held[0][2] != held[0][3] else None
            x = np.stack([np.frombuffer(r[7], np.float64) for r in held])
            links, label = compare(x, np.array([r[8] for r in held]), held[0][0], min_cosine, side,
                                   np.array([r[6] for r in held], np.int64))
            some = (links > 0) | (label != np.arange(len(c)))
            return pa.RecordBatch.from_arrays([pa.array(c[some]), pa.array(links[some].astype(np.int64)),
                                               pa.array(c[label][some])], names=["c", "links", "root"])

        for b in batches:
            for row in zip(*[b.column(n).to_pylist() for n in ("tab", "key", "i", "j", "own", "c", "m", "v", "keys")],
                           strict=True):
                if held and row[:4] != held[0][:4]:
                    done = close()
                    if done is not None:
                        yield done
                    held = []
                held.append(row)
        if held:
            done = close()
            if done is not None:
                yield done

    found = save(full.repartition("tab", "key", "i", "j").sortWithinPartitions("tab", "key", "i", "j", "c")
                 .select("tab", "key", "i", "j", "own", "c", "m", "v", "keys")
                 .mapInArrow(linked, "c bigint, links bigint, root bigint"), "found")
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    roots = components(found.where("c <> root").select(F.col("c").alias("a"), F.col("root").alias("b")))
    named = (classes.select("c", "h", "m", "first_id").join(roots, F.col("c") == F.col("node"), "left")
             .withColumn("root", F.coalesce("root", "c")))
    component = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answer = (named.join(component, "root").join(links, "c", "left")
              .select("h", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"))
    one = good.select("vec_id", "h").join(answer, "h").select("vec_id", "n_links", "component_id")
    rest = (rows.where("h IS NULL OR vec_id IS NULL")
            .select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")))
    return one.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
