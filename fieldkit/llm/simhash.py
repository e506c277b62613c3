"""SimHash near-duplicates: fingerprints linked through vantage-point trees.

Fingerprint: A-Z lower-cased, words, shingles of ``shingle`` words; bit i is
set if it is set in over half of the shingles' XXH64 (seed 42).

Linking. Distances of random 64-bit fingerprints to any point crowd around 32,
where a ball of 4 bits overlaps nearly every boundary. So the bits are cut
into segments with a tree each: two fingerprints within 4 bits are within 1,
1 or 0 bits on one of three segments (were they 2, 2 and 1 bits or more apart
there, they would be 5 apart). Each tree splits by the Hamming distance on its
segment to a vantage point: near side ``d <= m + r``, far side ``d > m``. By the triangle
inequality a pair within ``r`` is never parted, so each leaf (a shard) holds
all pairs it must answer for, and only fingerprints on the boundary go to
both sides. In a shard all 64 bits are compared, and a search that takes each
found fingerprint out of the rest gives the shard's components; only a
spanning star of each is handed on.

Vantage points and bounds are fitted to at most ``sample`` distinct
fingerprints (in hash order); every fingerprint is indexed. Shards above
``cell`` fingerprints are cut into chunks by hash and each pair of chunks is a
task of its own, so no shard must fit one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldkit.llm.common import in_batches, save, text_bytes, tidied, words_of
from fieldkit.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SAMPLE = 16384
LEAF = 4096
CELL = 65536
SEGMENTS = 3


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned integer; 0 if the text has no word."""
    words = words_of(text.lower())
    n = len(words)
    if n == 0:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.empty(n, np.int64)
        starts[0] = 0
        starts[1:] = ends[:-1] + 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED)
                  for a, b in zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)]
    h = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, h.size, 65536):
        part = h[k:k + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > h.size, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) per row of ``docs``; fp is the 64-bit fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"])
    ids = docs.schema["doc_id"].dataType.simpleString()
    return text_bytes(docs, "doc_id").mapInArrow(tidied(run), f"doc_id {ids}, fp bigint")


@dataclass
class Node:
    """A leaf (number ``leaf``) or a split at distance ``m`` from ``point``."""
    leaf: int = -1
    point: int = 0
    m: int = 0
    near: Node | None = None
    far: Node | None = None


@dataclass
class Tree:
    mask: int
    radius: int
    root: Node


def segment_rules(max_bits: int, segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """(mask, radius) per segment: a pair within ``max_bits`` is within the radius on one of them."""
    rules, low = [], 0
    for s in range(segments):
        width = 64 // segments + (s < 64 % segments)
        radius = (max_bits + 1) // segments + (s < (max_bits + 1) % segments) - 1
        if radius >= 0:
            rules.append((((1 << width) - 1) << low, radius))
        low += width
    return rules


def grow(sample: np.ndarray, total: int, mask: int, radius: int, first_leaf: int, leaf: int) -> tuple[Tree, int]:
    """A vantage-point tree over the sample whose leaves are to hold about ``leaf`` of ``total``."""
    rng = np.random.default_rng(mask % (1 << 32))
    count = [first_leaf]
    bits = np.uint64(mask)

    def split(x: np.ndarray) -> Node:
        best = None
        if x.size >= 16 and x.size / max(sample.size, 1) * total > leaf:
            for v in x[rng.integers(0, x.size, 8)]:
                d = np.bincount(np.bitwise_count((x ^ v) & bits), minlength=65)
                upto = np.cumsum(d)
                near = upto[np.minimum(np.arange(64) + radius, 64)]
                worse = np.maximum(near, x.size - upto[:64])
                m = int(np.argmin(worse))
                if best is None or worse[m] < best[0]:
                    best = (int(worse[m]), int(v), m)
        if best is None or best[0] > 0.85 * x.size:
            count[0] += 1
            return Node(leaf=count[0] - 1)
        _, v, m = best
        d = np.bitwise_count((x ^ np.uint64(v)) & bits)
        return Node(point=v, m=m, near=split(x[d <= m + radius]), far=split(x[d > m]))

    return Tree(mask, radius, split(sample)), count[0]


def shards_of(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for every shard that each fingerprint is routed to."""
    rows, leaves = [], []

    def walk(node: Node, at: np.ndarray) -> None:
        if not at.size:
            return
        if node.near is None:
            rows.append(at)
            leaves.append(np.full(at.size, node.leaf, np.int32))
            return
        d = np.bitwise_count((x[at] ^ np.uint64(node.point)) & np.uint64(tree.mask))
        walk(node.near, at[d <= node.m + tree.radius])
        walk(node.far, at[d > node.m])

    walk(tree.root, np.arange(x.size))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(rows), np.concatenate(leaves)


def local_stars(x: np.ndarray, max_bits: int, block: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) links that join the components of distinct fingerprints within ``max_bits``."""
    rest = x
    members, roots = [], []
    while rest.size > 1:
        head = rest[:block]
        near = np.bitwise_count(head[:, None] ^ rest[None, :]) <= max_bits
        alone = near.sum(axis=1) == 1
        if alone.all():
            rest = rest[head.size:]
            continue
        root = head[np.argmin(alone)]
        keep = np.ones(rest.size, bool)
        keep[:head.size] = ~alone
        keep[int(np.argmin(alone))] = False
        rest = rest[keep]
        front = np.array([root], np.uint64)
        while front.size and rest.size:
            now, front = front[:block], front[block:]
            hit = (np.bitwise_count(now[:, None] ^ rest[None, :]) <= max_bits).any(axis=0)
            if hit.any():
                found = rest[hit]
                rest = rest[~hit]
                members.append(found)
                roots.append(np.full(found.size, root, np.uint64))
                front = np.concatenate([front, found])
    if not members:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(members), np.concatenate(roots)


def link_stars(nodes: DataFrame, max_bits: int = MAX_BITS, sample: int = SAMPLE, leaf: int = LEAF,
               cell: int = CELL) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``nodes(fp)`` that span every component within ``max_bits``."""
    total = nodes.count()
    picked = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).toArrow().column("fp")
    points = picked.to_numpy().astype(np.int64).view(np.uint64)
    trees, n = [], 0
    for mask, radius in segment_rules(max_bits):
        tree, n = grow(points, total, mask, radius, n, leaf)
        trees.append(tree)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in in_batches(batches, 200_000):
            x = t.column("fp").to_numpy().astype(np.int64).view(np.uint64)
            for tree in trees:
                rows, leaves = shards_of(tree, x)
                yield pa.RecordBatch.from_arrays([pa.array(leaves), pa.array(x[rows].view(np.int64))],
                                                 names=["shard", "fp"])

    routed = save(nodes.select("fp").mapInArrow(route, "shard int, fp bigint"), "shards")
    chunks = routed.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(cell)).cast("int").alias("g"))
    c = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("g")).cast("int")
    cells = (routed.join(chunks, "shard")
             .select("shard", "fp", c.alias("c"), F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("k"))
             .select("shard", F.least("c", "k").alias("i"), F.greatest("c", "k").alias("j"), "fp"))

    def stars(t: pa.Table) -> pa.Table:
        x = np.unique(t.column("fp").to_numpy().astype(np.int64).view(np.uint64))
        a, b = local_stars(x, max_bits)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return cells.groupBy("shard", "i", "j").applyInArrow(stars, "a bigint, b bigint")


def _roots(nodes: DataFrame, max_bits: int, **limits) -> DataFrame:
    """(fp, root) for every fingerprint of ``nodes(fp)``."""
    roots = components(link_stars(nodes, max_bits, **limits))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select(*nodes.columns, F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, **limits) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs(doc_id, text, ...)``.

    component_id is the smallest doc_id reachable over links, itself included.
    Null, empty and blank texts have fingerprint zero and link like any other;
    repeated rows are returned as often as they come; a null doc_id takes part
    but never names a component (null if no other id is reachable); an empty
    table gives no rows; other columns are ignored.
    """
    fps = save(fingerprints(docs, shingle), "fingerprints")
    nodes = save(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    linked = _roots(nodes, max_bits, **limits)
    named = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = linked.join(named, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, **limits) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that with the smallest doc_id (rows without one come last).

    Rows are told apart by doc_id and a hash of the text, so rows that share a doc_id stand for themselves; of rows that share
    it within a component the text with the smaller hash stays, of rows equal in both any one.
    """
    key = [F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.xxhash64(F.lit(13), F.col("text")).alias("t")]
    rows = docs.select(F.struct(*key).alias("doc_id"), "text")   # the key takes the place of the id
    fps = save(fingerprints(rows, shingle), "fingerprints")
    nodes = save(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    stay = _roots(nodes, max_bits, **limits).groupBy("root").agg(F.min("first").alias("k")).select("k.*")   # one row per component
    stay = stay.select(F.col("doc_id").alias("__id"), F.col("t").alias("__t"))
    t = F.xxhash64(F.lit(13), F.col("text"))
    kept = docs.withColumn("__key_t", t).join(stay, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key_t") == F.col("__t")), "left_semi")
    equal = (fps.groupBy(F.col("doc_id.doc_id").alias("__id"), F.col("doc_id.t").alias("__t")).agg(F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    if equal.isEmpty():
        return kept.drop("__key_t")
    # rows equal in id and text: one of them (combined before the shuffle)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = kept.groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__i"), F.col("doc_id").isNull().alias("__n"), "__key_t").agg(
        F.first(whole).alias("__row"))
    return kept.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
