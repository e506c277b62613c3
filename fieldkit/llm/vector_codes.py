"""Product codes of vectors by Lloyd's rounds over cover trees.

A vector's components become integers, cut into parts; every part position has
a codebook of its own. The rows of a task are taken a few thousand at a time,
and for every part position a cover tree is built over them, once: a node's
children lie more than a power of two apart and cover its points within it.
The points of a node stand side by side, so the cumulative sums of the
points give the sum and the count of any subtree at once.

A round walks the trees from the top with the entries that may still be
nearest. With ``d`` from a node's point to an entry and ``r`` to its farthest
point, entries beyond ``min(d) + 2 r`` are nearest to no point below. Where one
entry is left the whole subtree is its; other nodes go on to their children,
and what is still open in a leaf is compared exactly, in integers. Tasks hand on a
sum and a count per entry, so neither links nor vectors leave their task.

The trees are a table in the shared folder: rounds read it anew and a lost
executor repeats its own part only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.common import in_batches, save

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
TREE_ROWS = 4096
LEAF = 8             # points that are not parted further
LIMIT = 1 << 25      # integers beyond it are taken as it, so that distances of 32,768 components fit a long
BROADCAST_LABELS = 100_000


class Tree(NamedTuple):
    """Cover trees of one block of rows, one for every part position."""

    points: np.ndarray   # (parts * rows, width): the points of every node stand side by side
    rows: np.ndarray     # the row that a point belongs to
    first: np.ndarray    # per node: its points are [first, end)
    end: np.ndarray
    middle: np.ndarray   # its own point
    radius: np.ndarray   # squared distance of its farthest point
    child: np.ndarray    # its first child; the others follow
    children: np.ndarray


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [first, first + size), one range after another."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if ends.size else 0)


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def build(x: np.ndarray) -> Tree:
    """Cover trees over integer vectors (rows, parts, width), all part positions level by level at once."""
    n, parts, width = x.shape
    points = np.ascontiguousarray(x.transpose(1, 0, 2)).reshape(parts * n, width)
    order = np.arange(parts * n)
    # the nodes of a level: their range of ``order``, their point, and every point's squared distance to it
    first, size = np.arange(parts) * n, np.full(parts, n)
    own = first.copy()
    away = _square(points, np.repeat(points[own], n, axis=0))
    levels, made = [], parts
    while first.size:
        at = _ranges(first, size)
        d = away[at]
        radius = np.maximum.reduceat(d, np.cumsum(size) - size)
        level = [first, size, own, radius, np.zeros(first.size, np.int64), np.zeros(first.size, np.int64)]
        levels.append(level)
        inner = np.flatnonzero((size > LEAF) & (radius > 0))
        if not inner.size:
            break
        at = _ranges(first[inner], size[inner])
        group = np.repeat(np.arange(inner.size), size[inner])
        p, d = order[at], away[at]
        # the largest power of two below the radius, squared
        half = 4 ** np.maximum(np.ceil(np.log2(radius[inner]) / 2).astype(np.int64) - 1, 0)
        half[half >= radius[inner]] >>= 2
        number = np.zeros(p.size, np.int64)
        left = np.flatnonzero(d > half[group])
        centres = [(np.arange(inner.size), own[inner])]
        while left.size:   # the first point not yet covered is the next child
            g = group[left]
            new = np.flatnonzero(np.diff(g, prepend=-1))
            centre = np.zeros(inner.size, np.int64)
            centre[g[new]] = p[left[new]]
            far = _square(points[p[left]], points[centre[g]])
            covered = far <= half[g]
            number[left[covered]] = len(centres)
            d[left[covered]] = far[covered]
            centres.append((g[new], centre[g[new]]))
            left = left[~covered]
        kids = len(centres)
        key = group * kids + number
        sort = np.argsort(key, kind="stable")
        order[at], away[at] = p[sort], d[sort]
        key, size_next = np.unique(key, return_counts=True)
        centre_of = np.full(inner.size * kids, -1)
        for k, (g, c) in enumerate(centres):
            centre_of[g * kids + k] = c
        parent = key // kids
        level[5][inner] = np.bincount(parent, minlength=inner.size)
        level[4][inner] = made + np.searchsorted(parent, np.arange(inner.size))
        made += key.size
        start = np.cumsum(size_next) - size_next
        first, size, own = at[start], size_next, centre_of[key]
    place = np.empty(parts * n, np.int64)
    place[order] = np.arange(parts * n)
    first, size, own, radius, child, children = (np.concatenate(c) for c in zip(*levels, strict=True))
    return Tree(points[order], order % n, first, first + size, place[own], radius, child, children)


def pack_tree(t: Tree) -> tuple[bytes, bytes, bytes, bytes]:
    """(points, rows, nodes, radii) as bytes."""
    nodes = np.stack([t.first, t.end, t.middle, t.child, t.children], axis=1)
    return t.points.astype("<i4").tobytes(), t.rows.astype("<i4").tobytes(), nodes.astype("<i4").tobytes(), t.radius.astype("<i8").tobytes()


def unpack_tree(width: int, points: bytes, rows: bytes, nodes: bytes, radii: bytes) -> Tree:
    def numbers(b: bytes) -> np.ndarray:
        return np.frombuffer(b, "<i4").astype(np.int64)

    first, end, middle, child, children = numbers(nodes).reshape(-1, 5).T
    return Tree(numbers(points).reshape(-1, width), numbers(rows), first, end, middle, np.frombuffer(radii, "<i8"), child, children)


class Assigned(NamedTuple):
    first: np.ndarray    # ranges of points
    end: np.ndarray
    entry: np.ndarray    # and the entry each goes to
    compared: int        # distances worked out


def _nearest(d: np.ndarray, entry: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least distance, its first entry) of each run of pairs."""
    least = np.minimum.reduceat(d, start)
    hits = np.flatnonzero(d == np.repeat(least, size))
    owner = np.repeat(np.arange(start.size), size)[hits]
    return least, entry[hits[np.flatnonzero(np.diff(owner, prepend=-1))]]


def assign(t: Tree, codebooks: np.ndarray) -> Assigned:
    """The nearest entry, ties to the lower, of every point; ``codebooks`` is (parts, entries, width)."""
    parts, k, _ = codebooks.shape
    rows = t.points.shape[0] // parts
    node, size = np.arange(parts), np.full(parts, k)
    entry = np.tile(np.arange(k), parts)
    out, compared = [], 0
    while node.size:
        start = np.cumsum(size) - size
        part = t.first[node] // rows
        d = _square(np.repeat(t.points[t.middle[node]], size, axis=0), codebooks[np.repeat(part, size), entry])
        compared += d.size
        least, best = _nearest(d, entry, start, size)
        reach = np.sqrt(least) + 2 * np.sqrt(t.radius[node])
        keep = np.sqrt(d) <= np.repeat(reach * (1 + 1e-9) + 1e-6, size)   # a margin for the roots' last bits
        kept = np.add.reduceat(keep.astype(np.int64), start)
        whole = (kept == 1) | (t.radius[node] == 0)
        out.append((t.first[node[whole]], t.end[node[whole]], best[whole]))
        # entries that go on, by node
        entry, at = entry[keep], np.cumsum(kept) - kept
        leaf = np.flatnonzero(~whole & (t.children[node] == 0))
        if leaf.size:
            point = _ranges(t.first[node[leaf]], t.end[node[leaf]] - t.first[node[leaf]])
            of = np.repeat(leaf, t.end[node[leaf]] - t.first[node[leaf]])
            among = entry[_ranges(at[of], kept[of])]
            d = _square(np.repeat(t.points[point], kept[of], axis=0), codebooks[np.repeat(point // rows, kept[of]), among])
            compared += d.size
            _, best = _nearest(d, among, np.cumsum(kept[of]) - kept[of], kept[of])
            out.append((point, point + 1, best))
        inner = np.flatnonzero(~whole & (t.children[node] > 0))
        of = np.repeat(inner, t.children[node[inner]])
        entry, size = entry[_ranges(at[of], kept[of])], kept[of]
        node = _ranges(t.child[node[inner]], t.children[node[inner]])
    first, end, entry = (np.concatenate(c) for c in zip(*out, strict=True))
    return Assigned(first, end, entry, compared)


def sums(t: Tree, found: Assigned, parts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sum, count) of the points of every entry: (parts, entries, width) and (parts, entries)."""
    width = t.points.shape[1]
    until = np.zeros((len(t.points) + 1, width), np.int64)
    np.cumsum(t.points, axis=0, out=until[1:])
    total, count = np.zeros((parts * k, width), np.int64), np.zeros(parts * k, np.int64)
    at = found.first // (len(t.points) // parts) * k + found.entry
    np.add.at(total, at, until[found.end] - until[found.first])
    np.add.at(count, at, found.end - found.first)
    return total.reshape(parts, k, width), count.reshape(parts, k)


def codes(t: Tree, found: Assigned, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry per row and part, squared distance per row)."""
    parts = codebooks.shape[0]
    rows = len(t.points) // parts
    size = found.end - found.first
    entry = np.empty(len(t.points), np.int64)
    entry[_ranges(found.first, size)] = np.repeat(found.entry, size)
    part = np.arange(len(t.points)) // rows
    error, code = np.zeros(rows, np.int64), np.empty((rows, parts), np.uint8)
    np.add.at(error, t.rows, _square(t.points, codebooks[part, entry]))
    code[t.rows, part] = entry
    return code, error


def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(np.clip(values.astype(np.float64) * scale, -LIMIT, LIMIT)).astype(np.int64)


def _finite(vector: str):
    """Rows whose vector is there and holds finite numbers only."""
    x = F.col(vector)
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False))


def first_entries(vectors: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray:
    """The codebooks to begin with: (parts, entries, width), from the vectors with the smallest ids."""
    usable = vectors.select("vec_id", "embedding").where(_finite("embedding") & (F.size("embedding") > 0)
                                                         & (F.size("embedding") % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    rows = usable.orderBy(*order).limit(entries).collect()   # this many vectors at most
    length = len(rows[0]["embedding"]) if rows else 0
    if any(len(r["embedding"]) != length for r in rows):
        rows = usable.where(F.size("embedding") == length).orderBy(*order).limit(entries).collect()
    x = np.array([r["embedding"] for r in rows], np.float64).reshape(len(rows), parts, length // parts)
    return _integers(x, scale).transpose(1, 0, 2)


def trees(vectors: DataFrame, parts: int, width: int, scale: int, tree_rows: int) -> DataFrame:
    """A row per block of vectors of ``parts * width`` components: their ids and labels, and the trees.
    Vectors of another length stand in blocks without trees."""
    id_type, label_type = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def block(rows: pa.Table, tree: tuple | None) -> pa.RecordBatch:
        def listed(name: str) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(name).combine_chunks())

        return pa.RecordBatch.from_arrays(
            [listed("vec_id"), listed("label"), *[pa.array([b], pa.binary()) for b in tree or [None] * 4]],
            names=["ids", "labels", "points", "rows", "nodes", "radii"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in in_batches(batches, tree_rows):
            fit = pc.equal(pc.list_value_length(held.column("embedding")), parts * width) if width else pa.array([False] * len(held))
            for ok in (True, False):
                rows = held.filter(fit if ok else pc.invert(fit))
                for at in range(0, rows.num_rows, tree_rows):
                    some = rows.slice(at, tree_rows)
                    tree = None
                    if ok:
                        flat = some.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
                        tree = pack_tree(build(_integers(flat, scale).reshape(some.num_rows, parts, width)))
                    yield block(some, tree)

    kept = vectors.where(_finite("embedding")).select("vec_id", "label", "embedding")
    made = kept.mapInArrow(run, f"ids array<{id_type}>, labels array<{label_type}>, points binary, rows binary, nodes binary, radii binary")
    # a block is a megabyte or so: small row groups keep writers and readers small
    return save(made, "trees", **{"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1",
                                  "parquet.block.size.row.check.min": "1"})


def next_entries(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """One of Lloyd's rounds: every entry becomes the floor of its points' mean, an unused one stays."""
    parts, k, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for b in batches:
            for r in b.to_pylist():
                t = unpack_tree(width, r["points"], r["rows"], r["nodes"], r["radii"])
                s, c = sums(t, assign(t, codebooks), parts, k)
                total += s
                count += c
        at = np.flatnonzero(np.repeat(count.ravel(), width))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total.ravel()[at]), pa.array(np.repeat(count.ravel(), width)[at])], names=["at", "total", "n"])

    told = (blocks.where("points is not null").select("points", "rows", "nodes", "radii")
            .mapInArrow(run, "at bigint, total bigint, n bigint")
            .groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow())  # a row per number of the codebooks
    out = codebooks.copy().ravel()
    at = told.column("at").to_numpy()
    out[at] = told.column("total").to_numpy() // told.column("n").to_numpy()
    return out.reshape(codebooks.shape)


def coded(blocks: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every vector (null code and error: a vector of another length)."""
    parts, _, width = codebooks.shape
    id_type, label_type = (blocks.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                one = b.slice(at, 1)
                ids, labels = one.column("ids").flatten(), one.column("labels").flatten()
                r = one.select(["points", "rows", "nodes", "radii"]).to_pylist()[0]
                if r["points"] is None:
                    code, error = pa.nulls(len(ids), pa.string()), pa.nulls(len(ids), pa.int64())
                else:
                    t = unpack_tree(width, r["points"], r["rows"], r["nodes"], r["radii"])
                    found, off = codes(t, assign(t, codebooks), codebooks)
                    text = found.tobytes().hex()
                    code = pa.array([text[k:k + 2 * parts] for k in range(0, len(text), 2 * parts)], pa.string())
                    error = pa.array(off)
                yield pa.RecordBatch.from_arrays([ids, labels, code, error], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"vec_id {id_type}, label {label_type}, code string, error bigint")


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all integers of the codebooks in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             tree_rows: int = TREE_ROWS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) for ``vectors(vec_id, embedding, label, ...)``, and the codebooks (parts, entries, width).

    Vectors that are null or hold null or non-finite components are left out.
    All codebooks are for the length of the vector with the smallest id whose
    length the parts divide; a vector of another length keeps its row, with a
    null code and error. Null ids come after all others, equal ids in the order
    of their vectors; repeated rows are rows like any other. Fewer than ``entries`` vectors
    make fewer entries; an empty table gives no rows and empty codebooks.
    Integers beyond +-2^25 are taken as that. Other columns are ignored.
    """
    codebooks = first_entries(vectors, parts, entries, scale)
    blocks = trees(vectors, parts, codebooks.shape[2], scale, tree_rows)
    if codebooks.size:
        for _ in range(rounds):
            codebooks = next_entries(blocks, codebooks)
    return save(coded(blocks, codebooks), "codes"), codebooks


def with_label_errors(codes_of: DataFrame) -> DataFrame:
    """vec_id, code, error and label_error, the errors summed over equal labels (nulls together)."""
    totals = codes_of.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = save(totals, "label_errors").withColumnRenamed("label", "of_label")
    if totals.count() <= BROADCAST_LABELS:
        totals = F.broadcast(totals)
    return (codes_of.join(totals, codes_of["label"].eqNullSafe(totals["of_label"]))
            .select("vec_id", "code", "error", "label_error"))
