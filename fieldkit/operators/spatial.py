"""Point-in-polygon join and origin–destination flows (JN-5, JN-4, MB-14).

Polygons: ``(admin_id, admin_name, rings array<array<struct<x,y>>>)``, each
ring closed (one that is not gets its last edge); holes and multi-part areas
are just more rings (even-odd rule across all rings of the area).

The join is an equi-join on cells of a quadtree over each polygon. Cells that
no edge meets are kept whole, as coarse as they come, and only if they lie
inside. Cells that edges meet are divided until they are small or hold few
edges; they carry those edges and no others. What a ray to the right meets
beyond the cell's own edges is told by one bit and a few heights: the parity of
the other edges to the right at the cell's lower side, and the heights in the
cell's row at which that parity turns. It turns only where an own edge ends
and its neighbour is no own edge, so there are at most two heights per edge and
the index is linear in the outline. Both are handed down the tree: a cell starts from its
parent's and adds what the edges left behind do. A point looks up its cell at
every level that the index has; there is no cross join. Points on an edge are
not *within* (same as a ``within`` predicate).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldkit.operators.joins import broadcast_if_small
from fieldkit.session import cut_lineage

DEFAULT_CELL_DEG = 0.01   # side of a cell of level 0; level k: 2^k times that
COARSEST, FINEST = 15, -10
CELL_EDGES = 32           # cells with more edges than this are divided below level 0 too
# estimated bytes under which the index is broadcast: a cell with its keys, and each of its edges and heights
BROADCAST_MAX_BYTES = 256 << 20
CELL_BYTES, EDGE_BYTES, TURN_BYTES = 140, 48, 8

# Point-in-polygon test in a cell with own edges e = (x1, y1, x2, y2), point (px, py): on one of
# them → not within; else within iff the ray to +x crosses an odd number of edges, own ones and others.
_ON_EDGE = ("exists(cell_edges, e -> (e.x2 - e.x1) * (py - e.y1) - (e.y2 - e.y1) * (px - e.x1) = 0 "
            "AND px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
            "AND py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))")
_CROSSINGS = ("size(filter(cell_edges, e -> ((e.y1 > py) <> (e.y2 > py)) "
              "AND px < (e.x2 - e.x1) * (py - e.y1) / (e.y2 - e.y1) + e.x1))")
_OTHERS = "cell_odd + size(filter(cell_turns, t -> t <= py))"
# cells without edges lie inside as a whole
WITHIN_SQL = f"cell_edges IS NULL OR (NOT {_ON_EDGE} AND ({_CROSSINGS} + {_OTHERS}) % 2 = 1)"


class Cell(NamedTuple):
    level: int
    gx: int
    gy: int
    edges: np.ndarray | None   # (n, 4), or None: inside as a whole
    odd: int                   # parity of the other edges to the right, at the cell's lower side
    turns: np.ndarray          # heights from which on it is the other way round


def ring_edges(rings: list[np.ndarray]) -> np.ndarray:
    """(n, 4) array of the edges x1, y1, x2, y2 of rings given as (points, 2) arrays."""
    parts = []
    for p in rings:
        if len(p) > 1:
            parts.append(np.hstack([p, np.roll(p, -1, axis=0)]))
    e = np.concatenate(parts) if parts else np.zeros((0, 4))
    return e[(e[:, 0] != e[:, 2]) | (e[:, 1] != e[:, 3])]


def _touching(e: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """Which edges meet the closed box: bounds overlap and its corners lie on both sides of the line."""
    near = ((np.minimum(e[:, 0], e[:, 2]) <= x1) & (np.maximum(e[:, 0], e[:, 2]) >= x0)
            & (np.minimum(e[:, 1], e[:, 3]) <= y1) & (np.maximum(e[:, 1], e[:, 3]) >= y0))
    dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
    side = [dx * (y - e[:, 1]) - dy * (x - e[:, 0]) for x in (x0, x1) for y in (y0, y1)]
    return near & (np.minimum.reduce(side) <= 0) & (np.maximum.reduce(side) >= 0)


def _odd_ones(v: np.ndarray) -> np.ndarray:
    """The values that occur an odd number of times."""
    values, n = np.unique(v, return_counts=True)
    return values[n % 2 == 1]


def quadtree(e: np.ndarray, g: float, cell_edges: int = CELL_EDGES) -> Iterator[Cell]:
    """The cells of a polygon with these edges."""
    if not len(e):
        return
    lo, hi = e.reshape(-1, 2).min(axis=0), e.reshape(-1, 2).max(axis=0)
    top = min(COARSEST, max(0, int(np.ceil(np.log2(max((hi - lo).max() / g, 1))))))
    side = g * 2.0**top
    none = np.zeros(0)
    # a cell to be, with its parent's edges, and the parity at the height ``base`` and the heights told above
    todo = [(top, i, j, np.arange(len(e)), 0, none) for i in range(int(np.floor(lo[0] / side)), int(np.floor(hi[0] / side)) + 1)
            for j in range(int(np.floor(lo[1] / side)), int(np.floor(hi[1] / side)) + 1)]
    while todo:
        level, i, j, held, odd, turns = todo.pop()
        side = g * 2.0**level
        x0, y0 = i * side, j * side
        eps = 1e-9 * max(side, abs(x0), abs(y0), abs(x0 + side), abs(y0 + side))   # the box is a hair wider
        middle, low, high = x0 + side / 2, y0 - eps, y0 + side + eps
        ours = _touching(e[held], x0 - eps, low, x0 + side + eps, high)
        own, left = held[ours], e[held[~ours]]
        # parity at the lower side: that of the parent's, turned at the heights between, and the edges left behind
        odd += np.count_nonzero(turns <= low)
        up = left[(left[:, 1] > low) != (left[:, 3] > low)]
        odd += np.count_nonzero((up[:, 2] - up[:, 0]) * (low - up[:, 1]) / (up[:, 3] - up[:, 1]) + up[:, 0] > middle)
        odd %= 2
        ends = left.reshape(-1, 2)
        ends = ends[(ends[:, 0] > middle) & (ends[:, 1] > low) & (ends[:, 1] <= high)]
        turns = _odd_ones(np.concatenate([turns[(turns > low) & (turns <= high)], ends[:, 1]]))
        if not own.size:
            if odd:
                yield Cell(level, i, j, None, 0, none)
        elif level > 0 or (own.size > cell_edges and level > FINEST):
            todo += [(level - 1, 2 * i + a, 2 * j + b, own, odd, turns) for a in (0, 1) for b in (0, 1)]
        else:
            yield Cell(level, i, j, e[own], odd, turns)


def polygon_cells(polygons: DataFrame, cell_deg: float = DEFAULT_CELL_DEG, cell_edges: int = CELL_EDGES) -> DataFrame:
    """Each polygon's quadtree cells: its columns but ``rings``, level, gx, gy, cell_edges (NULL: inside), cell_odd, cell_turns."""
    g = float(cell_deg)
    keep = [f for f in polygons.schema.fields if f.name != "rings"]
    names = [f.name for f in keep]
    sides = ["x1", "y1", "x2", "y2"]

    def rings_of(value: pa.Scalar) -> list[np.ndarray]:
        rings = [] if value.values is None else [r for r in value.values if r.values is not None]
        return [np.stack([r.values.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y")], axis=1) for r in rings]

    def listed(cells: list[Cell]) -> list[pa.Array]:
        inside = np.array([c.edges is None for c in cells])
        edges = np.concatenate([np.zeros((0, 4)), *[c.edges for c in cells if c.edges is not None]])
        at = np.concatenate([[0], np.cumsum([0 if c.edges is None else len(c.edges) for c in cells])])
        turned = np.concatenate([[0], np.cumsum([len(c.turns) for c in cells])])
        structs = pa.StructArray.from_arrays([pa.array(edges[:, k]) for k in range(4)], names=sides)
        return [pa.array([c.level for c in cells], pa.int32()), pa.array([c.gx for c in cells], pa.int64()),
                pa.array([c.gy for c in cells], pa.int64()),
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), structs, mask=pa.array(inside)),
                pa.array([c.odd for c in cells], pa.int32()),
                pa.ListArray.from_arrays(pa.array(turned, pa.int32()), pa.array(np.concatenate([np.zeros(0), *[c.turns for c in cells]])))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                found: list[Cell] = []
                cells = quadtree(ring_edges(rings_of(b.column("rings")[row])), g, cell_edges)
                for c in cells:
                    found.append(c)
                    if len(found) == 5000:
                        yield rows(b, row, found)
                        found = []
                if found:
                    yield rows(b, row, found)

    def rows(b: pa.RecordBatch, row: int, cells: list[Cell]) -> pa.RecordBatch:
        at = pa.array([row] * len(cells), pa.int64())
        return pa.RecordBatch.from_arrays([*[b.column(n).take(at) for n in names], *listed(cells)],
                                          names=[*names, "level", "gx", "gy", "cell_edges", "cell_odd", "cell_turns"])

    edge = T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in sides]))
    schema = T.StructType([*keep, T.StructField("level", T.IntegerType()), T.StructField("gx", T.LongType()),
                           T.StructField("gy", T.LongType()), T.StructField("cell_edges", edge),
                           T.StructField("cell_odd", T.IntegerType()), T.StructField("cell_turns", T.ArrayType(T.DoubleType()))])
    return polygons.where(F.col("rings").isNotNull()).mapInArrow(run, schema)


def indexed_polygons(polygons: DataFrame, cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """The polygon layer as cells, kept as a table, broadcast only while its estimated bytes stay under
    ``BROADCAST_MAX_BYTES``; otherwise left to a shuffle join."""
    cells = cut_lineage(polygon_cells(polygons, cell_deg))
    return broadcast_if_small(cells, BROADCAST_MAX_BYTES,
                              F.lit(CELL_BYTES) + EDGE_BYTES * F.coalesce(F.size("cell_edges"), F.lit(0))
                              + TURN_BYTES * F.size("cell_turns"))


def join_cells(points: DataFrame, cells: DataFrame, x: str = "x", y: str = "y",
               cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """Points × indexed polygons: equi-join on the cells of the index' levels, then the exact test."""
    g = float(cell_deg)
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())   # COARSEST - FINEST + 1 at most
    at = [F.struct(F.lit(k).alias("level"), F.floor(F.col(x) / F.lit(g * 2.0**k)).alias("gx"),
                   F.floor(F.col(y) / F.lit(g * 2.0**k)).alias("gy")) for k in levels]
    if not at:
        at = [F.struct(F.lit(0).alias("level"), F.lit(0).cast("bigint").alias("gx"), F.lit(0).cast("bigint").alias("gy"))]
    p = points.select("*", F.col(x).alias("px"), F.col(y).alias("py"), F.explode(F.array(*at)).alias("__at"))
    p = p.select("*", "__at.level", "__at.gx", "__at.gy").drop("__at")
    return (p.join(cells, ["level", "gx", "gy"]).where(F.expr(WITHIN_SQL))
            .drop("level", "gx", "gy", "px", "py", "cell_edges", "cell_odd", "cell_turns"))


def points_in_polygons(points: DataFrame, polygons: DataFrame, x: str = "x", y: str = "y",
                       cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """Inner spatial join: each point with every polygon it lies within."""
    return join_cells(points, indexed_polygons(polygons, cell_deg), x, y, cell_deg)


def od_attributes(trips: DataFrame, polygons: DataFrame, cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """Each trip with the admin area of its origin and of its destination
    (two lookups on the same trip row against one indexed layer; no
    self-join of origin and destination tables)."""
    cells = indexed_polygons(polygons.select("admin_id", "admin_name", "rings"), cell_deg)
    o = join_cells(trips, cells, "_ox", "_oy", cell_deg).withColumnsRenamed(
        {"admin_id": "admin_id_o", "admin_name": "admin_name_o"})
    return join_cells(o, cells, "_dx", "_dy", cell_deg).withColumnsRenamed(
        {"admin_id": "admin_id_d", "admin_name": "admin_name_d"})


def od_flows(od: DataFrame) -> DataFrame:
    """Trips per (origin area, destination area), keyed by id and name."""
    return (od.groupBy("admin_id_o", "admin_name_o", "admin_id_d", "admin_name_d")
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumn("agg_id", F.concat_ws(",", "admin_id_o", "admin_id_d")))


def od_outflows(od: DataFrame) -> DataFrame:
    return od.groupBy("admin_id_o", "admin_name_o").agg(F.count(F.lit(1)).alias("count"))


def od_inflows(od: DataFrame) -> DataFrame:
    return od.groupBy("admin_id_d", "admin_name_d").agg(F.count(F.lit(1)).alias("count"))
