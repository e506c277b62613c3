"""The polygon index against the plain even-odd rule."""

import numpy as np
import pytest

from fieldkit.operators import spatial as SP

SCHEMA = "admin_id string, admin_name string, rings array<array<struct<x:double,y:double>>>"


def within(edges, px, py):
    """The rule over all edges of a polygon."""
    x1, y1, x2, y2 = edges.T
    on = (((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) == 0) & (px >= np.minimum(x1, x2)) & (px <= np.maximum(x1, x2))
          & (py >= np.minimum(y1, y2)) & (py <= np.maximum(y1, y2)))
    up = (y1 > py) != (y2 > py)
    at = (x2[up] - x1[up]) * (py - y1[up]) / (y2[up] - y1[up]) + x1[up]
    return not on.any() and np.count_nonzero(px < at) % 2 == 1


def rings_of_kind(rng, kind):
    for _ in range(rng.integers(1, 4)):
        n = rng.integers(3, 40)
        if kind == "grid":        # corners on cell sides, edges along them, repeated points
            yield rng.integers(-6, 7, (n, 2)) * 0.25
        elif kind == "tangle":    # crosses itself
            yield rng.uniform(-2, 2, (n, 2))
        else:
            a = np.sort(rng.uniform(0, 2 * np.pi, n))
            yield np.stack([np.cos(a), np.sin(a)], 1) * rng.uniform(0.5, 2, (n, 1)) + rng.uniform(-1, 1, 2)


@pytest.mark.parametrize("kind", ["grid", "tangle", "star"])
@pytest.mark.parametrize("cell, cell_edges", [(0.5, 32), (0.25, 2), (0.3, 8)])
def test_points_in_polygons_equal_the_plain_rule(spark, kind, cell, cell_edges, monkeypatch):
    monkeypatch.setattr(SP, "CELL_EDGES", cell_edges)
    rng = np.random.default_rng(len(kind) + cell_edges)
    polygons = {f"P{k}": list(rings_of_kind(rng, kind)) for k in range(8)}
    corners = np.concatenate([r for rings in polygons.values() for r in rings])
    points = np.concatenate([rng.uniform(-2.5, 2.5, (150, 2)), rng.integers(-20, 21, (100, 2)) * 0.125, corners])
    listed = [(k, k, [[(float(x), float(y)) for x, y in np.vstack([r, r[:1]])] for r in rings]) for k, rings in polygons.items()]
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id long, x double, y double")
    polys = spark.createDataFrame(listed, SCHEMA)
    cells = SP.polygon_cells(polys, cell, cell_edges)
    got = {(r.id, r.admin_id) for r in SP.join_cells(df, cells, cell_deg=cell).select("id", "admin_id").collect()}
    edges = {k: SP.ring_edges(rings) for k, rings in polygons.items()}
    assert got == {(i, k) for i, (x, y) in enumerate(points) for k, e in edges.items() if within(e, x, y)}
    assert got


def wavy(n, waves):
    a = np.linspace(0, 2 * np.pi, n, endpoint=False)
    r = 1.5 + 0.05 * np.sin(waves * a)
    return np.stack([36 + r * np.cos(a), r * np.sin(a)], 1)


def test_edges_in_the_index_grow_with_the_outline(spark):
    """A ring of 100,000 edges: every edge stands in few cells, however many cells lie to its left."""
    rows = {}
    for n in (1_000, 10_000, 100_000):
        cells = [c for c in SP.quadtree(SP.ring_edges([wavy(n, 300)]), 0.01) if c.edges is not None]
        rows[n] = sum(len(c.edges) for c in cells)
        assert sum(len(c.turns) for c in cells) <= 2 * rows[n]
        assert max(len(c.edges) for c in cells) <= SP.CELL_EDGES
    assert rows[100_000] < 2 * 100_000
    assert rows[100_000] / rows[10_000] < 10


def test_a_large_ring_answers_like_the_rule(spark):
    ring = wavy(20_000, 300)
    polys = spark.createDataFrame([("W", "wavy", [[(float(x), float(y)) for x, y in np.vstack([ring, ring[:1]])]])], SCHEMA)
    points = np.random.default_rng(5).uniform([34.4, -1.6], [37.6, 1.6], (2_000, 2))
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id long, x double, y double")
    edges = SP.ring_edges([ring])
    got = {r.id for r in SP.points_in_polygons(df, polys).collect()}
    assert got == {i for i, (x, y) in enumerate(points) if within(edges, x, y)}


def test_polygons_without_an_area(spark):
    polys = spark.createDataFrame([("N", "no rings", None), ("E", "empty", []), ("R", "an empty ring", [[]]),
                                   ("P", "a point", [[(1.0, 1.0)]]), ("L", "a line", [[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]),
                                   ("O", "not closed", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]])], SCHEMA)
    df = spark.createDataFrame([(1, 0.5, 0.25), (2, 1.0, 1.0), (3, 0.5, 0.5), (4, None, 0.1)], "id long, x double, y double")
    assert [(r.id, r.admin_id) for r in SP.points_in_polygons(df, polys).collect()] == [(1, "O")]
    assert SP.points_in_polygons(df, polys.limit(0)).count() == 0
