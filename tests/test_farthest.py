"""The farthest pair of a user-day by branch and bound, against all pairs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldkit.functions.geo import distance_km
from fieldkit.operators import mobility as MB

DAY = dt.date(2020, 1, 1)
SCHEMA = "user_id long, day date, x double, y double"


def frame(spark, days):
    return spark.createDataFrame([(u, DAY, float(x), float(y)) for u, pts in days.items() for x, y in np.unique(pts, axis=0)], SCHEMA)


def farthest(pts):
    pts = np.unique(pts, axis=0)
    return max(float(distance_km(y, x, pts[:, 1], pts[:, 0]).max()) for x, y in pts)


def check(spark, days, **kw):
    got = {r.user_id: (r.n_locs, r.max_dist) for r in MB.farthest_distance(None, frame(spark, days), **kw).collect()}
    assert {u: n for u, (n, _) in got.items()} == {u: len(np.unique(p, axis=0)) for u, p in days.items()}
    for u, pts in days.items():
        assert got[u][1] == pytest.approx(farthest(pts), abs=2e-7), u


def shapes():
    rng = np.random.default_rng(0)
    a = np.linspace(0, 2 * np.pi, 700, endpoint=False)
    spread = rng.normal(size=(400, 2))
    return {
        1: rng.uniform(-170, 170, (300, 2)) * [1, 0.5],                       # all over the world
        2: np.stack([36 + np.cos(a), np.sin(a)], 1),                          # a circle: nearly equal diameters
        3: np.concatenate([spread * 0.01 + [10, 50], spread * 0.01 + [11, 50.5]]),   # two far groups
        4: rng.integers(0, 12, (500, 2)) * 0.1,                               # a lattice: many equal distances
        5: np.array([[179.9, 10], [-179.9, 10.1], [170, -10], [0, 0]]),       # over the date line
        6: np.array([[0, 89.9], [180, 89.9], [90, -89.9], [-90, 80]]),        # around the poles
        7: np.array([[5.0, 5.0]]), 8: np.array([[5.0, 5.0], [5.0, 5.0 + 1e-9]]),
        9: np.concatenate([[[0.0, 0.0]], 1e-9 * rng.integers(0, 40, (60, 2)) + [3, 3]]),   # far closer than a finest cell
        10: np.stack([np.linspace(0, 1, 500), np.zeros(500)], 1),             # a line
        11: np.stack([np.zeros(50), np.linspace(0, 1, 50)], 1),
    }


def test_shapes(spark):
    check(spark, shapes())


@pytest.mark.parametrize("grid, levels", [(2, 3), (3, 1), (4, 2)])
def test_coarse_levels_end_with_locations_one_by_one(spark, monkeypatch, grid, levels):
    monkeypatch.setattr(MB, "GRID", grid)
    monkeypatch.setattr(MB, "LEVELS", levels)
    check(spark, shapes())


def test_few_pairs_of_many_locations(spark):
    """A million locations in two far places: 2.5e11 pairs across, of which next to none are looked at."""
    n = 1_000_000
    locs = spark.range(n).select(
        F.lit(1).cast("long").alias("user_id"), F.lit(DAY).alias("day"),
        (F.when(F.col("id") % 2 == 0, 10.0).otherwise(11.0) + F.randn(1) * 0.02).alias("x"),
        (F.when(F.col("id") % 2 == 0, 50.0).otherwise(50.5) + F.randn(2) * 0.02).alias("y"))
    locs = locs.checkpoint()
    trace: list = []
    got = MB.farthest_distance(None, locs, trace=trace).first()
    assert got.n_locs == n
    assert 0 < sum(trace) < 1_000_000
    # only locations extreme in some direction can be in the farthest pair
    turns = [F.max_by(F.struct("x", "y"), F.col("x") * float(np.cos(a)) + F.col("y") * float(np.sin(a))).alias(f"e{k}")
             for k, a in enumerate(np.linspace(0, 2 * np.pi, 180))]
    extreme = np.array(list({tuple(p) for p in locs.agg(*turns).first()}))
    assert got.max_dist == pytest.approx(farthest(extreme), abs=1e-3)


def test_no_locations(spark):
    assert MB.farthest_distance(None, spark.createDataFrame([], SCHEMA)).collect() == []
