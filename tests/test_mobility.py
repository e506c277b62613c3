"""Mobility operators on hand-built histories, plus a plain-Python second
implementation of both clustering folds compared on random histories."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from fieldkit.functions.geo import distance_km
from fieldkit.operators import mobility as MB

SCHEMA = "event_id long, user_id long, ts timestamp_ntz, site_id long, x double, y double"
A, B, C, D = (33.70, -14.0), (33.72, -14.0), (33.74, -14.0), (33.76, -14.0)


def pings(spark, rows):
    out = []
    for i, (u, t, (x, y)) in enumerate(rows):
        out.append((i, u, t, int(round((x - 33.7) / 0.004)), x, y))
    return spark.createDataFrame(out, SCHEMA)


def T(h, m=0, day=1):
    return dt.datetime(2024, 1, day, h, m)


def test_stay_time_and_single_trip(spark):
    p = pings(spark, [(1, T(8), A), (1, T(8, 10), B), (1, T(9), C)])
    st = MB.cluster_stay_time(MB.trip_clusters(p)).orderBy("clust_id").collect()
    assert [(r.stay_time, r.stop_or_stay) for r in st] == [(10, "stop"), (50, "OD"), (1440, "OD")]
    trips = MB.trips_from_pings(p).collect()
    assert [(t.o_clust, t.d_clust, t.trp_id) for t in trips] == [(2, 3, 1)]
    t = trips[0]
    assert t.start == T(8, 10) and t.end == T(9) and t.hr == 8
    assert t.dist == pytest.approx(distance_km(B[1], B[0], C[1], C[0]), abs=1e-6)


def test_two_adjacent_stops_are_both_dropped(spark):
    p = pings(spark, [(1, T(8), A), (1, T(9), B), (1, T(9, 5), C), (1, T(9, 10), D)])
    trips = MB.trips_from_pings(p).collect()
    assert [(t.o_clust, t.d_clust) for t in trips] == [(1, 4)]


def test_one_location_day(spark):
    p = pings(spark, [(1, T(8), A), (1, T(12), A), (1, T(18), A)])
    assert MB.trips_from_pings(p).count() == 0
    fd = MB.farthest_distance(p).collect()
    assert fd[0].n_locs == 1 and fd[0].max_dist == 0.0
    s = MB.user_mobility_summary(p).collect()[0]
    assert (s.usage_days, s.days_with_trips, s.mean_farthest) == (1, 0, 0.0)


def test_categorize_shares(spark):
    df = spark.createDataFrame([(0.6, 0.3, 0.1), (0.59, 0.3, 0.11), (0.5, 0.5, 0.0), (0.1, 0.2, 0.7)],
                               "prop_home double, prop_work double, prop_trst double")
    got = [r[0] for r in df.select(MB.categorize()).collect()]
    assert got == ["home", "ND", "ND", "trst"]


def test_only_work_found_serves_as_home(spark):
    lab = spark.createDataFrame([(1, 10, 5, "work"), (1, 11, 3, "ND"), (2, 20, 4, "home"), (2, 21, 9, "work")],
                                "user_id long, site_id long, total long, categ string")
    got = {r.user_id: (r.home, r.work) for r in MB.assign_home_work(lab, "site_id").collect()}
    assert got == {1: (10, 10), 2: (20, 21)}


# ------------------------------------------------ second implementation

def py_trip_fold(events, radius=1.0):
    """events: list of (ts, event_id, x, y) of one user-day."""
    clusters = []
    for t, _, x, y in sorted(events):
        if clusters:
            c = clusters[-1]
            if distance_km(c["sy"] / c["n"], c["sx"] / c["n"], y, x) <= radius:
                c["n"] += 1
                c["sx"] += x
                c["sy"] += y
                continue
        clusters.append({"n": 1, "sx": x, "sy": y})
    return [(c["n"], round(c["sx"] / c["n"], 6), round(c["sy"] / c["n"], 6)) for c in clusters]


def py_home_work_fold(events, radius=2.0):
    clusters = []
    for t, _, x, y in sorted(events):
        x, y = round(x * 1e8), round(y * 1e8)
        best, best_d = None, math.inf
        for c in clusters:
            d = math.floor(float(distance_km(c["sy"] / c["n"] / 1e8, c["sx"] / c["n"] / 1e8, y / 1e8, x / 1e8)) * 1e6 + 0.5)
            if d < best_d:
                best, best_d = c, d
        if best is not None and best_d <= radius * 1e6:
            best["n"] += 1
            best["sx"] += x
            best["sy"] += y
        else:
            clusters.append({"n": 1, "sx": x, "sy": y})
    half_up = lambda v: math.floor(v * 1e6 + 0.5) / 1e6
    return [(c["n"], half_up(c["sx"] / 1e8 / c["n"]), half_up(c["sy"] / 1e8 / c["n"])) for c in clusters]


def random_history(seed, users=6, per_user=60):
    rnd = random.Random(seed)
    rows = []
    for u in range(users):
        for _ in range(per_user):
            day = rnd.randint(1, 3)
            t = dt.datetime(2024, 1, day, rnd.randint(0, 23), rnd.randint(0, 59), rnd.randint(0, 59))
            s = rnd.randint(0, 99)
            rows.append((u, t, (33.7 + (s % 10) * 0.004 * 3, -14.0 + (s // 10) * 0.004 * 3)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trip_fold_matches_plain_python(spark, seed):
    rows = random_history(seed)
    p = pings(spark, rows)
    got = {}
    for r in MB.trip_clusters(p).collect():
        got.setdefault((r.user_id, r.day), []).append((r.clust_id, r.visit_freq, round(r.cx, 6), round(r.cy, 6)))
    groups = {}
    for i, (u, t, (x, y)) in enumerate(rows):
        groups.setdefault((u, t.date()), []).append((t, i, x, y))
    for k, ev in groups.items():
        exp = py_trip_fold(ev)
        assert [g[1:] for g in sorted(got[k])] == exp
    # clusters conserve events
    assert sum(len(v) for v in groups.values()) == sum(c[1] for v in got.values() for c in v)


def test_home_work_fold_matches_plain_python(spark):
    rows = random_history(3)
    p = pings(spark, rows)
    got = {}
    for r in MB.home_work_clusters(p).collect():
        got.setdefault(r.user_id, []).append((r.clust_id, r.visit_freq, r.x, r.y))
    users = {}
    for i, (u, t, (x, y)) in enumerate(rows):
        users.setdefault(u, []).append((t, i, x, y))
    for u, ev in users.items():
        assert [g[1:] for g in sorted(got[u])] == py_home_work_fold(ev)


def test_home_work_fold_grid_index_is_exact(spark):
    """Users with hundreds of clusters (grid-indexed nearest search), one near
    the date line and one near a pole (fallback paths) equal the plain fold."""
    rnd = random.Random(17)
    rows = []
    for u, (x0, y0, span) in enumerate([(33.0, -14.0, 1.5), (179.4, 10.0, 1.0), (20.0, 88.5, 0.8)]):
        for _ in range(900 if u == 0 else 300):
            t = dt.datetime(2024, 1, rnd.randint(1, 28), rnd.randint(0, 23), rnd.randint(0, 59), rnd.randint(0, 59))
            x = x0 + rnd.random() * span if u != 1 else min(179.999, x0 + rnd.random() * span)
            rows.append((u, t, (x, y0 + rnd.random() * span)))
    p = pings(spark, rows)
    got = {}
    for r in MB.home_work_clusters(p).collect():
        got.setdefault(r.user_id, []).append((r.clust_id, r.visit_freq, r.x, r.y))
    users = {}
    for i, (u, t, (x, y)) in enumerate(rows):
        users.setdefault(u, []).append((t, i, x, y))
    assert len(got[0]) > 100  # the grid path is exercised
    for u, ev in users.items():
        assert [g[1:] for g in sorted(got[u])] == py_home_work_fold(ev)


def test_home_work_counts_skip_excluded_days(spark):
    # 2024-01-06 is a Saturday: counted in visit_freq, not in home/work
    p = pings(spark, [(1, dt.datetime(2024, 1, 5, 22), A), (1, dt.datetime(2024, 1, 6, 22), A),
                      (1, dt.datetime(2024, 1, 5, 9), A)])
    r = MB.home_work_clusters(p).collect()[0]
    assert (r.visit_freq, r.home, r.work, r.transit) == (3, 1, 1, 0)


def test_result_independent_of_partitioning(spark):
    rows = random_history(5)
    base = None
    for n in (1, 4, 16):
        p = pings(spark, rows).repartition(n)
        got = sorted(tuple(r) for r in MB.trips_from_pings(p).drop("_ox", "_oy", "_dx", "_dy").collect())
        base = base or got
        assert got == base


def test_consistent_users_dense_minimum(spark):
    rows = [(1, T(h, 0, d), A) for d in (1, 2) for h in range(6)] + [(2, T(h, 0, 1), A) for h in range(6)]
    got = {r.user_id: (r.min_events, r.consistent) for r in MB.consistent_users(pings(spark, rows), 5).collect()}
    assert got == {1: (6, True), 2: (0, False)}


def test_haversine_munich_berlin(spark):
    from fieldkit.functions.geo import haversine
    v = spark.range(1).select(haversine(F.lit(48.1372), F.lit(11.5756), F.lit(52.5186), F.lit(13.4083))).first()[0]
    assert round(v, 1) == 504.2
    assert round(distance_km(48.1372, 11.5756, 52.5186, 13.4083), 1) == 504.2
    assert math.isclose(v, distance_km(48.1372, 11.5756, 52.5186, 13.4083), rel_tol=1e-12)


def test_pipeline_properties_on_test_data(spark):
    """SURVEY §5 properties on sf0.001: clusters conserve events, stays are
    ≥ 0 except the sentinel, trips per day = OD clusters − 1, flows balance."""
    from fieldkit.operators import spatial as SP
    from fieldkit.sources import fixtures as FX
    p = FX.pings(spark, "/root/testdata/sf0.001")
    cl = MB.trip_clusters(p)
    assert cl.agg(F.sum("visit_freq")).first()[0] == p.count()
    st = MB.cluster_stay_time(cl)
    assert st.where("stay_time < 0").count() == 0
    od_per_day = st.where("stop_or_stay = 'OD'").groupBy("user_id", "day").count()
    tr = MB.trips(st)
    per_day = tr.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"))
    bad = (od_per_day.join(per_day, ["user_id", "day"], "left")
           .where(F.coalesce("n", F.lit(0)) != F.col("count") - 1).count())
    assert bad == 0
    od = SP.od_attributes(tr, FX.admin_polygons(spark))
    total = od.count()
    assert SP.od_flows(od).agg(F.sum("count")).first()[0] == total
    assert SP.od_outflows(od).agg(F.sum("count")).first()[0] == total
    assert SP.od_inflows(od).agg(F.sum("count")).first()[0] == total


def test_farthest_pair_of_many_points(spark):
    """Clustered, collinear and random days, and one of 100,000 points, against all pairs of the hull's candidates."""
    import numpy as np
    rng = np.random.default_rng(8)
    big = np.column_stack([rng.normal(30, 2, 100_000), rng.normal(-10, 1.5, 100_000)])
    days = {1: rng.uniform(-0.01, 0.01, (300, 2)) + [33.7, -14.0], 2: np.column_stack([np.linspace(10, 12, 200), np.full(200, 50.0)]),
            3: np.vstack([rng.normal(0, .01, (150, 2)), rng.normal(0, .01, (150, 2)) + [5, 5]]), 4: np.array([[1.0, 2.0]]),
            5: rng.uniform([-180, -85], [180, 85], (300, 2)), 6: big}
    rows = [(i, u, T(0), 0, float(x), float(y)) for u, pts in days.items() for i, (x, y) in enumerate(pts)]
    got = {r.user_id: (r.n_locs, r.max_dist) for r in MB.farthest_distance(spark.createDataFrame(rows, SCHEMA)).collect()}
    for u, pts in days.items():
        far = pts
        if len(pts) > 1000:   # the farthest pair are points extreme in some direction
            turn = np.radians(np.arange(0, 360, 0.25))
            far = pts[np.unique(np.argmax((pts - pts.mean(axis=0)) @ np.array([np.cos(turn), np.sin(turn)]), axis=0))]
        want = max(float(distance_km(far[:, 1], far[:, 0], y, x).max()) for x, y in far)
        assert got[u][0] == len(np.unique(pts, axis=0))
        assert got[u][1] >= want - 1e-6 and (len(pts) > 1000 or abs(got[u][1] - want) < 1e-6)


def test_haversine_at_antipodes(spark):
    """Nearly opposite points: half the circumference, neither NaN nor an error, in columns and arrays."""
    from fieldkit.functions.geo import haversine
    rnd = random.Random(4)
    pts = [(rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for _ in range(3000)]
    rows = [(a, b, -a, b - 180 if b > 0 else b + 180) for a, b in pts]
    half = math.pi * 6371.0
    got = spark.createDataFrame(rows, "a double, b double, c double, d double").select(haversine("a", "b", "c", "d")).collect()
    assert all(abs(r[0] - half) < 1e-3 for r in got)
    cols = list(zip(*rows))
    assert all(abs(v - half) < 1e-3 for v in distance_km(*cols))


def test_consistent_users_ignore_events_without_a_time(spark):
    rows = [(1, T(h, 0, d), A) for d in (1, 3) for h in range(6)] + [(1, None, A)] * 6 + [(2, T(h, 0, d), A) for d in (1, 2, 3) for h in range(6)]
    got = {r.user_id: (r.min_events, r.consistent) for r in MB.consistent_users(pings(spark, rows), 5).collect()}
    assert got == {1: (0, False), 2: (6, True)}


def test_home_work_radius_beyond_a_thousand_km(spark):
    p = pings(spark, [(1, T(8), (0.0, 0.0)), (1, T(9), (12.0, 0.0)), (1, T(10), (60.0, 0.0))])
    got = sorted((r.clust_id, r.visit_freq) for r in MB.home_work_clusters(p, radius_km=1500.0).collect())
    assert got == [(1, 2), (2, 1)]


def test_home_work_hot_user_is_split_by_place(spark):
    """A user over several far-apart places: as many groups as places, and the plain fold's clusters."""
    from fieldkit.operators.clustering import place_groups, placed_events
    rnd = random.Random(9)
    rows = []
    for i in range(1500):
        cx, cy = rnd.choice([(10.0, 50.0), (14.0, 50.0), (33.0, -14.0), (34.5, -15.0)])
        rows.append((1, dt.datetime(2024, 1, rnd.randint(1, 28), rnd.randint(0, 23), rnd.randint(0, 59)),
                     (cx + rnd.uniform(-0.2, 0.2), cy + rnd.uniform(-0.2, 0.2))))
    p = pings(spark, rows)
    assert place_groups(placed_events(p), 2.0).select("grp").distinct().count() >= 4
    got = sorted((r.clust_id, r.visit_freq, r.x, r.y) for r in MB.home_work_clusters(p).collect())
    assert [g[1:] for g in got] == py_home_work_fold([(t, i, x, y) for i, (_, t, (x, y)) in enumerate(rows)])


@pytest.mark.parametrize("seed", [3, 4])
def test_narrow_places_are_summed_up(spark, seed):
    """Places about as wide as the radius, one site with most events, the poles and the date line: summing up equals the fold."""
    from fieldkit.operators.clustering import _box, _cell_groups, _with_cells, home_work_clusters_raw, placed_events
    rnd = random.Random(seed)
    rows = []
    for user in range(1, 9):
        places = [(rnd.uniform(-60, 60), rnd.uniform(-60, 60), rnd.choice([0.0, 0.004, 0.009, 0.0125, 0.02])) for _ in range(6)]
        places += [(179.999, 10.0, 0.004), (20.0, 89.9, 0.01)] if user == 8 else []
        for _ in range(400):
            cx, cy, wide = places[0] if rnd.random() < 0.5 else rnd.choice(places)
            rows.append((user, dt.datetime(2024, 1, rnd.randint(1, 28), rnd.randint(0, 23), rnd.randint(0, 59)),
                         (cx + rnd.uniform(-wide, wide), min(90.0, cy + rnd.uniform(-wide, wide)))))
    p = pings(spark, rows)
    cells = _with_cells(placed_events(p), 2.0).groupBy("user_id", "cx", "cy").agg(*_box())
    assert {r.narrow for r in _cell_groups(cells, 2.0).collect()} == {True, False}
    one, other = (sorted(tuple(r) for r in home_work_clusters_raw(p, sum_narrow=s).collect()) for s in (True, False))
    assert one == other


def test_widest_distance_of_a_box():
    import numpy as np
    from fieldkit.operators.clustering import _widest_km
    rng = np.random.default_rng(2)
    lo, size = rng.uniform([-180, -90], [170, 80], (200, 2)), rng.uniform(0, 10, (200, 2))
    most = _widest_km(lo[:, 0], lo[:, 0] + size[:, 0], lo[:, 1], lo[:, 1] + size[:, 1])
    for _ in range(300):
        (x1, y1), (x2, y2) = ((lo + rng.uniform(0, 1, (200, 2)) * size).T for _ in range(2))
        assert (distance_km(y1, x1, y2, x2) <= most + 1e-9).all()


def test_trips_independent_of_session_time_zone(spark):
    """Wall-clock (NTZ) events around a DST gap give the same clusters, stays
    and trips whatever the session time zone."""
    rows = [(1, dt.datetime(2024, 3, 10, 1, 50), A), (1, dt.datetime(2024, 3, 10, 2, 30), B),
            (1, dt.datetime(2024, 3, 10, 2, 40), C), (1, dt.datetime(2024, 3, 10, 3, 40), D)]
    p = pings(spark, rows)
    base = sorted(tuple(r) for r in MB.cluster_stay_time(MB.trip_clusters(p)).drop("hours").collect())
    trips = sorted(tuple(r) for r in MB.trips_from_pings(p).collect())
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ny = sorted(tuple(r) for r in MB.cluster_stay_time(MB.trip_clusters(p)).drop("hours").collect())
        ny_trips = sorted(tuple(r) for r in MB.trips_from_pings(p).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ny == base and ny_trips == trips
    assert [r[-2] for r in base] == [40, 10, 60, 1440]  # stay minutes across the gap


@pytest.mark.parametrize("seed", [7, 8])
def test_in_fold_stays_and_trips_equal_window_steps(spark, seed):
    """The fold's own stay/trip pairing equals the window-based operators."""
    p = pings(spark, random_history(seed, users=8, per_user=80))
    cl = MB.trip_clusters(p, split_hot=False)
    win_st = sorted(tuple(r) for r in MB.cluster_stay_time(cl).drop("hours").collect())
    fold_st = sorted(tuple(r) for r in MB.cluster_stays(p, split_hot=False)
                     .select(*MB.cluster_stay_time(cl).drop("hours").columns).collect())
    assert fold_st == win_st
    win = sorted(tuple(r) for r in MB.trips(MB.cluster_stay_time(cl)).collect())
    fold = sorted(tuple(r) for r in MB.trips_from_pings(p, split_hot=False).collect())
    assert len(fold) > 50 and fold == win


@pytest.mark.parametrize("users,each", [(60, 50), (1, 3000)])
def test_home_work_fold_steps_over_arrays(monkeypatch, users, each):
    """Many short histories, and a long one over several batches: the plain fold's clusters, without a distance call per event."""
    import pyarrow as pa
    from fieldkit.operators import clustering as CL
    calls = []
    monkeypatch.setattr(CL, "distance_km", lambda *a: calls.append(1) or distance_km(*a))
    rnd = random.Random(users)
    rows = [(u, t, t, round(33.7e8 + rnd.randrange(10) * 4e5), round(-14e8 + rnd.randrange(10) * 4e5), t % 3)
            for u in range(users) for t in range(each)]
    cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
    flags = [pa.array([int(r[5] == k) for r in rows], pa.int32()) for k in range(3)]
    batch = pa.RecordBatch.from_arrays(
        [cols[0], pa.array([0] * len(rows), pa.int64()), *cols[1:], *flags],
        names=["user_id", "grp", "t_us", "event_id", "xi", "yi", "home", "work", "transit"])
    cuts = [batch.slice(k, 1510) for k in range(0, len(rows), 1510)]
    got = [r for b in CL._home_work_fold(2.0)(iter(cuts)) for r in b.to_pylist()]
    half_up = lambda v: math.floor(v * 1e6 + 0.5) / 1e6
    for u in range(users):
        mine = [r for r in got if r["user_id"] == u]
        assert [r["nth"] for r in mine] == list(range(1, len(mine) + 1))
        assert [(r["visit_freq"], half_up(r["sx"] / 1e8 / r["visit_freq"]), half_up(r["sy"] / 1e8 / r["visit_freq"])) for r in mine] \
            == py_home_work_fold([(t, i, x / 1e8, y / 1e8) for (w, t, i, x, y, _) in rows if w == u])
        assert sum(r["home"] + r["work"] + r["transit"] for r in mine) == each
        assert all((r["first_us"], r["first_id"]) in {(t, i) for (w, t, i, *_) in rows if w == u} for r in mine)
    assert len(calls) < len(rows) / 4


def test_cell_groups_take_many_users_at_once(spark, monkeypatch):
    """One call per batch for the width of places, not one per user; a user over two batches is one."""
    from fieldkit.operators import clustering as CL
    rows = [(u, T(8 + k), (10.0 + u % 7 + 0.15 * k, 20.0)) for u in range(40) for k in range(3)]
    cells = CL._with_cells(CL.placed_events(pings(spark, rows)), 2.0).groupBy("user_id", "cx", "cy").agg(*CL._box())
    frames = []
    monkeypatch.setattr(CL, "_widest_km", lambda *a, f=CL._widest_km: frames.append(len(a[0])) or f(*a))

    class Caught:
        def __getattr__(self, name):
            return lambda *a, **k: a[0] if name == "mapInPandas" else self
    run = CL._cell_groups(Caught(), 2.0)
    pdf = cells.toPandas().sort_values("user_id", ignore_index=True)
    out = [f for k in (50, 64) for f in run(iter([pdf.iloc[:k], pdf.iloc[k:]]))]
    assert len(frames) <= 6 and sum(len(f) for f in out) == 2 * len(pdf)
    both = [f[["user_id", "grp"]].drop_duplicates().groupby("user_id").size().sum() for f in out]
    assert sum(both) == 2 * 40   # neighbouring cells, one group per user
