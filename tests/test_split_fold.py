"""The range-split trip fold must equal the one-task-per-user-day fold,
including hot user-days cut across many chunks, a stationary hot user (one
cluster spanning every chunk: the no-resynchronisation chain) and users
whose chunks resynchronise at once."""

import datetime as dt
import random

import pytest

from fieldkit.operators import mobility as MB

SCHEMA = "event_id long, user_id long, ts timestamp_ntz, site_id long, x double, y double"


def hot_history(seed: int):
    rnd = random.Random(seed)
    rows, eid = [], 0
    t0 = dt.datetime(2024, 1, 1)
    # user 1: walker, 1500 events on one day, moves between far-apart sites
    for i in range(1500):
        s = rnd.choice([0, 0, 0, 1, 2, 9, 90, 99]) if rnd.random() < 0.3 else rnd.randint(0, 99)
        rows.append((eid, 1, t0 + dt.timedelta(seconds=i * 50 + rnd.randint(0, 10)), s,
                     33.7 + (s % 10) * 0.004 * 4, -14.0 + (s // 10) * 0.004 * 4))
        eid += 1
    # user 2: stationary hot user (within 1 km all day)
    for i in range(1200):
        s = rnd.randint(0, 1)
        rows.append((eid, 2, t0 + dt.timedelta(seconds=i * 60), s, 33.7 + s * 0.001, -14.0))
        eid += 1
    # users 3..20: small random days
    for u in range(3, 21):
        for i in range(30):
            s = rnd.randint(0, 99)
            rows.append((eid, u, t0 + dt.timedelta(days=rnd.randint(0, 2), seconds=rnd.randint(0, 86399)), s,
                         33.7 + (s % 10) * 0.004 * 3, -14.0 + (s // 10) * 0.004 * 3))
            eid += 1
    return rows


def norm(df):
    return sorted((r.user_id, r.day, r.clust_id, r.visit_freq, r.first_visit, r.last_visit, tuple(r.hours),
                   r.cx, r.cy) for r in df.collect())


@pytest.mark.parametrize("parts", [2, 3, 7, 16])
def test_split_fold_equals_stream_fold(spark, parts):
    p = spark.createDataFrame(hot_history(11), SCHEMA)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        split = norm(MB.trip_clusters(p, split_hot=True))
        stream = norm(MB.trip_clusters(p, split_hot=False))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(split) == len(stream)
    assert split == stream
    # the stationary user stays one cluster across all chunks
    assert sum(1 for r in split if r[0] == 2) == 1


def drifting_history(seed: int):
    """Days that hover about the radius, so that folds from different starts meet late, or only from some starts."""
    rnd = random.Random(seed)
    rows, eid = [], 0
    for user in range(1, 5):
        x = y = 0.0
        for i in range(600):
            step = rnd.choice([0.0002, 0.002, 0.006, 0.009])
            x = max(-0.01, min(0.01, x + rnd.uniform(-step, step)))
            y = max(-0.004, min(0.004, y + rnd.uniform(-step, step)))
            rows.append((eid, user, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * 120 + user), 0, 33.7 + x, -14.0 + y))
            eid += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("parts", [5, 40, 150])
def test_split_fold_of_drifting_days(spark, seed, parts):
    """Equal to the stream to the bit; rounds end, with fewer chunks each time."""
    from fieldkit.operators.clustering import placed_events, with_times
    from fieldkit.operators.split_fold import trip_clusters_split
    p = spark.createDataFrame(drifting_history(seed), SCHEMA)
    trace: list = []
    split = norm(with_times(trip_clusters_split(placed_events(p), 1.0, parts, trace), "hours"))
    assert split == norm(MB.trip_clusters(p, split_hot=False))
    assert len(trace) >= (2 if parts == 150 else 1)
    assert trace[0] <= parts and sorted(trace, reverse=True) == trace


def test_a_chunk_that_meets_again_hands_on_its_speculative_end(spark):
    """First folded from a wrong cluster it never met, then from the true one it does."""
    from fieldkit.operators import split_fold as SF
    wrong, right = (3, 30, 30), (5, 50, 50)
    state = spark.createDataFrame([(1, 0, 4, 3, right, wrong, wrong)], "user_id bigint, d int, part int, before int, "
                                  f"speculative {SF._OPEN}, carry {SF._OPEN}, used {SF._OPEN}")
    met = spark.createDataFrame([(1, 0, 3, 2, None, None, None, 4, None, None)], SF._PIECE)
    row = SF._next_state(state, met).first()
    assert tuple(row.carry) == right and tuple(row.used) == wrong
    never = spark.createDataFrame([(1, 0, 3, -1, None, 70, 71, 4, 7, None)], SF._PIECE)
    assert tuple(SF._next_state(state, never).first().carry) == (7, 70, 71)
    other = spark.createDataFrame([(1, 0, 9, -1, None, 70, 71, 4, 7, None)], SF._PIECE)
    assert tuple(SF._next_state(state, other).first().carry) == wrong


def test_hot_group_detection(spark):
    from fieldkit.operators.clustering import has_hot_groups
    p = spark.createDataFrame(hot_history(5), SCHEMA).selectExpr("user_id", "to_date(ts) AS day")
    assert has_hot_groups(p, ["user_id", "day"], fraction=1.0, min_sampled=100, n_tasks=16)
    assert not has_hot_groups(p.where("user_id > 2"), ["user_id", "day"], fraction=1.0, min_sampled=100, n_tasks=16)


@pytest.mark.parametrize("parts", [4, 13])
def test_chunked_trips_equal_window_trips(spark, parts):
    p = spark.createDataFrame(hot_history(21), SCHEMA)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        a = sorted(tuple(r) for r in MB.trips_from_pings(p, split_hot=True).collect())
        b = sorted(tuple(r) for r in MB.trips_from_pings(p, split_hot=False).collect())
        cl = MB.trip_clusters(p, split_hot=False)
        pa = sorted(tuple(r) for r in MB.consecutive_pairs(cl, chunked=True).collect())
        pb = sorted(tuple(r) for r in MB.consecutive_pairs(cl, chunked=False).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(a) > 100 and a == b
    assert pa == pb


def test_sequence_helpers_chunked_equal_plain(spark):
    import random as _r
    from fieldkit.operators.sequence import with_next, with_row_number
    rnd = _r.Random(3)
    rows = [(1 if rnd.random() < 0.7 else rnd.randint(2, 9), i, rnd.random()) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, o long, v double")
    for chunked in (False, True):
        got = sorted(tuple(r) for r in with_next(df, ["k"], ["o"], ["o", "v"], "n_", chunked, n_chunks=11).collect())
        rn = sorted(tuple(r) for r in with_row_number(df, ["k"], ["o"], "rn", chunked, n_chunks=11).collect())
        if not chunked:
            base, base_rn = got, rn
    assert got == base and rn == base_rn
