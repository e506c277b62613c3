"""Order-dependent location clustering (WN-4, WN-5).

Both folds are sequential by definition: each event's cluster depends on the
clusters built from all earlier events of the same user(-day). Spark
partitions a narrow projection by the group key and sorts it; a function over
Arrow batches walks the sorted stream. It works on arrays: events of many
short days step together, a long day is searched in blocks for the next event
beyond the radius. Only the open cluster is carried from batch to batch, so
memory is bounded however long a day is.

Coordinates travel as integers of 1e-8 degree (about 1 mm). Their sums are
exact, so a cluster's centre is the same whichever way a day is cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

import fieldkit
from fieldkit.functions.geo import distance_km
from fieldkit.params import (EARTH_RADIUS_KM, EXCLUDED_DAYS, HOME_HOURS, HOME_WORK_RADIUS_KM, LAST_STAY_MIN,
                             STAY_THRESHOLD_MIN, TRANSIT_HOURS, TRIP_RADIUS_KM, WORK_HOURS)
from fieldkit.session import cut_lineage

# The fold helpers travel with the task (pickled by value), so Python
# workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(fieldkit)

UNIT = 1e8   # integers per degree
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
PLACED = "user_id IS NOT NULL AND ts IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL"
TOGETHER = 64   # days of up to so many events step together; longer ones are searched in blocks


def to_micros(ts: str = "ts") -> F.Column:
    """NTZ timestamp → microseconds since 1970-01-01, from its wall-clock
    fields only: no session time zone is involved (``timestampdiff`` would
    pass through the session zone and shift times inside a DST gap)."""
    return F.expr(f"CAST(unix_date(to_date({ts})) AS BIGINT) * 86400000000"
                  f" + CAST(hour({ts}) AS BIGINT) * 3600000000 + CAST(minute({ts}) AS BIGINT) * 60000000"
                  f" + CAST(extract(SECOND FROM {ts}) * 1000000 AS BIGINT)")


def from_micros(col: str) -> F.Column:
    """Microseconds since 1970-01-01 → NTZ timestamp."""
    return F.expr(f"timestampadd(MICROSECOND, {col}, {EPOCH_NTZ})")


def placed_events(pings: DataFrame) -> DataFrame:
    """Events with a user, a time and a place, as integers: user_id, d, t_us, event_id, xi, yi, hr."""
    at = lambda c: F.round(F.col(c) * F.lit(UNIT)).cast("bigint")
    return pings.where(PLACED).select("user_id", F.unix_date(F.to_date("ts")).alias("d"), to_micros("ts").alias("t_us"),
                                      "event_id", at("x").alias("xi"), at("y").alias("yi"), F.hour("ts").alias("hr"))


# ------------------------------------------------------------------ the leader rule on arrays

class Open:
    """The open cluster: members, sum of x, sum of y."""

    __slots__ = ("n", "sx", "sy")

    def __init__(self, n: int = 0, sx: int = 0, sy: int = 0):
        self.n, self.sx, self.sy = n, sx, sy


def _search(x: np.ndarray, y: np.ndarray, at: int, end: int, state: Open, radius: float, opens: np.ndarray) -> None:
    """Mark the events in [at, end) that open a cluster; ``state`` is the cluster open before, and after."""
    size = 16
    while at < end:
        if not state.n:
            opens[at] = True
            state.n, state.sx, state.sy = 1, int(x[at]), int(y[at])
            at += 1
            continue
        stop = min(end, at + size)
        xs, ys = x[at:stop], y[at:stop]
        # the centre before each event, were all events before it to join
        members = state.n + np.arange(stop - at)
        cx = (state.sx + np.cumsum(xs) - xs) / members
        cy = (state.sy + np.cumsum(ys) - ys) / members
        beyond = distance_km(cy / UNIT, cx / UNIT, ys / UNIT, xs / UNIT) > radius
        k = int(np.argmax(beyond))
        if beyond[k]:
            opens[at + k] = True
            state.n, state.sx, state.sy = 1, int(xs[k]), int(ys[k])
            at += k + 1
            size = 16
        else:
            state.n, state.sx, state.sy = state.n + stop - at, state.sx + int(xs.sum()), state.sy + int(ys.sum())
            at = stop
            size = min(2 * size, 65536)


def open_flags(x: np.ndarray, y: np.ndarray, starts: np.ndarray, radius: float, state: Open) -> np.ndarray:
    """Which events open a cluster. ``starts`` marks the first event of each group; events before the first
    mark go on with ``state``, which becomes the last group's open cluster."""
    opens = starts.copy()
    begin = np.flatnonzero(starts)
    head = int(begin[0]) if begin.size else len(x)
    _search(x, y, 0, head, state, radius, opens)
    if not begin.size:
        return opens
    size = np.diff(np.append(begin, len(x)))
    for k in np.flatnonzero(size > TOGETHER):
        own = Open(1, int(x[begin[k]]), int(y[begin[k]]))
        _search(x, y, int(begin[k]) + 1, int(begin[k] + size[k]), own, radius, opens)
        if k == begin.size - 1:
            state.n, state.sx, state.sy = own.n, own.sx, own.sy
    short = np.flatnonzero(size <= TOGETHER)
    short = short[np.argsort(-size[short], kind="stable")]
    at, left = begin[short], size[short]
    n, sx, sy = np.ones(short.size, np.int64), x[at].copy(), y[at].copy()
    for step in range(1, int(left[0]) if short.size else 0):
        live = int(np.searchsorted(-left, -step, side="left"))   # groups with an event at this step
        here = at[:live] + step
        xs, ys = x[here], y[here]
        m = n[:live]
        beyond = distance_km(sy[:live] / m / UNIT, sx[:live] / m / UNIT, ys / UNIT, xs / UNIT) > radius
        opens[here] = beyond
        n[:live] = np.where(beyond, 1, m + 1)
        sx[:live] = np.where(beyond, xs, sx[:live] + xs)
        sy[:live] = np.where(beyond, ys, sy[:live] + ys)
    last = np.flatnonzero(short == begin.size - 1)
    if last.size:
        k = int(last[0])
        state.n, state.sx, state.sy = int(n[k]), int(sx[k]), int(sy[k])
    return opens


_SUMS = ("visit_freq", "sx", "sy")


def fold_clusters(batches: Iterator[pd.DataFrame], keys: list[str], radius: float) -> Iterator[pd.DataFrame]:
    """Clusters of a stream sorted by ``keys`` and time: keys, clust_id (from 1), visit_freq, sx, sy, first_us,
    last_us and a 24-slot hour histogram as columns h0..h23. A group's last cluster comes with the batch after."""
    state, held = Open(), None
    for pdf in batches:
        m = len(pdf)
        if not m:
            continue
        cols = [pdf[k].to_numpy() for k in keys]
        starts = np.zeros(m, bool)
        for c in cols:
            starts[1:] |= c[1:] != c[:-1]
        starts[0] = held is None or any(held[k].iloc[0] != c[0] for k, c in zip(keys, cols, strict=True))
        x, y = pdf["xi"].to_numpy(np.int64), pdf["yi"].to_numpy(np.int64)
        opens = open_flags(x, y, starts, radius, state)
        rows = np.flatnonzero(opens) if opens[0] else np.concatenate([[0], np.flatnonzero(opens)])
        number = np.cumsum(opens) if opens[0] else 1 + np.cumsum(opens)
        t = pdf["t_us"].to_numpy(np.int64)
        hours = np.bincount((number - 1) * 24 + pdf["hr"].to_numpy(), minlength=24 * rows.size).reshape(-1, 24)
        out = pd.DataFrame({k: c[rows] for k, c in zip(keys, cols, strict=True)})
        # numbers within the group: clusters since its start
        first = np.flatnonzero(starts[rows])
        index = np.arange(rows.size)
        base = np.zeros(rows.size, np.int64)
        if first.size:
            base[first] = np.diff(np.concatenate([[0], first]))
            base = np.cumsum(base)
        out["clust_id"] = index - base + 1
        if held is not None and not starts[0]:
            upto = first[0] if first.size else rows.size
            out.iloc[:upto, out.columns.get_loc("clust_id")] += int(held["clust_id"].iloc[0]) - (not opens[0])
        out["visit_freq"] = np.diff(np.append(rows, m))
        out["sx"], out["sy"] = np.add.reduceat(x, rows), np.add.reduceat(y, rows)
        out["first_us"], out["last_us"] = t[rows], t[np.append(rows[1:], m) - 1]
        for h in range(24):
            out[f"h{h}"] = hours[:, h]
        if held is not None:
            if opens[0]:
                yield held
            else:   # the first row goes on with the held cluster
                for c in ("visit_freq", "sx", "sy", *[f"h{h}" for h in range(24)]):
                    out.iloc[0, out.columns.get_loc(c)] += int(held[c].iloc[0])
                out.iloc[0, out.columns.get_loc("first_us")] = int(held["first_us"].iloc[0])
        if len(out) > 1:
            yield out.iloc[:-1]
        held = out.iloc[-1:]
    if held is not None:
        yield held


def _with_stays(frames: Iterator[pd.DataFrame], last_stay: int) -> Iterator[pd.DataFrame]:
    """Clusters with ``stay_time``: whole minutes to the next cluster of the user-day, ``last_stay`` for its last."""
    held = None
    for f in frames:
        f = f if held is None else pd.concat([held, f], ignore_index=True)
        held = f.iloc[-1:]
        if len(f) > 1:
            yield _stay(f, last_stay).iloc[:-1]
    if held is not None:
        yield _stay(held, last_stay)


def _stay(f: pd.DataFrame, last_stay: int) -> pd.DataFrame:
    same = (f["user_id"].eq(f["user_id"].shift(-1)) & f["d"].eq(f["d"].shift(-1))).to_numpy()
    gap = (f["first_us"].shift(-1, fill_value=0).to_numpy() - f["first_us"].to_numpy()) // 60_000_000
    return f.assign(stay_time=np.where(same, gap, last_stay).astype(np.int32))


def _trips(frames: Iterator[pd.DataFrame], threshold: int) -> Iterator[pd.DataFrame]:
    """Pairs of consecutive clusters of a user-day that are not stops, numbered per user."""
    held, user, count = None, None, 0
    for f in frames:
        f = f[f["stay_time"] >= threshold]
        f = f if held is None else pd.concat([held, f], ignore_index=True)
        if not len(f):
            continue
        held = f.iloc[-1:]
        a, b = f.iloc[:-1], f.iloc[1:]
        same = (a["user_id"].to_numpy() == b["user_id"].to_numpy()) & (a["d"].to_numpy() == b["d"].to_numpy())
        a, b = a[same], b[same]
        if not len(a):
            continue
        users = a["user_id"].to_numpy()
        nth = a.groupby("user_id", sort=False).cumcount().to_numpy() + 1
        nth = nth + np.where(users == user, count, 0)
        user, count = users[-1], int(nth[-1])
        o, e = a["visit_freq"].to_numpy(), b["visit_freq"].to_numpy()
        yield pd.DataFrame({
            "user_id": users, "d": a["d"].to_numpy(), "trp_id": nth, "o_clust": a["clust_id"].to_numpy(),
            "d_clust": b["clust_id"].to_numpy(), "ox": a["sx"].to_numpy() / o / UNIT, "oy": a["sy"].to_numpy() / o / UNIT,
            "dx": b["sx"].to_numpy() / e / UNIT, "dy": b["sy"].to_numpy() / e / UNIT,
            "start_us": a["last_us"].to_numpy(), "end_us": b["first_us"].to_numpy()})


_CLUSTER = "user_id bigint, d int, clust_id int, visit_freq int, sx bigint, sy bigint, first_us bigint, last_us bigint"
_HOURS = "hours array<int>"
_TRIP = ("user_id bigint, d int, trp_id int, o_clust int, d_clust int, ox double, oy double, dx double, dy double, "
         "start_us bigint, end_us bigint")


def packed_hours(f: pd.DataFrame) -> pd.DataFrame:
    """h0..h23 as one list column."""
    names = [f"h{h}" for h in range(24)]
    return f.drop(columns=names).assign(hours=list(f[names].to_numpy(np.int32)))


def has_hot_groups(df: DataFrame, keys: list[str], fraction: float = 1e-4, min_sampled: int = 1000,
                   n_tasks: int | None = None) -> bool:
    """True when a sample of the key columns shows one group holding more than two tasks' worth of rows.

    It chooses the plan only: both folds give the same rows to the bit. With
    the default 0.01 % sample a 100 TB input contributes ~10^8 keys to the check, enough to
    see any group holding a few percent of the data; inputs under ~10^7 rows
    are never split (one task handles any of their groups quickly)."""
    n_tasks = n_tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = (df.select(*keys).sample(fraction=fraction, seed=7).groupBy(*keys).count()
         .agg(F.max("count").alias("mx"), F.sum("count").alias("n")).first())
    if not r or not r.n or r.n < min_sampled:
        return False
    return r.mx / r.n > 2.0 / n_tasks


def with_times(clusters: DataFrame, *extra: str) -> DataFrame:
    """Integer day and times as date and timestamps; the centre in degrees."""
    centre = lambda c: F.col(c) / F.col("visit_freq") / F.lit(UNIT)
    return clusters.select("user_id", F.date_from_unix_date("d").alias("day"), "clust_id", "visit_freq",
                           from_micros("first_us").alias("first_visit"), from_micros("last_us").alias("last_visit"),
                           *extra, centre("sx").alias("cx"), centre("sy").alias("cy"))


def trip_clusters_raw(pings: DataFrame, radius_km: float = TRIP_RADIUS_KM, split_hot: bool | None = None,
                      hours: bool = True) -> DataFrame:
    """Sequential leader clustering per (user, day) (WN-4, MB-6).

    Events are visited by time (ties by event id); an event joins the most
    recently opened cluster if that cluster's current centre (mean of its
    members) is within ``radius_km``, else it opens the next cluster.
    ``split_hot``: None = decide from a sample (``has_hot_groups``); True
    forces the range-split fold of ``split_fold`` (a hot user-day over many
    tasks), False the one-task-per-user stream. Events without a user, a time
    or a location cannot be placed and are skipped.
    """
    if split_hot is None:
        split_hot = has_hot_groups(pings.where(PLACED), ["user_id"])
    if split_hot:
        from fieldkit.operators.split_fold import trip_clusters_split
        n = int(pings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = trip_clusters_split(placed_events(pings), radius_km, n)
        return with_times(out, *(["hours"] if hours else []))
    return trip_fold_stream(pings, radius_km, "raw" if hours else "clusters")


def trip_fold_stream(pings: DataFrame, radius_km: float = TRIP_RADIUS_KM, emit: str = "raw",
                     stay_threshold: int = STAY_THRESHOLD_MIN, last_stay: int = LAST_STAY_MIN) -> DataFrame:
    """The one-task-per-user fold: one shuffle, then clusters (``raw`` with the
    hour histogram, ``clusters`` without), clusters with stay minutes
    (``stays``) or numbered trips (``trips``) straight from the sorted stream —
    no second shuffle and no window."""
    stream = (placed_events(pings).repartition("user_id").sortWithinPartitions("user_id", "d", "t_us", "event_id")
              .select("user_id", "d", "t_us", "xi", "yi", "hr"))

    def run(batches):
        frames = fold_clusters(batches, ["user_id", "d"], radius_km)
        if emit in ("stays", "trips"):
            frames = _with_stays(frames, last_stay)
        if emit == "trips":
            yield from _trips(frames, stay_threshold)
            return
        for f in frames:
            yield f.drop(columns=[f"h{h}" for h in range(24)]) if emit == "clusters" else packed_hours(f)

    if emit == "trips":
        out = stream.mapInPandas(run, _TRIP)
        return out.select("user_id", F.date_from_unix_date("d").alias("day"), "trp_id", "o_clust", "d_clust", "ox", "oy",
                          "dx", "dy", from_micros("start_us").alias("start"), from_micros("end_us").alias("end"))
    extra = ([] if emit == "clusters" else ["hours"]) + (["stay_time"] if emit == "stays" else [])
    schema = ", ".join([_CLUSTER, *(["stay_time int"] if emit == "stays" else []), *([_HOURS] if emit != "clusters" else [])])
    return with_times(stream.mapInPandas(run, schema), *extra)


# ------------------------------------------------------------------ nearest leader over a user's whole history

class _CentreGrid:
    """Cluster centres bucketed in lat/lon cells of one radius' size.

    ``candidates`` returns every cluster whose centre can lie within the
    radius of a point (a superset, in creation order), so a nearest search
    over it gives exactly the answer of a search over all clusters: a
    cluster outside the radius never changes the decision (it can neither be
    joined nor prevent a new cluster). Near a pole or the date line, where a
    circle is no small box, these are all clusters."""

    def __init__(self, radius_km: float):
        self.rad = radius_km / EARTH_RADIUS_KM
        self.cell = math.degrees(self.rad)
        self.cells: dict[tuple[int, int], list[list]] = {}
        self.all: list[list] = []

    def key(self, c: list) -> tuple[int, int]:
        return (math.floor(c[3] / c[1] / UNIT / self.cell), math.floor(c[2] / c[1] / UNIT / self.cell))

    def add(self, c: list) -> None:
        self.all.append(c)
        self.cells.setdefault(self.key(c), []).append(c)

    def join(self, c: list, x: int, y: int) -> None:
        old = self.key(c)
        c[1] += 1
        c[2] += x
        c[3] += y
        new = self.key(c)
        if new != old:
            self.cells[old].remove(c)
            self.cells.setdefault(new, []).append(c)

    def candidates(self, lon: float, lat: float) -> list[list]:
        s, coslat = math.sin(min(self.rad, math.pi / 2)), math.cos(math.radians(lat))
        if coslat <= 2 * s:
            return self.all
        dlat = math.degrees(self.rad) * 1.001 + 1e-9
        dlon = math.degrees(math.asin(s / coslat)) * 1.001 + 1e-9
        if lon - dlon < -180 or lon + dlon > 180:
            return self.all
        rows = range(math.floor((lat - dlat) / self.cell), math.floor((lat + dlat) / self.cell) + 1)
        cols = range(math.floor((lon - dlon) / self.cell), math.floor((lon + dlon) / self.cell) + 1)
        found = [c for i in rows for j in cols for c in self.cells.get((i, j), ())]
        return sorted(found, key=lambda c: c[0])


MANY = 64   # clusters of a group; with more, candidates come from a grid
FEW = 16    # groups; fewer are searched one by one


def _nearest(n: np.ndarray, sx: np.ndarray, sy: np.ndarray, x: np.ndarray, y: np.ndarray, radius: float) -> np.ndarray:
    """Per event the nearest of its row of clusters (the first minimum: the earliest wins ties), -1 where none is within
    the radius. Clusters without members are none."""
    m = np.maximum(n, 1)
    # compared to the millimetre, so that ties do not hang on the last bit of a sine
    d = np.floor(distance_km(sy / m / UNIT, sx / m / UNIT, y[:, None] / UNIT, x[:, None] / UNIT) * 1e6 + 0.5)
    d = np.where(n > 0, d, np.inf)
    k = np.argmin(d, axis=1)
    return np.where(d[np.arange(len(k)), k] <= radius * 1e6, k, -1)


def _search_grid(x: np.ndarray, y: np.ndarray, at: int, end: int, state: list[list], radius: float, label: np.ndarray) -> None:
    """Label the events in [at, end) one by one, with candidates from a grid of the centres."""
    grid = _CentreGrid(radius)
    for k, (n, sx, sy) in enumerate(state):
        grid.add([k, n, sx, sy])
    for i, px, py in zip(range(at, end), x[at:end].tolist(), y[at:end].tolist(), strict=True):
        near = grid.candidates(px / UNIT, py / UNIT)
        if near:
            c = np.array([o[1:] for o in near])
            k = int(_nearest(c[None, :, 0], c[None, :, 1], c[None, :, 2], np.array([px]), np.array([py]), radius)[0])
        if near and k >= 0:
            grid.join(near[k], px, py)
            label[i] = near[k][0]
        else:
            label[i] = len(grid.all)
            grid.add([len(grid.all), 1, px, py])


def _search_nearest(x: np.ndarray, y: np.ndarray, at: int, end: int, state: list[list], radius: float, label: np.ndarray) -> None:
    """Label the events in [at, end) of one group with their cluster; ``state`` holds [n, sum of x, sum of y] of those open.

    A block's labels are guessed, the centres before each event follow from the guess and give new labels: these are
    right up to and with the first that differs, and become the next guess."""
    size = 16
    while at < end:
        if len(state) > MANY:
            return _search_grid(x, y, at, end, state, radius, label)
        if not state:
            label[at] = 0
            state.append([1, int(x[at]), int(y[at])])
            at += 1
            continue
        xs, ys = x[at:at + size][:end - at], y[at:at + size][:end - at]
        n, sx, sy = (np.array(c, np.int64)[None, :] for c in zip(*state, strict=True))
        guess = _nearest(n, sx, sy, xs, ys, radius)
        for _ in range(6):
            own = guess[:, None] == np.arange(len(state))
            ox, oy = own * xs[:, None], own * ys[:, None]
            found = _nearest(n + np.cumsum(own, 0) - own, sx + np.cumsum(ox, 0) - ox, sy + np.cumsum(oy, 0) - oy, xs, ys, radius)
            differs = found != guess
            right = int(np.argmax(differs)) + 1 if differs.any() else len(xs)
            opens = found[:right] < 0
            if opens.any():
                right = int(np.argmax(opens)) + 1
                break
            if right == len(xs):
                break
            guess = found
        took = found[:right]
        for k in np.unique(took[took >= 0]).tolist():
            own = took == k
            c = state[k]
            c[0], c[1], c[2] = c[0] + int(own.sum()), c[1] + int(xs[:right][own].sum()), c[2] + int(ys[:right][own].sum())
        if took[-1] < 0:
            took[-1] = len(state)
            state.append([1, int(xs[right - 1]), int(ys[right - 1])])
        label[at:at + right] = took
        at += right
        size = min(2 * size, 4096) if right == len(xs) else max(16, right)


def nearest_labels(x: np.ndarray, y: np.ndarray, starts: np.ndarray, radius: float, held: list[list]) -> np.ndarray:
    """The cluster, from 0, of each event within its group. ``starts`` marks the first event of each group; events before
    the first mark go on with the clusters ``held``. Groups step together as long as there are enough of them."""
    label = np.zeros(len(x), np.int64)
    begin = np.flatnonzero(starts)
    _search_nearest(x, y, 0, int(begin[0]) if begin.size else len(x), held, radius, label)
    if not begin.size:
        return label
    size = np.diff(np.append(begin, len(x)))
    order = np.argsort(-size, kind="stable")
    at, left = begin[order], size[order]
    used = np.ones(at.size, np.int64)   # clusters per group
    n, sx, sy = (np.zeros((at.size, 4), np.int64) for _ in range(3))
    n[:, 0], sx[:, 0], sy[:, 0] = 1, x[at], y[at]
    step = 1
    while step < left[0]:
        live = int(np.searchsorted(-left, -step, side="left"))   # groups with an event at this step
        wide = int(used[:live].max())
        if live < FEW or wide > MANY:
            for g in range(live):
                state = np.stack([n[g, :used[g]], sx[g, :used[g]], sy[g, :used[g]]], 1).tolist()
                _search_nearest(x, y, int(at[g]) + step, int(at[g] + left[g]), state, radius, label)
            break
        if wide == n.shape[1]:
            n, sx, sy = (np.pad(c, ((0, 0), (0, wide))) for c in (n, sx, sy))
        here = at[:live] + step
        xs, ys = x[here], y[here]
        k = _nearest(n[:live, :wide], sx[:live, :wide], sy[:live, :wide], xs, ys, radius)
        new = k < 0
        k[new] = used[:live][new]
        used[:live] += new
        label[here] = k
        rows = np.arange(live)
        n[rows, k] += 1
        sx[rows, k] += xs
        sy[rows, k] += ys
        step += 1
    return label


_HOME_WORK = ("user_id bigint, grp bigint, nth int, visit_freq int, sx bigint, sy bigint, home int, work int, "
              "transit int, first_us bigint, first_id bigint")
_ADDED = ("visit_freq", "sx", "sy", "home", "work", "transit")


def _home_work_fold(radius_km: float):
    """Clusters of a stream sorted by user_id, grp, time and event_id, with the 0/1 columns home, work and transit.
    Only the clusters of the last group are held from batch to batch."""
    def table(users, groups, nth, sums, first_us, first_id) -> pa.RecordBatch:
        ints = lambda v: pa.array(v.astype(np.int32))
        cols = [pa.array(users), pa.array(groups), ints(nth), ints(sums[:, 0]), pa.array(sums[:, 1].copy()), pa.array(sums[:, 2].copy()),
                *[ints(sums[:, k]) for k in (3, 4, 5)], pa.array(first_us), first_id]
        return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in _HOME_WORK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None   # the last group: user, group, sums, first_us, first_id
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            u, g, x, y, t = (b.column(c).to_numpy() for c in ("user_id", "grp", "xi", "yi", "t_us"))
            starts = np.ones(m, bool)
            starts[1:] = (u[1:] != u[:-1]) | (g[1:] != g[:-1])
            starts[0] = held is None or (u[0], g[0]) != held[:2]
            if held is not None and starts[0]:
                k = len(held[2])
                yield table(np.full(k, held[0]), np.full(k, held[1]), np.arange(1, k + 1), *held[2:])
                held = None
            before = 0 if held is None else len(held[2])
            label = nearest_labels(x, y, starts, radius_km, [] if held is None else held[2][:, :3].tolist())
            # a row per cluster: groups one after another, those held first
            begin = np.flatnonzero(starts)
            first = np.append(begin, m) if starts[0] else np.concatenate([[0], begin, [m]])
            of = np.repeat(np.arange(first.size - 1), np.diff(first))
            count = np.maximum.reduceat(label, first[:-1]) + 1
            count[0] = max(count[0], before)
            base = np.cumsum(count) - count
            row, total = base[of] + label, int(count.sum())
            sums = np.zeros((total, len(_ADDED)), np.int64)
            for k, col in enumerate((np.ones(m, np.int64), x, y, *[b.column(c).to_numpy().astype(np.int64) for c in _ADDED[3:]])):
                np.add.at(sums[:, k], row, col)
            rows, event = np.unique(row, return_index=True)   # of each cluster the first event in this batch
            first_us, first_at = np.zeros(total, np.int64), np.zeros(total, np.int64)
            first_us[rows], first_at[rows] = t[event], event
            first_id = b.column("event_id").take(pa.array(first_at))
            if held is not None:
                sums[:before] += held[2]
                first_us[:before] = held[3]
                first_id = pa.concat_arrays([held[4], first_id[before:]])
            last = int(base[-1])
            if last:
                group = np.repeat(first[:-1], count)
                yield table(u[group][:last], g[group][:last], (np.arange(total) - np.repeat(base, count) + 1)[:last],
                            sums[:last], first_us[:last], first_id[:last])
            held = (u[-1], g[-1], sums[last:].copy(), first_us[last:].copy(), first_id[last:])
        if held is not None:
            k = len(held[2])
            yield table(np.full(k, held[0]), np.full(k, held[1]), np.arange(1, k + 1), *held[2:])
    return run


def _merged_boxes(cells: np.ndarray, margin: float) -> np.ndarray:
    """A group per cell (x, y in cell units): boxes of groups, widened by ``margin``, do not overlap.

    Cells are swept by x; groups whose boxes meet are merged and their boxes joined until nothing changes.
    """
    group = np.arange(len(cells))
    boxes = {k: [c[0] - margin, c[0] + 1 + margin, c[1] - margin, c[1] + 1 + margin] for k, c in enumerate(cells.tolist())}
    changed = True
    while changed:
        changed = False
        order = sorted(boxes, key=lambda k: boxes[k][0])
        live: list[int] = []
        for k in order:
            b = boxes[k]
            live = [o for o in live if o in boxes and boxes[o][1] > b[0]]
            for o in list(live):
                a = boxes[o]
                if a[2] < b[3] and b[2] < a[3] and a[1] > b[0] and b[1] > a[0]:
                    boxes[k] = b = [min(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), max(a[3], b[3])]
                    group[group == o] = k
                    del boxes[o]
                    live.remove(o)
                    changed = True
            live.append(k)
    return group


def _widest_km(x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray) -> np.ndarray:
    """A bound on the distance of any two points of boxes in degrees."""
    flat = np.where((y0 <= 0) & (y1 >= 0), 0.0, np.minimum(np.abs(y0), np.abs(y1)))   # the latitude nearest to the equator
    # the box's height along a meridian and its width along that latitude, as legs of one angle
    h = np.sin(np.radians(y1 - y0) / 2) ** 2 + (np.cos(np.radians(flat)) * np.sin(np.radians(np.minimum(x1 - x0, 180)) / 2)) ** 2
    return 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(h, 1)))


def _with_cells(events: DataFrame, radius_km: float) -> DataFrame:
    """Events with the cell they lie in, eight radii wide."""
    lat_cell = 8 * math.degrees(radius_km / EARTH_RADIUS_KM)
    cell = lambda c: F.floor(F.col(c) / F.lit(UNIT * lat_cell)).cast("bigint")
    return events.withColumn("cx", cell("xi")).withColumn("cy", cell("yi"))


def _box() -> list:
    return [F.min("xi").alias("x0"), F.max("xi").alias("x1"), F.min("yi").alias("y0"), F.max("yi").alias("y1")]


def _cell_groups(cells: DataFrame, radius_km: float) -> DataFrame:
    """user_id, cx, cy, grp and ``narrow``: no two events of the group are farther apart than the radius."""
    lat_cell = 8 * math.degrees(radius_km / EARTH_RADIUS_KM)

    def named(pdf: pd.DataFrame) -> pd.DataFrame:
        """The groups of whole users, their rows together; users of one cell are one group."""
        user, cells = pdf["user_id"].to_numpy(), pdf[["cx", "cy"]].to_numpy()
        begin = np.flatnonzero(np.append(True, user[1:] != user[:-1]))
        size = np.diff(np.append(begin, len(user)))
        # degrees of longitude shrink towards the poles: the margin covers the user's highest latitude
        top = np.minimum(90.0, (np.maximum.reduceat(np.abs(cells[:, 1]), begin) + 1) * lat_cell + lat_cell)
        coslat = np.maximum(np.cos(np.radians(top)), 1e-6)
        wide = 1.001 / 8 / coslat
        edge = (np.maximum.reduceat(np.abs(cells[:, 0]), begin) + 1 + wide >= 180 / lat_cell) | (coslat < 0.05)
        grp = np.zeros(len(user), np.int64)
        for k in np.flatnonzero((size > 1) & ~edge).tolist():
            a, z = begin[k], begin[k] + size[k]
            grp[a:z] = _merged_boxes(cells[a:z], wide[k])
        order = np.lexsort((grp, np.repeat(np.arange(size.size), size)))
        pdf, grp, user = pdf.iloc[order], grp[order], user[order]
        at = np.flatnonzero(np.append(True, (user[1:] != user[:-1]) | (grp[1:] != grp[:-1])))
        box = [f.reduceat(pdf[c].to_numpy(), at) / UNIT for c, f in
               (("x0", np.minimum), ("x1", np.maximum), ("y0", np.minimum), ("y1", np.maximum))]
        narrow = _widest_km(*box) < radius_km - 1e-6   # a millimetre, as distances are compared
        return pdf[["user_id", "cx", "cy"]].assign(grp=grp, narrow=np.repeat(narrow, np.diff(np.append(at, len(grp)))))

    def groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []   # rows of the last user, who may go on in the next batch
        for pdf in batches:
            if not len(pdf):
                continue
            user = pdf["user_id"].to_numpy()
            cut = int(np.argmax(user == user[-1]))   # rows are sorted by user
            if held and (cut or held[-1]["user_id"].iloc[-1] != user[0]):
                yield named(pd.concat([*held, pdf.iloc[:cut]], ignore_index=True))
                held = []
            elif cut:
                yield named(pdf.iloc[:cut])
            held.append(pdf.iloc[cut:])
        if held:
            yield named(pd.concat(held, ignore_index=True))

    return (cells.select("user_id", "cx", "cy", "x0", "x1", "y0", "y1").repartition("user_id").sortWithinPartitions("user_id")
            .mapInPandas(groups, "user_id bigint, cx bigint, cy bigint, grp bigint, narrow boolean"))


def place_groups(events: DataFrame, radius_km: float) -> DataFrame:
    """``events`` with ``grp``: events of a user in different groups can never share a cluster.

    A cluster's centre lies in the box of its members, and an event joins
    within the radius, so events whose boxes stay apart when widened by the radius do
    not affect each other. Boxes start as occupied cells, eight radii wide, and are merged while they
    overlap. Grouped are the distinct cells of a user, not the events.
    """
    own = _with_cells(events, radius_km)
    named = _cell_groups(own.groupBy("user_id", "cx", "cy").agg(*_box()), radius_km).drop("narrow")
    return own.join(named, ["user_id", "cx", "cy"]).drop("cx", "cy")


def home_work_clusters_raw(pings: DataFrame, radius_km: float = HOME_WORK_RADIUS_KM,
                           home_hours=HOME_HOURS, work_hours=WORK_HOURS, transit_hours=TRANSIT_HOURS,
                           excluded_days=EXCLUDED_DAYS, sum_narrow: bool = True) -> DataFrame:
    """Nearest-leader clustering over each user's whole history (WN-5, MB-12).

    An event joins the nearest existing cluster of the user if its centre is
    within ``radius_km`` (ties: the earliest cluster), else opens a new one.
    Home/work/transit hour counts skip ``excluded_days`` (weekday names).

    A user is split by place (``place_groups``). A place no wider than the radius
    is one cluster whatever the order of its events, so it is summed up by plain
    aggregates, combined before the shuffle: a site with a third of all events is no task's
    stream (``sum_narrow=False`` folds it all the same). Each wider place is folded on its
    own, as one task's stream in linear time and the memory of its clusters. Clusters are numbered by their
    first events, which is the order in which the undivided history opens them.
    """
    dname = F.date_format(F.date_from_unix_date("d"), "EEEE").alias("dname")
    own = _with_cells(placed_events(pings), radius_km).select("*", dname)
    counted = ~F.col("dname").isin(list(excluded_days))
    own = own.select("*", *[(counted & F.col("hr").isin(list(h))).cast("int").alias(n) for n, h in (
        ("home", home_hours), ("work", work_hours), ("transit", transit_hours))]).drop("dname", "hr")
    hours = [F.sum(n).cast("int").alias(n) for n in ("home", "work", "transit")]
    cells = own.groupBy("user_id", "cx", "cy").agg(
        *_box(), F.count(F.lit(1)).alias("visit_freq"), F.sum("xi").alias("sx"), F.sum("yi").alias("sy"), *hours,
        F.min(F.struct("t_us", "event_id")).alias("first"))
    cells = cut_lineage(cells)
    named = cut_lineage(_cell_groups(cells, radius_km))
    if not sum_narrow:
        named = named.withColumn("narrow", F.lit(False))
    whole = cells.join(named.where("narrow").drop("narrow"), ["user_id", "cx", "cy"]).groupBy("user_id", "grp").agg(
        F.sum("visit_freq").cast("int").alias("visit_freq"), *[F.sum(c).alias(c) for c in ("sx", "sy")],
        *[F.sum(c).cast("int").alias(c) for c in ("home", "work", "transit")], F.min("first").alias("first"))
    whole = whole.select("user_id", "grp", F.lit(1).alias("nth"), "visit_freq", "sx", "sy", "home", "work", "transit",
                         F.col("first.t_us").alias("first_us"), F.col("first.event_id").alias("first_id"))
    wide = own.join(named.where("NOT narrow").drop("narrow"), ["user_id", "cx", "cy"]).select(
        *[F.col(c).cast("bigint").alias(c) for c in ("user_id", "grp", "t_us", "event_id", "xi", "yi")], "home", "work", "transit")
    stream = wide.repartition("user_id", "grp").sortWithinPartitions("user_id", "grp", "t_us", "event_id")
    clusters = stream.mapInArrow(_home_work_fold(radius_km), _HOME_WORK).union(whole)
    order = Window.partitionBy("user_id").orderBy("first_us", "first_id")   # a row per cluster of the user
    return clusters.select("user_id", F.row_number().over(order).alias("clust_id"), "visit_freq",
                           (F.col("sx") / F.lit(UNIT)).alias("sx"), (F.col("sy") / F.lit(UNIT)).alias("sy"),
                           "home", "work", "transit")
