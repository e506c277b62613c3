"""Mobility operators over location-stamped events (MB-*, WN-1/2, AG-12..18).

Input ``pings(user_id, event_id, ts, site_id, x, y)``; x = longitude,
y = latitude. Every operator is a DataFrame → DataFrame plan: clustering is a
sorted-stream fold (``operators.clustering``), everything after it runs on
the much smaller cluster table with windows and aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.functions.geo import haversine, round6
from fieldkit.operators.clustering import (PLACED, has_hot_groups, home_work_clusters_raw, to_micros, trip_clusters_raw,
                                           trip_fold_stream)
from fieldkit.operators.sequence import with_next, with_row_number
from fieldkit.params import (DISTANCE_THRESHOLD_KM, EARTH_RADIUS_KM, HOME_HOURS, HOME_WORK_SHARE, LAST_STAY_MIN, MIN_UNIQUE_LOCS,
                             STAY_THRESHOLD_MIN, TRANSIT_HOURS, TRIP_RADIUS_KM, WEEKEND_FROM, WORK_HOURS)
from fieldkit.session import cut_lineage

_DAY = ["user_id", "day"]


def with_day(pings: DataFrame) -> DataFrame:
    return pings.withColumn("day", F.to_date("ts"))


# --------------------------------------------------------------- clusters

def has_hot_users(pings: DataFrame) -> bool:
    """Sampled check: does one user (and so possibly one user-day) hold more
    than two tasks' share of the events?"""
    return has_hot_groups(pings.where(PLACED), ["user_id"])


def trip_clusters(pings: DataFrame, radius_km: float = TRIP_RADIUS_KM, split_hot: bool | None = None,
                  hours: bool = True) -> DataFrame:
    """Clusters per user-day with centre, visit count, first/last visit and
    (``hours=True``) the 24-slot hour histogram (WN-3, WN-4, MB-6). Centre
    kept unrounded in cx/cy."""
    return trip_clusters_raw(pings, radius_km, split_hot, hours)


def cluster_stay_time(clusters: DataFrame, stay_threshold: int = STAY_THRESHOLD_MIN,
                      last_stay: int = LAST_STAY_MIN, chunked: bool = False) -> DataFrame:
    """Stay = whole minutes from this cluster's first visit to the next one's;
    the day's last cluster gets ``last_stay``. Shorter than
    ``stay_threshold`` → 'stop', else 'OD' (WN-1, SC-15, SC-27).
    ``chunked``: split hot user-days over tasks (``operators.sequence``)."""
    nxt = with_next(clusters, _DAY, ["clust_id"], ["first_visit"], "_next_", chunked)
    # whole minutes between wall-clock times (time-zone free, truncated)
    minutes = ((to_micros("_next_first_visit") - to_micros("first_visit")) / F.lit(60_000_000)).cast("long")
    stay = F.coalesce(minutes.cast("int"), F.lit(last_stay))
    return (nxt.withColumn("stay_time", stay)
            .withColumn("stop_or_stay", F.when(F.col("stay_time") < stay_threshold, "stop").otherwise("OD"))
            .drop("_next_first_visit"))


def consecutive_pairs(clusters: DataFrame, chunked: bool = False) -> DataFrame:
    """Overlapping consecutive pairs of a day's clusters (WN-2)."""
    nxt = with_next(clusters.select(*_DAY, "clust_id"), _DAY, ["clust_id"], ["clust_id"], "next_", chunked)
    return nxt.where(F.col("next_clust_id").isNotNull())


def trips(clusters_with_stay: DataFrame, chunked: bool = False) -> DataFrame:
    """Trips between consecutive non-stop clusters of a day (MB-7, MB-11).

    start = origin's last visit, end = destination's first visit, distance =
    haversine between the centres; trp_id numbers a user's trips from 1 in
    (day, origin cluster) order.
    """
    od = clusters_with_stay.where(F.col("stop_or_stay") == "OD").select(
        *_DAY, "clust_id", "cx", "cy", "first_visit", "last_visit")
    nxt = with_next(od, _DAY, ["clust_id"], ["clust_id", "cx", "cy", "first_visit"], "d_", chunked)
    pairs = nxt.where(F.col("d_clust_id").isNotNull()).select(
        *_DAY, F.col("clust_id").alias("o_clust"), F.col("cx").alias("ox"), F.col("cy").alias("oy"),
        F.col("last_visit").alias("start"), F.col("d_clust_id").alias("d_clust"), F.col("d_cx").alias("dx"),
        F.col("d_cy").alias("dy"), F.col("d_first_visit").alias("end"))
    return _finish_trips(with_row_number(pairs, ["user_id"], ["day", "o_clust"], "trp_id", chunked))


def _finish_trips(numbered: DataFrame) -> DataFrame:
    """The output columns of (user_id, trp_id, day, o_clust, d_clust, ox, oy, dx, dy, start, end)."""
    return numbered.select(
        "user_id", "trp_id", "day", "o_clust", "d_clust",
        round6("ox").alias("Ox"), round6("oy").alias("Oy"), round6("dx").alias("Dx"), round6("dy").alias("Dy"),
        F.to_date("start").alias("date"), F.hour("start").alias("hr"), "start", "end",
        round6(haversine("oy", "ox", "dy", "dx")).alias("dist"),
        # unrounded centres for spatial lookups
        F.col("ox").alias("_ox"), F.col("oy").alias("_oy"), F.col("dx").alias("_dx"), F.col("dy").alias("_dy"))


def trips_from_pings(pings: DataFrame, radius_km: float = TRIP_RADIUS_KM, split_hot: bool | None = None) -> DataFrame:
    """Clusters → stays → trips.

    Without hot keys the fold itself pairs consecutive non-stop clusters and
    numbers them while it streams each user (one shuffle of the events, none
    of the clusters). Hot users (sampled check, or ``split_hot=True``) get the
    range-split fold and the chunked window steps instead; the rows are equal."""
    if split_hot is None:
        split_hot = has_hot_users(pings)
    if split_hot:
        return trips(cluster_stay_time(trip_clusters(pings, radius_km, True), chunked=True), chunked=True)
    return _finish_trips(trip_fold_stream(pings, radius_km, "trips"))


def cluster_stays(pings: DataFrame, radius_km: float = TRIP_RADIUS_KM, split_hot: bool | None = None) -> DataFrame:
    """Clusters with stay minutes and stop/OD label straight from the pings
    (in-fold without hot keys; fold + chunked windows with them)."""
    if split_hot is None:
        split_hot = has_hot_users(pings)
    if split_hot:
        return cluster_stay_time(trip_clusters(pings, radius_km, True), chunked=True)
    return trip_fold_stream(pings, radius_km, "stays").withColumn(
        "stop_or_stay", F.when(F.col("stay_time") < STAY_THRESHOLD_MIN, "stop").otherwise("OD"))


# ------------------------------------------------------- per-day location stats

def unique_locations(pings: DataFrame) -> DataFrame:
    """Distinct (x, y) per user-day (MB-2)."""
    return with_day(pings).select(*_DAY, "x", "y").distinct()


def placed_locations(pings: DataFrame) -> DataFrame:
    """Distinct (x, y) per user-day, of events with a user, a time and a place."""
    return unique_locations(pings.where(PLACED))


GRID = 4      # a cell is cut into GRID x GRID cells
LEVELS = 12   # times at most; then locations are compared one by one


def _known(a: str, b: str) -> str:
    """Haversine of the angle between the sample locations of two cells."""
    return (f"pow(sin(radians({b}.y - {a}.y) / 2), 2) + cos(radians({a}.y)) * cos(radians({b}.y))"
            f" * pow(sin(radians({b}.x - {a}.x) / 2), 2)")


def _most(a: str, b: str) -> str:
    """A bound on it for all locations of two cells: the widest angles, the latitudes nearest to the equator."""
    def wide(v: str) -> str:
        return f"least(greatest(abs({a}.{v}1 - {b}.{v}0), abs({b}.{v}1 - {a}.{v}0)), 180D)"

    def cosine(c: str) -> str:
        return f"cos(radians(if({c}.y0 <= 0 AND {c}.y1 >= 0, 0D, least(abs({c}.y0), abs({c}.y1)))))"

    return (f"(pow(sin(radians({wide('y')}) / 2), 2) + {cosine(a)} * {cosine(b)} * pow(sin(radians({wide('x')}) / 2), 2))"
            " * (1 + 1e-12)")   # a margin for the last bits


def _cells(grid: DataFrame, level: int) -> DataFrame:
    """The cells of a level with locations: their number, bounds and one location, as the struct ``cell``."""
    step = GRID ** (LEVELS - level)
    at = [F.floor(F.col(v) / step).cast("int").alias(v) for v in ("ix", "iy")]
    return grid.groupBy(*_DAY, *at).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"),
        F.max("y").alias("y1"), F.min(F.struct("x", "y")).alias("one")).select(
        *_DAY, F.struct("ix", "iy", "n", "x0", "x1", "y0", "y1", F.col("one.x").alias("x"), F.col("one.y").alias("y")).alias("cell"))


def farthest_distance(pings: DataFrame, locs: DataFrame | None = None, trace: list | None = None) -> DataFrame:
    """Per user-day: number of unique locations and the largest distance
    between two of them (0 for a single location) (MB-3).

    Branch and bound: a day's box is cut into GRID x GRID cells, of which a location
    each bounds the answer from below; the corners of two cells bound a pair from
    above. Only pairs of cells that can still beat the best known pair stay open; in
    rounds, their cells are cut again, until the bounds close or a cell holds one location.
    Most days are done after the first cut, which makes a row per day of at most
    GRID x GRID cells; later rounds are joins of open pairs with the cells of their locations,
    so no row or task holds a day's locations and no two cells' locations are paired.
    ``trace`` collects the number of pairs looked at in each round.
    """
    locs = placed_locations(pings) if locs is None else locs
    box = locs.groupBy(*_DAY).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"),
                                  F.max("y").alias("y1"))
    fine = GRID ** LEVELS

    def place(v: str) -> F.Column:
        low, high = F.col(f"{v}0"), F.col(f"{v}1")
        return F.when(high > low, F.least(F.lit(fine - 1), F.floor((F.col(v) - low) / (high - low) * fine))).otherwise(F.lit(0))

    grid = locs.join(box, _DAY).select(*_DAY, "x", "y", place("x").alias("ix"), place("y").alias("iy"))
    days = _cells(grid, 1).groupBy(*_DAY).agg(F.sum("cell.n").alias("n_locs"), F.collect_list("cell").alias("c"))
    over_pairs = "aggregate(sequence(1, size(c)), {zero}, (s, i) -> aggregate(sequence(i, size(c)), s, (t, j) -> {step}))"
    i, j = "c[i - 1]", "c[j - 1]"
    bounded = days.withColumn("low", F.expr(over_pairs.format(zero="CAST(0 AS DOUBLE)", step=f"greatest(t, {_known(i, j)})")))
    pair = f"named_struct('ax', {i}.ix, 'ay', {i}.iy, 'bx', {j}.ix, 'by', {j}.iy)"
    open_pairs = over_pairs.format(zero="CAST(array() AS array<struct<ax: int, ay: int, bx: int, by: int>>)",
                                   step=f"if({i}.n * {j}.n > 1 AND {_most(i, j)} > low, concat(t, array({pair})), t)")
    # the bound enters as a lambda's argument, so it is worked out once a row and not once a pair
    once = f"element_at(transform(array(low), low -> {open_pairs}), 1)"
    found = cut_lineage(bounded.select(*_DAY, "n_locs", "low", F.expr(once).alias("pairs")))
    low = found.where(F.size("pairs") > 0).select(*_DAY, "low")
    pairs = found.select(*_DAY, F.explode("pairs").alias("p")).select(*_DAY, "p.*")
    raised = _narrowed(grid, low, pairs, trace if trace is not None else [])
    best = F.col("low") if raised is None else F.greatest("low", F.coalesce("raised", F.lit(0.0)))
    out = found if raised is None else found.join(raised.select(*_DAY, F.col("low").alias("raised")), _DAY, "left")
    return out.select(*_DAY, F.col("n_locs").cast("bigint").alias("n_locs"),
                      (F.asin(F.sqrt(F.least(F.lit(1.0), best))) * F.lit(2 * EARTH_RADIUS_KM)).alias("max_dist"))


def _narrowed(grid: DataFrame, low: DataFrame, pairs: DataFrame, trace: list) -> DataFrame | None:
    """The days' best pairs after the rounds over open ``pairs`` of cells of level 1; None if there are none."""
    level, done = 1, None
    while not pairs.isEmpty():
        sides = pairs.select(*_DAY, F.col("ax").alias("px"), F.col("ay").alias("py")).union(
            pairs.select(*_DAY, F.col("bx").alias("px"), F.col("by").alias("py"))).distinct()
        step = GRID ** (LEVELS - level)
        # only locations of open cells go on
        at = [F.floor(F.col(f"i{v}") / step).cast("int").alias(f"p{v}") for v in ("x", "y")]
        grid = cut_lineage(grid.select(*_DAY, "x", "y", "ix", "iy", *at).join(sides, [*_DAY, "px", "py"], "left_semi")
                           .drop("px", "py"))
        level += 1
        last = level > LEVELS
        if last:   # locations of one finest cell, one by one
            cells = grid.select(*_DAY, F.expr("struct(ix, iy, 1L AS n, x AS x0, x AS x1, y AS y0, y AS y1, x, y)").alias("cell"))
            parent = [F.col("cell.ix").cast("int"), F.col("cell.iy").cast("int")]
        else:
            cells = cut_lineage(_cells(grid, level))
            parent = [F.floor(F.col(f"cell.{v}") / GRID).cast("int") for v in ("ix", "iy")]
        one, other = (cells.select(*_DAY, parent[0].alias(f"{s}x"), parent[1].alias(f"{s}y"), F.col("cell").alias(s)) for s in ("a", "b"))
        both = (pairs.join(one, [*_DAY, "ax", "ay"]).join(other, [*_DAY, "bx", "by"])
                .where("ax <> bx OR ay <> by OR a <= b")   # inside a cell each pair once
                .select(*_DAY, F.col("a.ix").alias("ax"), F.col("a.iy").alias("ay"), F.col("b.ix").alias("bx"), F.col("b.iy").alias("by"),
                        F.expr(_known("a", "b")).alias("known"), F.expr(_most("a", "b")).alias("most"), F.expr("a.n * b.n").alias("n")))
        both = cut_lineage(both)
        trace.append(both.count())
        better = both.groupBy(*_DAY).agg(F.max("known").alias("known"))
        low = cut_lineage(low.join(better, _DAY, "left").select(*_DAY, F.greatest("low", F.coalesce("known", F.lit(0.0))).alias("low")))
        done = low
        if last:
            break
        pairs = cut_lineage(both.where("n > 1").join(low, _DAY).where("most > low").select(*_DAY, "ax", "ay", "bx", "by"))
    return done


def travel_days(pings: DataFrame, min_unique_locs: int = MIN_UNIQUE_LOCS,
                distance_threshold_km: float = DISTANCE_THRESHOLD_KM) -> DataFrame:
    """Days with at least ``min_unique_locs`` locations and a farthest pair at
    least ``distance_threshold_km`` apart (MB-4)."""
    return (farthest_distance(pings)
            .where((F.col("n_locs") >= min_unique_locs) & (F.col("max_dist") >= distance_threshold_km)))


def trip_day_events(pings: DataFrame, **kw) -> DataFrame:
    """Events of travel days only: left-semi join on (user, day) (MB-5, JN-8)."""
    return with_day(pings).join(travel_days(pings, **kw).select(*_DAY), _DAY, "left_semi")


# ------------------------------------------------------------- user summary

def user_day_stats(pings: DataFrame, trips_df: DataFrame | None = None, locs: DataFrame | None = None) -> DataFrame:
    """One row per user-day: unique locations, trips, farthest distance
    (counted only on days with trips, else 0), mean trip distance."""
    trips_df = trips_df if trips_df is not None else trips_from_pings(pings)
    per_day_trips = trips_df.groupBy(*_DAY).agg(F.count(F.lit(1)).alias("n_trips"),
                                                 F.avg("dist").alias("mean_dist"))
    fd = farthest_distance(pings, locs)
    return (fd.join(per_day_trips, _DAY, "left")
            .select(*_DAY, "n_locs", F.coalesce("n_trips", F.lit(0)).alias("n_trips"), "mean_dist",
                    F.when(F.col("n_trips").isNotNull(), F.col("max_dist")).otherwise(F.lit(0.0)).alias("far")))


def user_mobility_summary(pings: DataFrame, trips_df: DataFrame | None = None) -> DataFrame:
    """Per user: usage days, days with trips, unique locations in total and
    mean/median per day, mean/median farthest distance (MB-8).

    The distinct locations of user-days are worked out once and kept as a
    table: day figures and totals both come from it."""
    locs = cut_lineage(placed_locations(pings))
    days = user_day_stats(pings, trips_df, locs).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("usage_days"),
        F.count_if(F.col("n_trips") > 0).alias("days_with_trips"),
        round6(F.avg("n_locs")).alias("mean_locs_per_day"),
        round6(F.median("n_locs")).alias("median_locs_per_day"),
        round6(F.avg("far")).alias("mean_farthest"),
        round6(F.median("far")).alias("median_farthest"))
    total = locs.select("user_id", "x", "y").distinct().groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_unique_locs"))
    return days.join(total, "user_id")


def avg_trips_per_day(trips_df: DataFrame) -> DataFrame:
    """Mean number of trips over the user's days with trips (MB-9)."""
    return (trips_df.groupBy(*_DAY).agg(F.count(F.lit(1)).alias("n"))
            .groupBy("user_id").agg(round6(F.avg("n")).alias("avg_trips_per_day")))


def avg_trip_distance(trips_df: DataFrame) -> DataFrame:
    """Mean over days of the day's mean trip distance (MB-10)."""
    return (trips_df.groupBy(*_DAY).agg(F.avg("dist").alias("d"))
            .groupBy("user_id").agg(round6(F.avg("d")).alias("avg_trip_dist")))


# -------------------------------------------------------------- home / work

def _in(col: str, values) -> F.Column:
    return F.col(col).isin(list(values))


def hour_flags(pings: DataFrame, home=HOME_HOURS, work=WORK_HOURS, transit=TRANSIT_HOURS) -> DataFrame:
    return pings.withColumn("hr", F.hour("ts")).select(
        "*", _in("hr", home).alias("is_home"), _in("hr", work).alias("is_work"), _in("hr", transit).alias("is_transit"))


def hour_counts(pings: DataFrame, keys) -> DataFrame:
    """Events per key and hour of the day (AG-12)."""
    return pings.groupBy(*keys, F.hour("ts").alias("hr")).agg(F.count(F.lit(1)).alias("n"))


def home_work_counts(pings: DataFrame, keys, **hours) -> DataFrame:
    """Events in home / work / transit hours per key; the hour lists may
    overlap and an hour counts in each (AG-15)."""
    return hour_flags(pings, **hours).groupBy(*keys).agg(
        F.count_if("is_home").alias("home"), F.count_if("is_work").alias("work"),
        F.count_if("is_transit").alias("transit"), F.count(F.lit(1)).alias("total"))


def home_work_scores(pings: DataFrame, keys, **hours) -> DataFrame:
    """Exclusive form: an hour counts once, priority work > home > transit (AG-16)."""
    f = hour_flags(pings, **hours)
    cat = (F.when(F.col("is_work"), "work").when(F.col("is_home"), "home").when(F.col("is_transit"), "transit"))
    return f.groupBy(*keys).agg(F.count_if(cat == "home").alias("home"), F.count_if(cat == "work").alias("work"),
                                F.count_if(cat == "transit").alias("transit"))


def categorize(prop_home: str = "prop_home", prop_work: str = "prop_work", prop_trst: str = "prop_trst",
               share: float = HOME_WORK_SHARE) -> F.Column:
    """Largest share if ≥ ``share`` else 'ND'; ties resolve home, work, trst (SC-28)."""
    g = F.greatest(prop_home, prop_work, prop_trst)
    label = F.when(F.col(prop_home) == g, "home").when(F.col(prop_work) == g, "work").otherwise("trst")
    return F.when(g >= F.lit(share), label).otherwise("ND")


def site_shares(pings: DataFrame, **hours) -> DataFrame:
    """Per (user, site): counts, shares of its own events and the label."""
    c = home_work_counts(pings, ["user_id", "site_id"], **hours)
    t = F.col("total").cast("double")
    return (c.select("user_id", "site_id", "home", "work", "transit", "total",
                     (F.col("home") / t).alias("prop_home"), (F.col("work") / t).alias("prop_work"),
                     (F.col("transit") / t).alias("prop_trst"))
            .withColumn("categ", categorize()))


def assign_home_work(labelled: DataFrame, key: str, total: str = "total", coords: tuple[str, ...] = ()) -> DataFrame:
    """Per user: the most visited location labelled 'home' and the most
    visited labelled 'work'; if only one is found it serves as both (MB-13).
    Ties on the visit total go to the smaller key. ``coords`` are columns of
    the location that are returned as ``home_<c>`` and ``work_<c>``."""
    place = F.struct((-F.col(total)).alias("t"), F.col(key).alias("k"), *[F.col(c) for c in coords])
    pick = lambda lab: F.min(F.when(F.col("categ") == lab, place))
    r = labelled.groupBy("user_id").agg(pick("home").alias("h"), pick("work").alias("w"))
    return r.select("user_id", F.coalesce("h.k", "w.k").alias("home"), F.coalesce("w.k", "h.k").alias("work"),
                    *[F.coalesce(f"h.{c}", f"w.{c}").alias(f"home_{c}") for c in coords],
                    *[F.coalesce(f"w.{c}", f"h.{c}").alias(f"work_{c}") for c in coords])


def home_work_by_share(pings: DataFrame, **hours) -> DataFrame:
    """Home = site with the largest share of the user's events in home
    hours, work likewise (AG-17); ties → smaller site id."""
    c = home_work_counts(pings, ["user_id", "site_id"], **hours)
    best = lambda col: F.max(F.struct(F.col(col), (-F.col("site_id")).alias("neg")))
    r = c.groupBy("user_id").agg(best("home").alias("h"), best("work").alias("w"), F.sum("total").alias("n"))
    return r.select("user_id", (-F.col("h.neg")).alias("home_site"), (-F.col("w.neg")).alias("work_site"),
                    round6(F.col("h.home") / F.col("n")).alias("home_share"),
                    round6(F.col("w.work") / F.col("n")).alias("work_share"))


def home_work_clusters(pings: DataFrame, **kw) -> DataFrame:
    """Clusters over the user's whole history with home/work/transit counts,
    shares and label (WN-5, MB-12)."""
    raw = home_work_clusters_raw(pings, **kw)
    t = F.col("visit_freq").cast("double")
    return (raw.select("user_id", "clust_id", "visit_freq", "home", "work", "transit",
                       round6(F.col("sx") / F.col("visit_freq")).alias("x"),
                       round6(F.col("sy") / F.col("visit_freq")).alias("y"),
                       (F.col("home") / t).alias("prop_home"), (F.col("work") / t).alias("prop_work"),
                       (F.col("transit") / t).alias("prop_trst"))
            .withColumn("categ", categorize()))


def weekday_category(ts_col: str = "ts") -> F.Column:
    """'wkend' for Saturday/Sunday (weekday ≥ 5, Monday = 0), else 'wkday' (SC-16)."""
    return F.when(F.weekday(ts_col) >= WEEKEND_FROM, "wkend").otherwise("wkday")


def consistent_users(pings: DataFrame, threshold: int) -> DataFrame:
    """Users with at least ``threshold`` events on every reference day of the
    data set (AG-18). A missing day counts 0, so the dense minimum is 0 unless
    the user was seen on all days — no users × days spine is built. Events
    without a time belong to no day; a user with no others is not listed."""
    spark = pings.sparkSession
    per_day = (pings.where(F.col("ts").isNotNull()).groupBy("user_id", F.to_date("ts").alias("day"))
               .agg(F.count(F.lit(1)).alias("n")))
    return spark.sql("""
        WITH u AS (SELECT user_id, count(*) AS n_days, min(n) AS min_seen FROM {d} GROUP BY user_id),
             r AS (SELECT datediff(max(day), min(day)) + 1 AS all_days FROM {d}),
             m AS (SELECT user_id, CASE WHEN n_days < (SELECT all_days FROM r) THEN 0 ELSE min_seen END AS min_events FROM u)
        SELECT user_id, min_events, min_events >= {t} AS consistent
        FROM m""".replace("{t}", str(int(threshold))), d=per_day)
