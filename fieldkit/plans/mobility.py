"""Mobility queries over the ``pings`` fixture (events with site coordinates)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldkit.functions.geo import round6
from fieldkit.operators import mobility as MB
from fieldkit.operators import spatial as SP
from fieldkit.params import EVENTS_PER_DAY_THRESHOLD, HOME_HOURS, TRANSIT_HOURS, WORK_HOURS
from fieldkit.plans.catalog import register
from fieldkit.plans.oracle_views import hav_sql, r6
from fieldkit.sources import fixtures as FX


def _hours_list(h) -> str:
    return ", ".join(str(int(x)) for x in h)


HOME, WORK, TRANSIT = _hours_list(HOME_HOURS), _hours_list(WORK_HOURS), _hours_list(TRANSIT_HOURS)

# ------------------------------------------------------------------ oracle CTEs
# The trip fold as a recursive CTE: one step per event of a user-day.
# Coordinates are integers of 1e-8 degree, whose sums are exact.
_FOLD_DIST = hav_sql("f.sy / f.n / 1e8", "f.sx / f.n / 1e8", "p.y / 1e8", "p.x / 1e8")
FOLD_SQL = f"""
WITH RECURSIVE pts AS (
  SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, CAST(round(x * 1e8) AS BIGINT) AS x,
         CAST(round(y * 1e8) AS BIGINT) AS y, CAST(hour(ts) AS INTEGER) AS hr,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
  FROM pings WHERE user_id IS NOT NULL AND ts IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL),
fold AS (
  SELECT user_id, day, rn, ts, hr, x, y, 1 AS cid, 1 AS n, x AS sx, y AS sy FROM pts WHERE rn = 1
  UNION ALL
  SELECT p.user_id, p.day, p.rn, p.ts, p.hr, p.x, p.y,
         CASE WHEN {_FOLD_DIST} <= 1.0 THEN f.cid ELSE f.cid + 1 END,
         CASE WHEN {_FOLD_DIST} <= 1.0 THEN f.n + 1 ELSE 1 END,
         CASE WHEN {_FOLD_DIST} <= 1.0 THEN f.sx + p.x ELSE p.x END,
         CASE WHEN {_FOLD_DIST} <= 1.0 THEN f.sy + p.y ELSE p.y END
  FROM fold f JOIN pts p ON p.user_id = f.user_id AND p.day = f.day AND p.rn = f.rn + 1),
clusters AS (
  SELECT user_id, day, CAST(cid AS INTEGER) AS clust_id, CAST(count(*) AS INTEGER) AS visit_freq,
         arg_max(sx / n / 1e8, rn) AS cx, arg_max(sy / n / 1e8, rn) AS cy, min(ts) AS first_visit, max(ts) AS last_visit
  FROM fold GROUP BY user_id, day, cid),
stays AS (
  SELECT *, coalesce(CAST((epoch_us(lead(first_visit) OVER w) - epoch_us(first_visit)) // 60000000 AS INTEGER),
                     1440) AS stay_time
  FROM clusters WINDOW w AS (PARTITION BY user_id, day ORDER BY clust_id)),
od AS (SELECT * FROM stays WHERE stay_time >= 15),
pairs AS (
  SELECT user_id, day, clust_id AS o_clust, cx AS ox, cy AS oy, last_visit AS start,
         lead(clust_id) OVER w AS d_clust, lead(cx) OVER w AS dx, lead(cy) OVER w AS dy,
         lead(first_visit) OVER w AS "end"
  FROM od WINDOW w AS (PARTITION BY user_id, day ORDER BY clust_id)),
trips AS (
  SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY day, o_clust) AS INTEGER) AS trp_id,
         day, o_clust, d_clust, {r6('ox')} AS Ox, {r6('oy')} AS Oy, {r6('dx')} AS Dx, {r6('dy')} AS Dy,
         CAST(start AS DATE) AS date, CAST(hour(start) AS INTEGER) AS hr, start, "end",
         {r6(hav_sql('oy', 'ox', 'dy', 'dx'))} AS dist, ox, oy, dx, dy
  FROM pairs WHERE d_clust IS NOT NULL)
"""

# per user-day unique locations and farthest pair (oracle: all pairs, small data)
DAYS_SQL = f"""
WITH ul AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, x, y FROM pings),
fd AS (
  SELECT a.user_id, a.day, max({hav_sql('a.y', 'a.x', 'b.y', 'b.x')}) AS max_dist
  FROM ul a JOIN ul b ON a.user_id = b.user_id AND a.day = b.day GROUP BY a.user_id, a.day),
nl AS (SELECT user_id, day, CAST(count(*) AS BIGINT) AS n_locs FROM ul GROUP BY user_id, day),
far AS (SELECT nl.user_id, nl.day, nl.n_locs, fd.max_dist FROM nl JOIN fd USING (user_id, day))
"""


def _pings(spark, sf_dir):
    return FX.pings(spark, sf_dir)


def _trips_sel(t):
    return t.drop("_ox", "_oy", "_dx", "_dy")


@register("trip_clusters", ids=("WN-3", "WN-4", "MB-6"), views=("pings",), sql=FOLD_SQL + f"""
SELECT user_id, day, clust_id, visit_freq, {r6('cx')} AS x, {r6('cy')} AS y, first_visit, last_visit FROM clusters""")
def trip_clusters(spark, sf_dir):
    c = MB.trip_clusters(_pings(spark, sf_dir), hours=False)
    return c.select("user_id", "day", "clust_id", "visit_freq", round6("cx").alias("x"), round6("cy").alias("y"),
                    "first_visit", "last_visit")


@register("cluster_hour_counts", ids=("MB-6",), views=("pings",), sql=FOLD_SQL + """
SELECT user_id, day, CAST(cid AS INTEGER) AS clust_id, hr, CAST(count(*) AS INTEGER) AS n
FROM fold GROUP BY user_id, day, cid, hr""")
def cluster_hour_counts(spark, sf_dir):
    c = MB.trip_clusters(_pings(spark, sf_dir))
    return (c.select("user_id", "day", "clust_id", F.posexplode("hours").alias("hr", "n"))
            .where(F.col("n") > 0))


@register("cluster_stay_time", ids=("WN-1", "SC-15", "SC-27"), views=("pings",), sql=FOLD_SQL + """
SELECT user_id, day, clust_id, stay_time, CASE WHEN stay_time < 15 THEN 'stop' ELSE 'OD' END AS stop_or_stay
FROM stays""")
def cluster_stay_time(spark, sf_dir):
    c = MB.cluster_stays(_pings(spark, sf_dir))
    return c.select("user_id", "day", "clust_id", "stay_time", "stop_or_stay")


@register("consecutive_pairs", ids=("WN-2",), views=("pings",), sql=FOLD_SQL + """
SELECT * FROM (SELECT user_id, day, clust_id,
                      lead(clust_id) OVER (PARTITION BY user_id, day ORDER BY clust_id) AS next_clust_id
               FROM clusters) WHERE next_clust_id IS NOT NULL""")
def consecutive_pairs(spark, sf_dir):
    return MB.consecutive_pairs(MB.trip_clusters(_pings(spark, sf_dir)))


@register("trips", ids=("MB-7", "MB-11", "SC-18"), views=("pings",), sql=FOLD_SQL + """
SELECT user_id, trp_id, day, o_clust, d_clust, Ox, Oy, Dx, Dy, date, hr, start, "end", dist FROM trips""")
def trips(spark, sf_dir):
    return _trips_sel(MB.trips_from_pings(_pings(spark, sf_dir)))


@register("avg_trips_per_day", ids=("MB-9",), views=("pings",), sql=FOLD_SQL + f"""
SELECT user_id, {r6('avg(n)')} AS avg_trips_per_day
FROM (SELECT user_id, day, count(*) AS n FROM trips GROUP BY user_id, day) GROUP BY user_id""")
def avg_trips_per_day(spark, sf_dir):
    return MB.avg_trips_per_day(MB.trips_from_pings(_pings(spark, sf_dir)))


@register("avg_trip_distance", ids=("MB-10",), views=("pings",), sql=FOLD_SQL + f"""
SELECT user_id, {r6('avg(d)')} AS avg_trip_dist
FROM (SELECT user_id, day, avg(dist) AS d FROM trips GROUP BY user_id, day) GROUP BY user_id""")
def avg_trip_distance(spark, sf_dir):
    return MB.avg_trip_distance(MB.trips_from_pings(_pings(spark, sf_dir)))


@register("unique_locations", ids=("MB-2", "PR-11"), views=("pings",), sql="""
SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, x, y FROM pings""")
def unique_locations(spark, sf_dir):
    return MB.unique_locations(_pings(spark, sf_dir))


@register("farthest_distance", ids=("MB-3", "JN-6"), views=("pings",), sql=DAYS_SQL + f"""
SELECT user_id, day, n_locs, {r6('max_dist')} AS max_dist FROM far""")
def farthest_distance(spark, sf_dir):
    fd = MB.farthest_distance(_pings(spark, sf_dir))
    return fd.select("user_id", "day", "n_locs", round6("max_dist").alias("max_dist"))


@register("travel_days", ids=("MB-4",), views=("pings",), sql=DAYS_SQL + f"""
SELECT user_id, day, n_locs, {r6('max_dist')} AS max_dist FROM far WHERE n_locs >= 2 AND max_dist >= 1.0""")
def travel_days(spark, sf_dir):
    fd = MB.travel_days(_pings(spark, sf_dir))
    return fd.select("user_id", "day", "n_locs", round6("max_dist").alias("max_dist"))


@register("semi_join_trip_days", ids=("MB-5", "JN-8"), views=("pings",), sql=DAYS_SQL + """
SELECT event_id, user_id, ts, site_id FROM pings p
WHERE EXISTS (SELECT 1 FROM far WHERE far.user_id = p.user_id AND far.day = CAST(p.ts AS DATE)
              AND n_locs >= 2 AND max_dist >= 1.0)""")
def semi_join_trip_days(spark, sf_dir):
    return MB.trip_day_events(_pings(spark, sf_dir)).select("event_id", "user_id", "ts", "site_id")


@register("user_mobility_summary", ids=("MB-8",), views=("pings",), sql=FOLD_SQL.rstrip() + ",\n"
          + DAYS_SQL.strip()[5:] + f""",
td AS (SELECT user_id, day, count(*) AS n_trips FROM trips GROUP BY user_id, day),
dd AS (SELECT far.user_id, far.day, far.n_locs, CASE WHEN td.n_trips IS NULL THEN 0 ELSE 1 END AS has_trips,
              CASE WHEN td.n_trips IS NULL THEN 0.0 ELSE far.max_dist END AS far
       FROM far LEFT JOIN td USING (user_id, day)),
tu AS (SELECT user_id, CAST(count(*) AS BIGINT) AS total_unique_locs FROM (SELECT DISTINCT user_id, x, y FROM pings)
       GROUP BY user_id)
SELECT dd.user_id, CAST(count(*) AS BIGINT) AS usage_days, CAST(sum(has_trips) AS BIGINT) AS days_with_trips,
       {r6('avg(n_locs)')} AS mean_locs_per_day, {r6('median(n_locs)')} AS median_locs_per_day,
       {r6('avg(far)')} AS mean_farthest, {r6('median(far)')} AS median_farthest,
       any_value(tu.total_unique_locs) AS total_unique_locs
FROM dd JOIN tu USING (user_id) GROUP BY dd.user_id""")
def user_mobility_summary(spark, sf_dir):
    return MB.user_mobility_summary(_pings(spark, sf_dir))


# --------------------------------------------------------------- spatial / OD

_OD_SQL = FOLD_SQL.rstrip() + """,
o AS (SELECT t.*, a.admin_id AS admin_id_o, a.admin_name AS admin_name_o FROM trips t JOIN admin_polygons a
      ON t.ox > a.xmin AND t.ox < a.xmax AND t.oy > a.ymin AND t.oy < a.ymax),
od_t AS (SELECT o.*, a.admin_id AS admin_id_d, a.admin_name AS admin_name_d FROM o JOIN admin_polygons a
      ON o.dx > a.xmin AND o.dx < a.xmax AND o.dy > a.ymin AND o.dy < a.ymax)
"""


def _od(spark, sf_dir):
    return SP.od_attributes(MB.trips_from_pings(_pings(spark, sf_dir)), FX.admin_polygons(spark))


@register("points_in_polygons", ids=("JN-5", "IO-16"), views=("pings", "admin_polygons"), sql="""
SELECT p.event_id, a.admin_id FROM pings p JOIN admin_polygons a
  ON p.x > a.xmin AND p.x < a.xmax AND p.y > a.ymin AND p.y < a.ymax""")
def points_in_polygons(spark, sf_dir):
    pts = _pings(spark, sf_dir).select("event_id", "x", "y")
    return SP.points_in_polygons(pts, FX.admin_polygons(spark)).select("event_id", "admin_id")


# the shapes as unions of the 3 x 3 boxes (row, column): independent of rings and rays
_SHAPES_SQL = " UNION ALL ".join(
    f"SELECT event_id, '{k}' AS admin_id FROM b WHERE (r, c) IN ({', '.join(map(str, v))})" for k, v in {
        "L": [(0, 0), (0, 1), (1, 0), (2, 0)], "P": [(0, 0), (2, 2)],
        "O": [(r, c) for r in range(3) for c in range(3) if (r, c) != (1, 1)]}.items())


@register("points_in_shapes", ids=("JN-5",), views=("pings", "admin_polygons"), sql=f"""
WITH b AS (SELECT p.event_id, CAST(substr(a.admin_id, 2, 1) AS INTEGER) AS r, CAST(substr(a.admin_id, 3, 1) AS INTEGER) AS c
           FROM pings p JOIN admin_polygons a ON p.x > a.xmin AND p.x < a.xmax AND p.y > a.ymin AND p.y < a.ymax)
{_SHAPES_SQL}""")
def points_in_shapes(spark, sf_dir):
    """Sites in a concave area, an area with a hole and one of two parts."""
    pts = _pings(spark, sf_dir).select("event_id", "x", "y")
    return SP.points_in_polygons(pts, FX.shaped_polygons(spark)).select("event_id", "admin_id")


@register("od_attributes", ids=("JN-4",), views=("pings", "admin_polygons"), sql=_OD_SQL + """
SELECT user_id, trp_id, admin_id_o, admin_name_o, admin_id_d, admin_name_d FROM od_t""")
def od_attributes(spark, sf_dir):
    return _od(spark, sf_dir).select("user_id", "trp_id", "admin_id_o", "admin_name_o", "admin_id_d", "admin_name_d")


@register("od_flows", ids=("MB-14", "SC-7"), views=("pings", "admin_polygons"), sql=_OD_SQL + """
SELECT admin_id_o, admin_name_o, admin_id_d, admin_name_d, admin_id_o || ',' || admin_id_d AS agg_id,
       CAST(count(*) AS BIGINT) AS count
FROM od_t GROUP BY admin_id_o, admin_name_o, admin_id_d, admin_name_d""")
def od_flows(spark, sf_dir):
    return SP.od_flows(_od(spark, sf_dir))


@register("od_outflows", ids=("MB-14",), views=("pings", "admin_polygons"), sql=_OD_SQL + """
SELECT admin_id_o, admin_name_o, CAST(count(*) AS BIGINT) AS count FROM od_t GROUP BY admin_id_o, admin_name_o""")
def od_outflows(spark, sf_dir):
    return SP.od_outflows(_od(spark, sf_dir))


@register("od_inflows", ids=("MB-14",), views=("pings", "admin_polygons"), sql=_OD_SQL + """
SELECT admin_id_d, admin_name_d, CAST(count(*) AS BIGINT) AS count FROM od_t GROUP BY admin_id_d, admin_name_d""")
def od_inflows(spark, sf_dir):
    return SP.od_inflows(_od(spark, sf_dir))


# ------------------------------------------------------------ towers / hours

_HR = "CAST(hour(ts) AS INTEGER)"


@register("hourly_by_location", ids=("AG-12", "SC-11"), views=("pings",), sql=f"""
SELECT site_id, {_HR} AS hr, CAST(count(*) AS BIGINT) AS n FROM pings GROUP BY site_id, {_HR}""")
def hourly_by_location(spark, sf_dir):
    return MB.hour_counts(_pings(spark, sf_dir), ["site_id"])


@register("hourly_by_user_location", ids=("AG-12",), views=("pings",), sql=f"""
SELECT user_id, site_id, {_HR} AS hr, CAST(count(*) AS BIGINT) AS n FROM pings GROUP BY user_id, site_id, {_HR}""")
def hourly_by_user_location(spark, sf_dir):
    return MB.hour_counts(_pings(spark, sf_dir), ["user_id", "site_id"])


def _profile_sql(extra_key: str = "", extra_expr: str = "") -> str:
    cols = ", ".join(f'CAST(count_if({_HR} = {h}) AS BIGINT) AS "{h}h"' for h in range(24))
    key = f", {extra_expr} AS {extra_key}" if extra_key else ""
    grp = f", {extra_expr}" if extra_key else ""
    return f"SELECT site_id, x, y{key}, {cols} FROM pings GROUP BY site_id, x, y{grp}"


@register("tower_hour_profile", ids=("AG-13", "MB-15"), views=("pings",), sql=_profile_sql())
def tower_hour_profile(spark, sf_dir):
    from fieldkit.operators.aggregates import pivot_dense
    p = _pings(spark, sf_dir).withColumn("hr", F.hour("ts"))
    return pivot_dense(p, ["site_id", "x", "y"], "hr", range(24), [f"{h}h" for h in range(24)])


@register("tower_weekday_hour_profile", ids=("AG-14", "SC-16"), views=("pings",),
          sql=_profile_sql("wkday_cat", "CASE WHEN isodow(ts) - 1 >= 5 THEN 'wkend' ELSE 'wkday' END"))
def tower_weekday_hour_profile(spark, sf_dir):
    from fieldkit.operators.aggregates import pivot_dense
    p = _pings(spark, sf_dir).withColumn("hr", F.hour("ts")).withColumn("wkday_cat", MB.weekday_category())
    return pivot_dense(p, ["site_id", "x", "y", "wkday_cat"], "hr", range(24), [f"{h}h" for h in range(24)])


def _hw_sql(keys: str) -> str:
    return f"""
SELECT {keys}, CAST(count_if({_HR} IN ({HOME})) AS BIGINT) AS home,
       CAST(count_if({_HR} IN ({WORK})) AS BIGINT) AS work,
       CAST(count_if({_HR} IN ({TRANSIT})) AS BIGINT) AS transit, CAST(count(*) AS BIGINT) AS total
FROM pings GROUP BY {keys}"""


@register("home_work_counts", ids=("AG-15",), views=("pings",), sql=_hw_sql("user_id, site_id"))
def home_work_counts(spark, sf_dir):
    return MB.home_work_counts(_pings(spark, sf_dir), ["user_id", "site_id"])


@register("tower_home_work", ids=("AG-15", "MB-15"), views=("pings",), sql=_hw_sql("site_id, x, y"))
def tower_home_work(spark, sf_dir):
    return MB.home_work_counts(_pings(spark, sf_dir), ["site_id", "x", "y"])


@register("home_work_scores", ids=("AG-16",), views=("pings",), sql=f"""
SELECT site_id,
  CAST(count_if(NOT {_HR} IN ({WORK}) AND {_HR} IN ({HOME})) AS BIGINT) AS home,
  CAST(count_if({_HR} IN ({WORK})) AS BIGINT) AS work,
  CAST(count_if(NOT {_HR} IN ({WORK}) AND NOT {_HR} IN ({HOME}) AND {_HR} IN ({TRANSIT})) AS BIGINT) AS transit
FROM pings GROUP BY site_id""")
def home_work_scores(spark, sf_dir):
    return MB.home_work_scores(_pings(spark, sf_dir), ["site_id"])


_SHARES_SQL = f"""
WITH c AS ({_hw_sql('user_id, site_id')}),
s AS (SELECT *, home / CAST(total AS DOUBLE) AS prop_home, work / CAST(total AS DOUBLE) AS prop_work,
             transit / CAST(total AS DOUBLE) AS prop_trst FROM c),
l AS (SELECT *, CASE WHEN greatest(prop_home, prop_work, prop_trst) >= 0.6 THEN
          CASE WHEN prop_home = greatest(prop_home, prop_work, prop_trst) THEN 'home'
               WHEN prop_work = greatest(prop_home, prop_work, prop_trst) THEN 'work' ELSE 'trst' END
        ELSE 'ND' END AS categ FROM s)
"""


@register("categorize_home_work", ids=("SC-28",), views=("pings",), sql=_SHARES_SQL + f"""
SELECT user_id, site_id, {r6('prop_home')} AS prop_home, {r6('prop_work')} AS prop_work,
       {r6('prop_trst')} AS prop_trst, categ FROM l""")
def categorize_home_work(spark, sf_dir):
    s = MB.site_shares(_pings(spark, sf_dir))
    return s.select("user_id", "site_id", round6("prop_home").alias("prop_home"),
                    round6("prop_work").alias("prop_work"), round6("prop_trst").alias("prop_trst"), "categ")


@register("home_work_from_sites", ids=("MB-13",), views=("pings",), sql=_SHARES_SQL + """,
p AS (SELECT user_id,
        arg_min(site_id, (-total, site_id)) FILTER (WHERE categ = 'home') AS h,
        arg_min(site_id, (-total, site_id)) FILTER (WHERE categ = 'work') AS w
      FROM l GROUP BY user_id)
SELECT user_id, coalesce(h, w) AS home, coalesce(w, h) AS work FROM p""")
def home_work_from_sites(spark, sf_dir):
    return MB.assign_home_work(MB.site_shares(_pings(spark, sf_dir)), "site_id")


@register("home_work_by_share", ids=("AG-17",), views=("pings",), sql=f"""
WITH c AS ({_hw_sql('user_id, site_id')}),
n AS (SELECT user_id, sum(total) AS n FROM c GROUP BY user_id),
h AS (SELECT user_id, arg_max(site_id, (home, -site_id)) AS home_site, max(home) AS hm,
             arg_max(site_id, (work, -site_id)) AS work_site, max(work) AS wm FROM c GROUP BY user_id)
SELECT h.user_id, home_site, work_site, {r6('hm / CAST(n AS DOUBLE)')} AS home_share,
       {r6('wm / CAST(n AS DOUBLE)')} AS work_share FROM h JOIN n USING (user_id)""")
def home_work_by_share(spark, sf_dir):
    return MB.home_work_by_share(_pings(spark, sf_dir))


# The nearest-leader fold as a recursive CTE: the state is the list of a user's clusters.
_NEAR = f"floor({hav_sql('c.sy / c.n / 1e8', 'c.sx / c.n / 1e8', 'y / 1e8', 'x / 1e8')} * 1e6 + 0.5)"
WHOLE_SQL = f"""
WITH RECURSIVE pts AS (
  SELECT user_id, CAST(round(x * 1e8) AS BIGINT) AS x, CAST(round(y * 1e8) AS BIGINT) AS y,
         CAST(dayname(ts) NOT IN ('Saturday', 'Sunday') AND hour(ts) IN ({HOME}) AS INTEGER) AS h,
         CAST(dayname(ts) NOT IN ('Saturday', 'Sunday') AND hour(ts) IN ({WORK}) AS INTEGER) AS w,
         CAST(dayname(ts) NOT IN ('Saturday', 'Sunday') AND hour(ts) IN ({TRANSIT}) AS INTEGER) AS t,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM pings WHERE user_id IS NOT NULL AND ts IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL),
st AS (
  SELECT user_id, rn, [{{'id': 1, 'n': 1, 'sx': x, 'sy': y, 'h': h, 'w': w, 't': t}}] AS cl FROM pts WHERE rn = 1
  UNION ALL
  SELECT user_id, rn, CASE WHEN list_min(ds) <= 2e6
    THEN list_transform(cl, lambda c: CASE WHEN c.id = list_position(ds, list_min(ds))
           THEN {{'id': c.id, 'n': c.n + 1, 'sx': c.sx + x, 'sy': c.sy + y, 'h': c.h + h, 'w': c.w + w, 't': c.t + t}}
           ELSE c END)
    ELSE list_append(cl, {{'id': CAST(len(cl) + 1 AS INTEGER), 'n': 1, 'sx': x, 'sy': y, 'h': h, 'w': w, 't': t}}) END
  FROM (SELECT p.user_id, p.rn, p.x, p.y, p.h, p.w, p.t, s.cl, list_transform(s.cl, lambda c: {_NEAR}) AS ds
        FROM st s JOIN pts p ON p.user_id = s.user_id AND p.rn = s.rn + 1)),
whole AS (
  SELECT user_id, c.id AS clust_id, c.n AS visit_freq, {r6('(c.sx / 1e8) / c.n')} AS x, {r6('(c.sy / 1e8) / c.n')} AS y,
         c.h AS home, c.w AS work, c.t AS transit,
         CASE WHEN greatest(c.h, c.w, c.t) / CAST(c.n AS DOUBLE) >= 0.6 THEN
           CASE WHEN c.h = greatest(c.h, c.w, c.t) THEN 'home' WHEN c.w = greatest(c.h, c.w, c.t) THEN 'work'
                ELSE 'trst' END ELSE 'ND' END AS categ
  FROM (SELECT user_id, unnest(cl) AS c FROM (SELECT user_id, arg_max(cl, rn) AS cl FROM st GROUP BY user_id)))
"""


@register("home_work_clusters", ids=("WN-5", "MB-12"), views=("pings",), sql=WHOLE_SQL + "SELECT * FROM whole")
def home_work_clusters(spark, sf_dir):
    return MB.home_work_clusters(_pings(spark, sf_dir)).select(
        "user_id", "clust_id", "visit_freq", "x", "y", "home", "work", "transit", "categ")


@register("home_work_assignment", ids=("MB-13",), views=("pings",), sql=WHOLE_SQL.rstrip() + """,
p AS (SELECT user_id,
        arg_min(clust_id, (-visit_freq, clust_id)) FILTER (WHERE categ = 'home') AS h,
        arg_min(clust_id, (-visit_freq, clust_id)) FILTER (WHERE categ = 'work') AS w
      FROM whole GROUP BY user_id),
a AS (SELECT user_id, coalesce(h, w) AS home, coalesce(w, h) AS work FROM p)
SELECT a.user_id, a.home, a.work, ch.x AS home_x, ch.y AS home_y, cw.x AS work_x, cw.y AS work_y
FROM a LEFT JOIN whole ch ON ch.user_id = a.user_id AND ch.clust_id = a.home
       LEFT JOIN whole cw ON cw.user_id = a.user_id AND cw.clust_id = a.work""")
def home_work_assignment(spark, sf_dir):
    c = MB.home_work_clusters(_pings(spark, sf_dir))
    return MB.assign_home_work(c, "clust_id", total="visit_freq", coords=("x", "y"))


@register("consistent_users", ids=("AG-18", "JN-7"), views=("pings",), sql="""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM pings GROUP BY ALL),
r AS (SELECT min(CAST(ts AS DATE)) AS d0, max(CAST(ts AS DATE)) AS d1 FROM pings),
spine AS (SELECT u.user_id, CAST(g.day AS DATE) AS day FROM (SELECT DISTINCT user_id FROM pings) u,
          r, generate_series(CAST(r.d0 AS TIMESTAMP), CAST(r.d1 AS TIMESTAMP), INTERVAL 1 DAY) g(day)),
dense AS (SELECT s.user_id, coalesce(d.n, 0) AS n FROM spine s LEFT JOIN d USING (user_id, day))
SELECT user_id, CAST(min(n) AS BIGINT) AS min_events, min(n) >= 5 AS consistent FROM dense GROUP BY user_id""")
def consistent_users(spark, sf_dir):
    return MB.consistent_users(_pings(spark, sf_dir), EVENTS_PER_DAY_THRESHOLD)
