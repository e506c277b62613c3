"""Join operators (JN-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkit.operators.frames import remove_spaces_in_colnames, union_all_by_name


def broadcast_if_small(df: DataFrame, max_bytes: int, row_bytes: Column) -> DataFrame:
    """Broadcast hint only after checking the side's size.

    The check sums ``row_bytes``, an estimate per row, over the (dimension)
    side alone. Above ``max_bytes`` the frame is returned unhinted and the
    planner falls back to a shuffle join; the rows are the same."""
    size = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def enrich_with_site(events: DataFrame, site_tables: Sequence[DataFrame], event_key: str,
                     site_key: str) -> DataFrame:
    """Attach site coordinates to events (MB-1, JN-2): normalise column names,
    append the site files by name, inner join, mark provenance ``both``.

    The site list is dimension data; the planner's runtime size check turns
    this into a broadcast hash join when it is small and a shuffle join
    otherwise (AQE), so no unchecked broadcast is forced here."""
    ev = remove_spaces_in_colnames(events)
    sites = union_all_by_name([remove_spaces_in_colnames(s) for s in site_tables])
    return ev.join(sites, ev[event_key] == sites[site_key], "inner").withColumn("_merge", F.lit("both"))


def match_coverage(events: DataFrame, sites: DataFrame, event_key: str, site_key: str) -> DataFrame:
    """Coverage of an id join in one row: events, distinct ids on each side,
    ids on both sides, events whose id matches (JN-3)."""
    ev_ids = events.groupBy(F.col(event_key).alias("id")).agg(F.count(F.lit(1)).alias("n_ev"))
    site_ids = sites.select(F.col(site_key).alias("id")).distinct().withColumn("in_sites", F.lit(True))
    j = ev_ids.join(site_ids, "id", "full_outer")
    return j.agg(
        F.coalesce(F.sum("n_ev"), F.lit(0)).alias("n_events"),
        F.count_if(F.col("n_ev").isNotNull()).alias("n_event_ids"),
        F.count_if(F.col("in_sites").isNotNull()).alias("n_site_ids"),
        F.count_if(F.col("n_ev").isNotNull() & F.col("in_sites").isNotNull()).alias("n_matched_ids"),
        F.coalesce(F.sum(F.when(F.col("in_sites").isNotNull(), F.col("n_ev"))), F.lit(0)).alias("n_matched_events"))


MAX_SPINE_DAYS = 36_600


def dense_daily_counts(events: DataFrame, key: str, ts: str = "ts", first_day: str | None = None,
                       last_day: str | None = None, max_days: int = MAX_SPINE_DAYS) -> DataFrame:
    """Events per key and reference day, 0 on days without events (JN-7).

    Reference days run from the data set's first to last day, or between the
    days given (``'2024-01-31'``). Keys and bounds come from the counted
    table, so events are read once; each key row explodes its own spine (no users × days
    cross join). Events without a time belong to no day. A spine of more than
    ``max_days`` (one stray date is enough) is an error.
    """
    spark = events.sparkSession
    counted = (events.where(F.col(ts).isNotNull()).groupBy(key, F.to_date(ts).alias("day"))
               .agg(F.count(F.lit(1)).alias("n")))
    lo = f"DATE'{first_day}'" if first_day else "(SELECT min(day) FROM {c})"
    hi = f"DATE'{last_day}'" if last_day else "(SELECT max(day) FROM {c})"
    return spark.sql(f"""
        WITH r AS (SELECT {lo} AS d0, {hi} AS d1),
             b AS (SELECT d0, if(datediff(d1, d0) < {int(max_days)}, d1,
                                 raise_error(concat('days from ', d0, ' to ', d1, ': more than {int(max_days)}'))) AS d1 FROM r),
             s AS (SELECT `{key}`, explode(sequence((SELECT d0 FROM b), (SELECT d1 FROM b), INTERVAL 1 DAY)) AS day
                   FROM (SELECT DISTINCT `{key}` FROM {{c}}))
        SELECT s.`{key}`, s.day, coalesce(c.n, 0) AS n FROM s LEFT JOIN {{c}} c ON c.`{key}` <=> s.`{key}` AND c.day = s.day""",
                     c=counted)


def lookup_case_insensitive(table: DataFrame, col: str, names: Sequence[str]) -> DataFrame:
    """Rows whose ``col`` equals one of ``names`` ignoring case, all matches
    kept (JN-10). The name list is a parameter of known, small size."""
    q = table.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("query"))
    return table.join(F.broadcast(q), F.lower(F.col(col)) == F.lower(F.col("query")))
