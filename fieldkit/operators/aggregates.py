"""Grouping operators (AG-*). All are single-pass hash aggregates with
map-side partial aggregation, so a hot key is pre-combined before the
shuffle and never collected into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldkit.functions.geo import round6


def group_count(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """``GROUP BY keys`` row count (AG-3)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Frequency table, most frequent first, ties by value (AG-9)."""
    return group_count(df, [col], name).orderBy(F.col(name).desc(), F.col(col).asc_nulls_last())


def arg_max(df: DataFrame, key: str, value: str) -> DataFrame:
    """Row with the largest ``value``; ties broken by the smallest key (AG-4).
    Plans as ``TakeOrderedAndProject`` (top-1 per partition, then one merge)."""
    return df.orderBy(F.col(value).desc(), F.col(key).asc()).limit(1)


def arg_max_ties(df: DataFrame, value: str) -> DataFrame:
    """All rows whose ``value`` equals the maximum: one plan, scalar
    subquery instead of a driver round trip (SQ-3)."""
    return df.sparkSession.sql(
        "SELECT * FROM {t} WHERE {v} = (SELECT max({v}) FROM {t})".replace("{v}", f"`{value}`"), t=df)


def two_level_mean(df: DataFrame, unit: str, group: str, name: str) -> DataFrame:
    """Mean size of ``unit`` groups per ``group`` plus the overall mean
    (``group`` NULL) via rollup (AG-5)."""
    sizes = df.groupBy(unit, group).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.rollup(group).agg(round6(F.avg("_n")).alias(name))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: NULL count per column, one pass (PR-9)."""
    return df.select([F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def mean_by_key(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """(sum, count) per key with partial aggregation, then divide (AG-2)."""
    return df.groupBy(key).agg(round6(F.avg(value)).alias(name))


def max_row(df: DataFrame, value: str, cols: Sequence[str]) -> DataFrame:
    """The maximum and the row holding it (AG-10, SO-4) in one aggregate:
    ``max_by`` over a struct keeps the whole row, ties to the smallest tail."""
    order = F.struct(F.col(value), *[F.col(c) for c in cols])
    return df.agg(F.max(order).alias("_m")).select("_m.*")


def date_range(df: DataFrame, col: str) -> DataFrame:
    """First and last value in one pass (AG-11); NULLs ignored."""
    return df.agg(F.min(col).alias("first"), F.max(col).alias("last"))


def centroid(df: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y",
             weight: str | Column | None = None) -> DataFrame:
    """Geographic centre per key, optionally weighted: sum(x*w)/sum(w) (AG-20)."""
    w = F.lit(1.0) if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    return df.groupBy(*keys).agg(
        round6(F.sum(F.col(x) * w) / F.sum(w)).alias("cx"),
        round6(F.sum(F.col(y) * w) / F.sum(w)).alias("cy"))


def pivot_dense(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence,
                names: Sequence[str] | None = None) -> DataFrame:
    """Long → wide count table over an explicit value list, missing cells 0
    (AG-13/AG-19).

    Written as one conditional aggregate (``count_if(col = v)`` per value):
    one partially-aggregated shuffle, where ``groupBy().pivot()`` would
    aggregate by (keys, value) first and pivot in a second shuffle."""
    names = list(names) if names else [str(v) for v in values]
    return df.groupBy(*keys).agg(*[F.count_if(F.col(pivot_col) == F.lit(v)).alias(n)
                                   for v, n in zip(values, names)])


def pivot_values(df: DataFrame, keys: Sequence[str], pivot_col: str, value: str, how: Callable[[Column], Column],
                 values: Sequence) -> DataFrame:
    """Long → wide table of a column's values, aggregated per cell by ``how`` (``F.sum``, ``F.max``, ...),
    missing cells NULL (AG-19). One conditional aggregate, like ``pivot_dense``."""
    return df.groupBy(*keys).agg(*[how(F.when(F.col(pivot_col) == F.lit(v), F.col(value))).alias(str(v)) for v in values])


def pivot_keys(df: DataFrame, col: str, most: int = 1000) -> list:
    """The distinct values of a dimension column, in order: the columns of a pivot. More than ``most`` is an error."""
    found = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{col} has more than {most} values; a pivot needs a column for each")
    return sorted(found)


def with_counters(spark: SparkSession, build: Callable[[SparkSession], DataFrame], counters: dict[str, Column],
                  sink: Callable[[DataFrame], None]) -> dict:
    """Runs ``sink`` (an action: a write, a count) over the frame that ``build`` makes, and returns the counters,
    aggregates taken of the rows on their way (AG-21). No second pass; rows of retried tasks count once.

    The frame is built in a session of its own (same cluster, same tables): a session that has observed a query
    carries a listener that some later plans cannot be shipped with."""
    seen = Observation()
    sink(build(spark.newSession()).observe(seen, *[c.alias(n) for n, c in counters.items()]))
    return seen.get
